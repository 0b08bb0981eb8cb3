"""Repair of conversation structure: a min-plus program over a grammar of role and fault symbols.

1. Faults. Each row becomes one of a few symbols: its role's initial and its
   first fault (blank, duplicate, truncated). Duplicates are found by a window
   over (conversation, role, text). Ordinary SQL functions do this.
2. Sequences. Rows are dealt by conversation, sorted and streamed; a
   conversation leaves one symbol a row, no more than its audit will take.
   Equal sequences of different conversations are one from here on.
3. Grammar. Re-Pair: the pairs of symbols that occur most often in a task's
   sequences become rules, until no pair occurs twice.
4. Matrices. ``s?(ua)+`` or nothing is an automaton with four states. A symbol
   has a 4 x 4 matrix: the least cost of its edits from state to state, with
   the audit of the edits as a rope; a rule's matrix is the min-plus product of
   its two parts, computed once and shared by all that use the rule. Among
   equal costs the audit least in ASCII wins. Two audits of one stretch and
   cost are never prefixes of each other (both have one letter for each row,
   and each further insertion costs), so the least of a product is the product
   of the least ones.
5. Repair. Audits and rows are dealt by conversation once more and streamed:
   a row is kept, given another role, left out, or preceded by an insertion.

Edits: Keep 0, Rerole to user or assistant 1, Delete 2, Insert an empty user or
assistant text 5; an undeleted truncated row costs 5 more; blank and duplicate
rows must be deleted.

Defined results: a null role or text is one space; null conversations are one
conversation and null turns come first. Rows of one turn are ordered by role and
then by text hash. An empty role has no initial: it can't be kept, and its
neighbours are illegal. Other columns are ignored. A conversation may be of any length: only
its symbols and its audit are held, its texts are streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5
SYSTEM, USER, ASSISTANT, OTHER = range(4)
OK, TRUNCATED, GONE = range(3)
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
# Symbol: 3 * initial + fault; all rows that must go are one symbol.
MUST_GO, SYMBOLS = GONE, 12
# States: nothing yet, after the system row, after a user, after an assistant. By user or assistant row to:
START, HEAD, ASKED, ANSWERED = range(4)
NEXT_USER = {START: ASKED, HEAD: ASKED, ANSWERED: ASKED}
NEXT_ASSISTANT = {ASKED: ANSWERED}
# Insertions that lead from a state to others; more of them would only come back.
INSERTS = {START: {START: 0, ASKED: 1, ANSWERED: 2}, HEAD: {HEAD: 0, ASKED: 1, ANSWERED: 2}, ASKED: {ASKED: 0, ANSWERED: 1}, ANSWERED: {ANSWERED: 0, ASKED: 1}}
CHUNK = 1_000_000
LEAF = 64
BLANK_CHARS = " \t\n\x0b\x0c\r"


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with faults planted by crc32 of ``conv_id:turn`` modulo 20."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), kind.alias("kind")).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, h (text hash), fault: blank, duplicate, truncated or null, initial."""
    space = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn")) > 1
    last = F.substring(F.rtrim(F.col("text"), F.lit(BLANK_CHARS)), -1, 1)
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    fault = F.when(blank, "blank").when(seen, "duplicate").when(~last.isin(".", "!", "?"), "truncated")
    first = F.substring("role", 1, 1)
    initial = F.when(first == "s", SYSTEM).when(first == "u", USER).when(first == "a", ASSISTANT).otherwise(OTHER)
    return rows.select("*", F.xxhash64("text").alias("h"), fault.alias("fault"), initial.alias("initial"))


def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, pa.RecordBatch]]:
    """(conversation, whether it begins here, its rows) in the order of a stream that is sorted by the first column."""
    last: list = []
    for batch in batches:
        keys = batch.column(0).to_pylist()
        at = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]
        for a, b in zip(at, at[1:]):
            if a < b:
                yield keys[a], last != [keys[a]], batch.slice(a, b - a)
                last = [keys[a]]


def sequences(faulty: DataFrame) -> DataFrame:
    """conv_id, symbols (a byte for each row in order), illegal (neighbours whose initials may not follow each other)."""
    code = F.when(F.col("fault").isin("blank", "duplicate"), GONE).when(F.col("fault") == "truncated", TRUNCATED).otherwise(OK)
    kind = faulty.schema["conv_id"].dataType.simpleString()
    rows = faulty.select("conv_id", "turn", "role", "h", (F.col("initial") * 3 + code).cast("int").alias("symbol"))
    legal = np.zeros((4, 4), bool)
    legal[tuple(zip(*LEGAL))] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, out = [], bytearray(), []

        def close():
            initials = np.frombuffer(bytes(held), np.uint8) // 3
            symbols = np.frombuffer(bytes(held), np.uint8)
            gone = symbols % 3 == GONE
            out.append((ids[0], np.where(gone, MUST_GO, symbols).astype(np.uint8).tobytes(), int((~legal[initials[:-1], initials[1:]]).sum())))

        for key, new, rows in streamed(batches):
            if new and ids:
                close()
                held.clear()
                if len(out) >= 2048:
                    yield table(out)
                    out = []
            ids = [key]
            held += rows.column(4).to_numpy().astype(np.uint8).tobytes()
        if ids:
            close()
        yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        cells = [[row[i] for row in out] for i in range(3)]
        return pa.RecordBatch.from_arrays([pa.array(cells[0], key_type), pa.array(cells[1], pa.binary()), pa.array(cells[2], pa.int64())], ["conv_id", "symbols", "illegal"])

    key_type = arrow_type(faulty, "conv_id")
    return ordered(rows).mapInArrow(run, f"conv_id {kind}, symbols binary, illegal long")


def arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


def ordered(rows: DataFrame, *before: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *before, "turn", "role", "h")


# A rope is a text, or a pair of ropes.
def joined(a, b):
    if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF:
        return a + b
    return (a, b) if a and b else a or b


def leaves(rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        rope = todo.pop()
        if isinstance(rope, str):
            yield rope
        else:
            todo += [rope[1], rope[0]]


def less(a, b) -> bool:
    """Whether the text of rope ``a`` is before that of ``b``."""
    left, right, x, y = [a], [b], "", ""
    while True:
        if not x and not y and left and right and left[-1] is right[-1]:
            left.pop(), right.pop()
            continue
        if not x:
            if not left:
                return bool(y) or any(any(leaves(r)) for r in right)
            rope = left.pop()
            if isinstance(rope, str):
                x = rope
            else:
                left += [rope[1], rope[0]]
        elif not y:
            if not right:
                return False
            rope = right.pop()
            if isinstance(rope, str):
                y = rope
            else:
                right += [rope[1], rope[0]]
        else:
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            x, y = x[n:], y[n:]


def better(a, b) -> bool:
    return a[0] < b[0] or (a[0] == b[0] and a[1] is not b[1] and less(a[1], b[1]))


def terminal(symbol: int) -> list:
    """Matrix of one row: (cost, audit) by state before and after, None where there is no way."""
    initial, fault = divmod(symbol, 3)
    matrix = [[None] * 4 for _ in range(4)]

    def offer(i: int, j: int, entry: tuple):
        if matrix[i][j] is None or better(entry, matrix[i][j]):
            matrix[i][j] = entry

    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    for i, ways in INSERTS.items():
        for k, n in ways.items():
            cost, audit = INSERT_COST * n, INSERT * n
            offer(i, k, (cost + DELETE_COST, audit + DELETE))
            if fault == GONE:
                continue
            kept = {SYSTEM: {START: HEAD}, USER: NEXT_USER, ASSISTANT: NEXT_ASSISTANT, OTHER: {}}[initial]
            if k in kept:
                offer(i, kept[k], (cost + extra, audit + KEEP))
            offer(i, (NEXT_USER | NEXT_ASSISTANT)[k], (cost + REROLE_COST + extra, audit + REROLE))
    return matrix


def times(a: list, b: list) -> list:
    """Min-plus product; equal costs are decided by the audits."""
    out = []
    for row in a:
        best: list = [None] * len(b[0])
        for k, x in enumerate(row):
            if x is None:
                continue
            for j, y in enumerate(b[k]):
                if y is None or (best[j] is not None and x[0] + y[0] > best[j][0]):
                    continue
                entry = (x[0] + y[0], joined(x[1], y[1]))
                if best[j] is None or better(entry, best[j]):
                    best[j] = entry
        out.append(best)
    return out


def grammar(symbols: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Re-Pair over sequences that -1 parts: what is left of them, and the pair behind each new symbol (from SYMBOLS on).

    Each round replaces the most frequent pairs that have no symbol in common.
    """
    x, rules = symbols.astype(np.int64), []
    while len(x) > 1:
        at = np.flatnonzero((x[1:] >= 0) & (x[:-1] >= 0))
        # In a run of one symbol only every second place begins a pair.
        begins = np.concatenate(([0], np.flatnonzero(x[1:] != x[:-1]) + 1))
        in_run = np.arange(len(x)) - np.repeat(begins, np.diff(np.append(begins, len(x))))
        at = at[(x[at] != x[at + 1]) | (in_run[at] % 2 == 0)]
        base = SYMBOLS + len(rules)
        codes = x[at] * base + x[at + 1]
        pairs, which, counts = np.unique(codes, return_inverse=True, return_counts=True)
        number, used = np.full(len(pairs), -1, np.int64), set()
        for p in np.argsort(-counts, kind="stable").tolist():
            if counts[p] < 2:
                break
            a, b = divmod(int(pairs[p]), base)
            if a not in used and b not in used:
                used |= {a, b}
                number[p] = SYMBOLS + len(rules)
                rules.append((a, b))
        if not used:
            break
        new = number[which]
        at, new = at[new >= 0], new[new >= 0]
        x[at] = new
        x = np.delete(x, at + 1)
    return x, rules


def audits(sequences: list[bytes]) -> list[tuple[int, str]]:
    """Least cost and its audit for each sequence of symbols."""
    flat = np.concatenate([np.concatenate((np.frombuffer(s, np.uint8).astype(np.int64), [-1])) for s in sequences] or [np.zeros(0, np.int64)])
    left, rules = grammar(flat)
    matrices = [terminal(s) for s in range(SYMBOLS)]
    for a, b in rules:
        matrices.append(times(matrices[a], matrices[b]))
    out, own = [], []
    for symbol in left.tolist():
        if symbol >= 0:
            own.append(symbol)
            continue
        parts = [matrices[s] for s in own]
        while len(parts) > LEAF:
            parts = [times(parts[i], parts[i + 1]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        row = [[(0, ""), None, None, None]]
        for part in parts:
            row = times(row, part)
        last = [[(0, "")], [(2 * INSERT_COST, INSERT * 2)], [(INSERT_COST, INSERT)], [(0, "")]]
        cost, rope = times(row, last)[0][0]
        out.append((cost, "".join(leaves(rope))))
        own = []
    return out


def with_audits(sequences: DataFrame) -> DataFrame:
    """symbols, cost, audit for each distinct sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for symbols in batch.column(0).to_pylist():
                held.append(symbols)
                size += len(symbols)
                if size >= CHUNK:
                    yield table(held)
                    held, size = [], 0
        if held:
            yield table(held)

    def table(held: list[bytes]) -> pa.RecordBatch:
        found = audits(held)
        return pa.RecordBatch.from_arrays([pa.array(held, pa.binary()), pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())], ["symbols", "cost", "audit"])

    return sequences.select("symbols").distinct().mapInArrow(run, "symbols binary, cost long, audit string")


def plan(faulty: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit of each conversation that has rows."""
    found = sequences(faulty)
    return found.join(with_audits(found), "symbols").select("conv_id", "illegal", "cost", "audit")


def repaired(faulty: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, role, text of the repaired rows, each conversation's rows together and in order within a partition."""
    rows = faulty.select("conv_id", F.lit(1).alias("part"), "turn", "role", "h", "text")
    heads = planned.select("conv_id", F.lit(0).alias("part"), F.lit(None).cast(faulty.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"), F.lit(0).cast("long").alias("h"), F.col("audit").alias("text"))
    kind = faulty.schema["conv_id"].dataType.simpleString()
    key_type = arrow_type(faulty, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, at, place, odd = "", 0, 0, 0

        def role_here() -> str:
            return "user" if (place - odd) % 2 == 0 else "assistant"

        for key, new, part in streamed(batches):
            roles, texts = part.column(3).to_pylist(), part.column(5).to_pylist()
            out = []
            if new:
                audit, at, place = texts[0], 0, 0
                odd = (len(audit) - audit.count(DELETE)) % 2
                roles, texts = roles[1:], texts[1:]
            rest = 0
            while at < len(audit) and (audit[at] == INSERT or rest < len(roles)):
                edit = audit[at]
                at += 1
                if edit == INSERT:
                    out.append((role_here(), ""))
                elif edit != DELETE:
                    out.append((roles[rest] if edit == KEEP else role_here(), texts[rest]))
                if edit != INSERT:
                    rest += 1
                place += edit != DELETE
            if out:
                cells = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(out), key_type), pa.array(cells[0]), pa.array(cells[1])], ["conv_id", "role", "text"])

    return ordered(rows.unionAll(heads), "part").mapInArrow(run, f"conv_id {kind}, role string, text string")


def digests(rows: DataFrame) -> DataFrame:
    """conv_id and the hash of its ``role:text`` lines, of rows that lie together and in order as ``repaired`` leaves them."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    key_type = arrow_type(rows, "conv_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, out, sha = [], [], None
        for key, new, part in streamed(batches):
            if new:
                if ids:
                    out.append((ids[0], sha.hexdigest()))
                sha = hashlib.sha256()
                if len(out) >= 2048:
                    yield table(out)
                    out = []
            ids = [key]
            lines = "\n".join(f"{r}:{t}" for r, t in zip(part.column(1).to_pylist(), part.column(2).to_pylist()))
            sha.update((lines if new else "\n" + lines).encode("utf-8", "replace"))
        if ids:
            out.append((ids[0], sha.hexdigest()))
        yield table(out)

    def table(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], key_type), pa.array([d for _, d in out], pa.string())], ["conv_id", "repaired_sha256"])

    return rows.mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, role, text: every conversation as its cheapest repair leaves it (not damaged before)."""
    prepare(conversations.sparkSession)
    faulty = with_faults(conversations)
    return repaired(faulty, plan(faulty))


def repair_report(conversations: DataFrame) -> DataFrame:
    """The contract's row for each conversation of the table: planted faults, their counts, the cheapest repair."""
    prepare(conversations.sparkSession)
    faulty = with_faults(damage(conversations))
    planned = plan(faulty)
    # At most one row for each (conversation, turn) reaches the second step, so counting turns holds no sets.
    is_fault = [F.sum(F.when(F.col("fault") == f, 1).otherwise(0)).alias(f) for f in ("blank", "duplicate", "truncated")]
    turns = faulty.groupBy("conv_id", "turn").agg(*is_fault).groupBy("conv_id")
    turn = F.col("turn").cast("long")
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count(turn), F.lit(0))
    facts = turns.agg(gaps.alias("gaps"), *[F.sum(f).alias(f) for f in ("blank", "duplicate", "truncated")])
    parts = [conversations.select("conv_id").distinct(), facts, planned, digests(repaired(faulty, planned))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    counts = [F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.groupBy("conv_id").agg(*counts, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("repaired_sha256"), nothing).alias("repaired_sha256"))
