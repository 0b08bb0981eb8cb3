"""Exact repeats of ``span`` bytes across documents, by a distributed merge sort of suffixes.

1. Chunks. Whole documents are packed into compressed chunks of some MB, written
   once to the shared scratch folder. A document is a number in its chunk from
   here on, so repeated and null doc_ids need no care.
2. Places. In every ``span`` bytes the ``GRAM``-byte string with the smallest hash
   is taken (all of them, at ties). The choice depends on those bytes alone, so
   equal strings of ``span`` bytes have equal places. One place in 14 bytes is taken.
3. Once or more. Sorted 32-bit prints of a chunk's places are exchanged by
   bucket. What no second document has (no print has a false negative) is left
   out, so only strings that repeat are sorted.
4. Runs. A chunk's suffixes at the places left (``span`` bytes on, then the bytes
   before the place, read backwards) are sorted, equal ones become one with its
   smallest doc_id, and the sorted run is cut at range splitters. A slice is
   front-coded: for each string the length it shares with the one before, and
   the rest, compressed.
5. Merge. A range's slices are merged by a loser tree whose nodes remember how
   much the loser shares with the winner. A string is compared from the first
   byte on that is not known to be equal, and not at all where those lengths
   differ. The merge also yields the lengths shared by neighbours in the order.
6. Verdicts. Strings of one gram are neighbours. For each of the offsets that the
   gram can have in a window, strings that agree on the window's bytes are one
   class, known from the shared lengths to the right and, sorted once more, to
   the left; its smallest doc_id decides. A slice gets one bit for each string
   and offset: whether a smaller document than the slice's own smallest has it.
   Larger documents of the same slice have the whole string from the smallest.
7. Covers. The chunk turns bits into windows, windows into removed spans.

A string that a third of all documents have is one entry for each chunk, and the
rows exchanged are at most the entries. Splitters come from a bounded sample and
change only the balance.

Defined results: a null text is empty. A null doc_id is neither smaller nor
larger than any: its text is kept and removes nothing. Rows that repeat a doc_id
do not remove each other's bytes. doc_id is an integer; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare, sorted_groups

SPAN, GRAM = 50, 24
LEFT = SPAN - GRAM
WIDTH = SPAN + LEFT
NOTHING = 0xFF  # never a byte of UTF-8
CHUNK_BYTES = 8 << 20
BUCKET_BYTES = 32 << 20  # of text, for each bucket of prints
RANGE_STRINGS = 200_000
SAMPLE_CHUNKS, SAMPLE_EACH = 2048, 64
BLOCK = 1 << 17
TOP = np.uint64(2**64 - 1)
# Odd multipliers of the hash.
MIX = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9, 0xD6E8FEB86659FD93)]
CODEC = "zstd"
TEXT_LEVEL, STRINGS_LEVEL = 5, 1


def chunks(documents: DataFrame) -> DataFrame:
    """chunk, ids, known, sizes, size, body: the documents in order, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def row() -> pa.RecordBatch:
            ids = np.array([i or 0 for i, _ in held], np.int64)
            known = np.array([i is not None for i, _ in held])
            sizes = np.array([len(t) for _, t in held], np.int64)
            body = b"".join(t for _, t in held)
            cells = [(task << 32) | made, ids.tobytes(), np.packbits(known).tobytes(), sizes.tobytes(), len(body), squeezed(body, TEXT_LEVEL)]
            types = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types)], ["chunk", "ids", "known", "sizes", "size", "body"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((i, (text or "").encode("utf-8", "replace")))
                size += len(held[-1][1])
                if size >= CHUNK_BYTES:
                    yield row()
                    made, held, size = made + 1, [], 0
        if held:
            yield row()

    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return docs.mapInArrow(run, "chunk long, ids binary, known binary, sizes binary, size long, body binary")


def squeezed(data: bytes, level: int) -> bytes:
    return pa.Codec(CODEC, compression_level=level).compress(data, asbytes=True)


def unsqueezed(data: bytes, size: int) -> bytes:
    return pa.Codec(CODEC).decompress(data, size, asbytes=True) if size else b""


class Chunk:
    """The texts of a chunk row: bytes, and each document's id, whether it is known, and its place."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.known = np.unpackbits(np.frombuffer(row["known"], np.uint8), count=len(self.ids)).astype(bool)
        self.sizes = np.frombuffer(row["sizes"], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.text = np.frombuffer(unsqueezed(row["body"], row["size"]), np.uint8)

    def places(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place, document number and hash of each taken gram of a known document, in order."""
        n = len(self.text)
        if n < SPAN:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        padded = np.concatenate((self.text, np.zeros(GRAM, np.uint8)))
        of = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        # Last place of a gram, of a window: none in unknown documents.
        ends = np.where(self.known, self.ends, 0)
        taken, hashes = [], []
        for a in range(0, n, BLOCK):
            low, high = max(0, a - LEFT), min(n, a + BLOCK + LEFT)
            at = np.arange(low, high)
            end = ends[of[low:high]]
            h = gram_hashes(padded, low, high)
            h[at + GRAM > end] = TOP
            window = sliding(h, LEFT + 1, np.minimum)
            window[at[: len(window)] + SPAN > end[: len(window)]] = 0
            # The largest of the minima of the windows that hold a place; windows begin at ``low`` or later.
            best = sliding(np.concatenate((np.zeros(LEFT, np.uint64), window, np.zeros(len(h) - len(window), np.uint64))), LEFT + 1, np.maximum)
            inside = slice(a - low, min(n, a + BLOCK) - low)
            got = np.flatnonzero(best[inside] == h[inside])
            taken.append(got + a), hashes.append(h[inside][got])
        at = np.concatenate(taken)
        return at, of[at].astype(np.int64), np.concatenate(hashes)

    def strings(self, at: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Rows of WIDTH bytes: the text from each place on, then the bytes before it from the nearest on."""
        right = at[:, None] + np.arange(SPAN)
        left = at[:, None] - 1 - np.arange(LEFT)
        start, end = (self.ends - self.sizes)[doc][:, None], self.ends[doc][:, None]
        last = len(self.text) - 1
        return np.concatenate((np.where(right < end, self.text[np.minimum(right, last)], NOTHING), np.where(left >= start, self.text[np.maximum(left, 0)], NOTHING)), 1).astype(np.uint8)


def gram_hashes(padded: np.ndarray, low: int, high: int) -> np.ndarray:
    """Hash of the GRAM bytes from each place on, never 0 nor TOP."""
    h = np.zeros(high - low, np.uint64)
    for k in range(GRAM // 8):
        h += np.ndarray((high - low,), "<u8", padded, low + 8 * k, (1,)) * MIX[k]
    h ^= h >> np.uint64(32)
    h *= MIX[3]
    h ^= h >> np.uint64(29)
    return np.clip(h, 1, TOP - np.uint64(1))


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """Minimum or maximum of each ``width`` neighbours."""
    if len(x) < width:
        return x[:0].copy()
    reach = 1
    while reach * 2 <= width:
        x = least(x[:-reach], x[reach:])
        reach *= 2
    rest = width - reach
    return least(x[: len(x) - rest], x[rest:]) if rest else x.copy()


def prints(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the upper half, print in the lower one."""
    mixed = hashes * MIX[4]
    mixed ^= mixed >> np.uint64(31)
    mixed *= MIX[0]
    low = np.uint64(2**32 - 1)
    return (((mixed >> np.uint64(32)) * np.uint64(buckets)) & ~low) | (mixed & low)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Row by row: one chunk is in memory at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(n)[i].as_py() for n, name in enumerate(batch.schema.names)}


def binary(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


PRINTS = "bucket int, chunk long, prints binary, here binary"
BITS = "chunk long, bucket int, bits binary, n long"


def repeated(table: DataFrame, buckets: int) -> DataFrame:
    """For each chunk and bucket: which of its prints, in order, two documents have. Bucket -1 holds sampled strings."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            chunk = Chunk(row)
            at, doc, h = chunk.places()
            if not len(at):
                continue
            key = prints(h, buckets)
            order = np.lexsort((doc, key))
            key, doc = key[order], doc[order]
            first = np.concatenate(([True], key[1:] != key[:-1]))
            own = np.flatnonzero(first)
            # Two documents here: the run's first and last differ (documents are in order).
            here = doc[own] != doc[np.append(own[1:], len(doc)) - 1]
            key = key[own]
            bucket = (key >> np.uint64(32)).astype(np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(key)]))
            out = [(int(bucket[a]), row["chunk"], binary(key[a:b].astype(np.uint32)), binary(np.packbits(here[a:b]))) for a, b in zip(cuts, cuts[1:])]
            some = np.linspace(0, len(at) - 1, SAMPLE_EACH).astype(np.int64)
            out.append((-1, row["chunk"], binary(chunk.strings(at[some], chunk_docs(chunk, at[some]))[:, :GRAM]), b""))
            cells = list(zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.int64(), pa.binary(), pa.binary()))], ["bucket", "chunk", "prints", "here"])

    def meet(table: pa.Table) -> pa.Table:
        by: dict[int, list[int]] = {}
        for i, b in enumerate(table.column("bucket").to_pylist()):
            by.setdefault(b, []).append(i)
        out = []
        for bucket, rows in by.items():
            chunk = [table.column("chunk")[i].as_py() for i in rows]
            if bucket < 0:
                out += [(c, -1, table.column("prints")[i].as_py(), 0) for c, i in zip(chunk, rows)]
                continue
            parts = [np.frombuffer(table.column("prints")[i].as_py(), np.uint32) for i in rows]
            here = [np.unpackbits(np.frombuffer(table.column("here")[i].as_py(), np.uint8), count=len(p)).astype(bool) for i, p in zip(rows, parts)]
            flat, marked = np.concatenate(parts), np.concatenate(here)
            order = np.argsort(flat, kind="stable")
            new = np.concatenate(([True], flat[order][1:] != flat[order][:-1]))
            group = np.cumsum(new) - 1
            twice = (np.bincount(group) > 1) | (np.bincount(group, marked[order]) > 0)
            bits = np.empty(len(flat), bool)
            bits[order] = twice[group]
            for c, own in zip(chunk, np.split(bits, np.cumsum([len(p) for p in parts])[:-1])):
                out.append((c, bucket, binary(np.packbits(own)), int(own.sum())))
        cells = list(zip(*out)) or [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.int32(), pa.binary(), pa.int64()))], ["chunk", "bucket", "bits", "n"])

    return sorted_groups(table.mapInArrow(run, PRINTS), ["bucket"], ["chunk"], meet, BITS)


def chunk_docs(chunk: Chunk, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(chunk.ends, at, side="right")


class Run:
    """The sorted run of a chunk: its distinct repeated strings with their smallest documents."""

    def __init__(self, chunk: Chunk, marks: list, buckets: int):
        at, doc, h = chunk.places()
        key = prints(h, buckets)
        distinct, which = np.unique(key, return_inverse=True)
        bucket = (distinct >> np.uint64(32)).astype(np.int64)
        repeats = np.zeros(len(distinct), bool)
        for m in marks:
            a, b = np.searchsorted(bucket, (m["bucket"], m["bucket"] + 1))
            repeats[a:b] = np.unpackbits(np.frombuffer(m["bits"], np.uint8), count=b - a).astype(bool)
        keep = repeats[which]
        self.at, self.doc = at[keep], doc[keep]
        strings = chunk.strings(self.at, self.doc)
        flat = strings.view(f"S{WIDTH}").ravel()
        order = np.argsort(flat, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = flat[order][1:] != flat[order][:-1]
        self.number = np.empty(len(order), np.int64)
        self.number[order] = np.cumsum(new) - 1
        self.strings = strings[order][new]
        self.least = np.minimum.reduceat(chunk.ids[self.doc][order], np.flatnonzero(new)) if len(order) else np.zeros(0, np.int64)


def shared(strings: np.ndarray) -> np.ndarray:
    """Bytes that each row shares with the one before; rows are distinct."""
    if not len(strings):
        return np.zeros(0, np.int64)
    return np.concatenate(([0], (strings[1:] != strings[:-1]).argmax(1)))


def front_coded(strings: np.ndarray) -> tuple[bytes, bytes]:
    lengths = shared(strings)
    return binary(lengths.astype(np.uint8)), squeezed(binary(strings[np.arange(strings.shape[1]) >= lengths[:, None]]), STRINGS_LEVEL)


def decoded(lengths: np.ndarray, rest: bytes) -> np.ndarray:
    inside = np.arange(WIDTH) >= lengths[:, None]
    out = np.zeros((len(lengths), WIDTH), np.uint8)
    out[inside] = np.frombuffer(unsqueezed(rest, int(inside.sum())), np.uint8)
    row = np.maximum.accumulate(np.where(inside, np.arange(len(lengths), dtype=np.int32)[:, None], 0), axis=0)
    return out[row, np.arange(WIDTH)]


def merged(runs: list[tuple[list[int], bytes]]) -> tuple[list[int], list[int]]:
    """Which run each string of the merged order comes from, and how many bytes it shares with the one before.

    ``runs`` are (shared lengths, strings of WIDTH bytes); each is sorted.
    """
    leaves = 1
    while leaves < max(2, len(runs)):
        leaves *= 2
    blobs, lengths = [b for _, b in runs], [x for x, _ in runs]
    sizes = [len(x) for x in lengths]
    place = [0] * len(runs)
    # A node's loser, and what it shares with the winner that passed; -1: no more strings.
    loser, known = [0] * leaves, [-1] * leaves
    source, out = [], []
    width = WIDTH

    def play(a: int, x: int, b: int, y: int) -> tuple[int, int, int, int]:
        """Winner and loser of two heads that share x and y bytes with the last output."""
        if x != y:
            return (a, x, b, y) if x > y else (b, y, a, x)
        if x < 0 or x == width:
            return (a, x, b, y) if a < b else (b, y, a, x)
        p, q = place[a] * width, place[b] * width
        left, right = blobs[a][p + x : p + width], blobs[b][q + x : q + width]
        if left == right:
            return (a, x, b, width) if a < b else (b, x, a, width)
        differ = int.from_bytes(left, "big") ^ int.from_bytes(right, "big")
        equal = width - (differ.bit_length() + 7) // 8
        return (a, x, b, equal) if left < right else (b, x, a, equal)

    heads = [(i, 0 if i < len(runs) and sizes[i] else -1) for i in range(leaves)]
    level = heads
    while len(level) > 1:
        half, up = len(level) // 2, []
        for i in range(half):
            a, x, b, y = play(*level[2 * i], *level[2 * i + 1])
            loser[half + i], known[half + i] = b, y
            up.append((a, x))
        level = up
    a, x = level[0]
    while x >= 0:
        source.append(a)
        out.append(x)
        place[a] += 1
        x = lengths[a][place[a]] if place[a] < sizes[a] else -1
        node = (leaves + a) >> 1
        while node:
            y = known[node]
            if x < y:
                a, loser[node] = loser[node], a
                x, known[node] = y, x
            elif x == y and x >= 0:
                a, x, loser[node], known[node] = play(a, x, loser[node], y)
            node >>= 1
    return source, out


def verdicts(strings: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """A bit for each string and offset of its gram: whether a document before ``least`` has that window.

    Strings are in order, ``lengths`` what each shares with the one before.
    """
    n = len(strings)
    new = lengths < WIDTH
    new[0] = True
    one = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    smallest = np.minimum.reduceat(least, one)
    common = lengths[one]
    grams = np.cumsum(common < GRAM)
    alone = np.bincount(grams)[grams] == 1
    every = np.uint32((1 << (LEFT + 1)) - 1)
    out = np.where(smallest[group] < least, every, np.uint32(0)).astype(np.uint32)
    some = np.flatnonzero(~alone)
    if not len(some):
        return out
    # Strings that share a gram with others: classes to the right from the order, to the left from a sort of those bytes.
    before = np.ascontiguousarray(strings[one[some]][:, SPAN:])
    flat = before.view(f"S{LEFT}").ravel()
    by_left = np.argsort(flat, kind="stable")
    differ = before[by_left][1:] != before[by_left][:-1]
    same_left = np.where(differ.any(1), differ.argmax(1), LEFT)
    member = np.full(len(one), -1)
    member[some] = np.arange(len(some))
    entries = np.flatnonzero(member[group] >= 0)
    mine = member[group[entries]]
    for offset in range(LEFT + 1):
        right = np.cumsum(common < SPAN - offset)[some]
        left = np.zeros(len(some), np.int64)
        left[by_left[1:]] = np.cumsum(same_left < offset)
        key = right * (len(some) + 1) + left
        order = np.argsort(key, kind="stable")
        begins = np.flatnonzero(np.concatenate(([True], key[order][1:] != key[order][:-1])))
        low = np.empty(len(some), np.int64)
        low[order] = np.repeat(np.minimum.reduceat(smallest[some][order], begins), np.diff(np.append(begins, len(some))))
        bit = np.uint32(1 << offset)
        out[entries] = np.where(low[mine] < least[entries], out[entries] | bit, out[entries] & ~bit)
    return out


SLICES = "range int, chunk long, first long, lengths binary, rest binary, least binary"
MASKS = "chunk long, first long, masks binary"


def sorted_slices(marked: DataFrame, splitters: list[bytes], buckets: int) -> DataFrame:
    """The chunks' sorted runs, cut at the splitters and front-coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bounds = np.array(splitters, f"S{GRAM}")
        for row in rows_of(batches):
            own = Run(Chunk(row), row["marks"], buckets)
            if not len(own.strings):
                continue
            grams = np.ascontiguousarray(own.strings[:, :GRAM]).view(f"S{GRAM}").ravel()
            of = np.searchsorted(bounds, grams, side="right") if len(bounds) else np.zeros(len(grams), np.int64)
            cuts = np.concatenate(([0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]))
            out = [(int(of[a]), row["chunk"], int(a), *front_coded(own.strings[a:b]), binary(own.least[a:b])) for a, b in zip(cuts, cuts[1:])]
            types = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], [f.split()[0] for f in SLICES.split(", ")])

    return marked.mapInArrow(run, SLICES)


def judged_slices(table: pa.Table) -> pa.Table:
    """Merge the slices of each range; the bits of each slice's strings that have any."""
    by: dict[int, list[int]] = {}
    for i, r in enumerate(table.column("range").to_pylist()):
        by.setdefault(r, []).append(i)
    out = []
    for rows in by.values():
        lengths = [np.frombuffer(table.column("lengths")[i].as_py(), np.uint8) for i in rows]
        strings = [decoded(x, table.column("rest")[i].as_py()) for x, i in zip(lengths, rows)]
        source, common = merged([(x.tolist(), s.tobytes()) for x, s in zip(lengths, strings)])
        # Rows of one run keep their order, so a stable sort by run gives the place of each in the merge.
        order = np.argsort(np.array(source), kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        least = np.concatenate([np.frombuffer(table.column("least")[i].as_py(), np.int64) for i in rows])
        bits = verdicts(np.concatenate(strings)[place], np.array(common, np.int64), least[place])
        for i, own in zip(rows, np.split(bits[order], np.cumsum([len(x) for x in lengths])[:-1])):
            if own.any():
                out.append((table.column("chunk")[i].as_py(), table.column("first")[i].as_py(), binary(own)))
    cells = list(zip(*out)) or [[]] * 3
    return pa.table([pa.array(c, t) for c, t in zip(cells, (pa.int64(), pa.int64(), pa.binary()))], ["chunk", "first", "masks"])


def covered(chunk: Chunk, run: Run, masks: list) -> np.ndarray:
    """Whether each byte of the chunk lies in a window that a smaller document has."""
    bits = np.zeros(len(run.strings), np.uint32)
    for m in masks or []:
        own = np.frombuffer(m["masks"], np.uint32)
        bits[m["first"] : m["first"] + len(own)] = own
    mine = bits[run.number]
    mine[chunk.ids[run.doc] > run.least[run.number]] = (1 << (LEFT + 1)) - 1
    start, end = (chunk.ends - chunk.sizes)[run.doc], chunk.ends[run.doc]
    windows = np.zeros(len(chunk.text) + 1, np.int32)
    for offset in range(LEFT + 1):
        a = run.at - offset
        windows[a[((mine >> np.uint32(offset)) & 1).astype(bool) & (a >= start) & (a + SPAN <= end)]] = 1
    total = np.cumsum(windows[:-1], dtype=np.int32)
    total[SPAN:] -= total[:-SPAN].copy()
    return total > 0


def remove_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (array of start, end: the removed byte runs), kept (the other bytes), for every row."""
    prepare(documents.sparkSession)
    table = cut(chunks(documents))
    whole = table.agg(F.count("*").alias("n"), F.sum("size").alias("size")).collect()[0]
    buckets = int((whole["size"] or 0) // BUCKET_BYTES) + 1
    bits = cut(repeated(table, buckets))
    strings = bits.agg(F.sum("n")).collect()[0][0] or 0
    ranges = int(strings // RANGE_STRINGS) + 1
    # A bounded sample of chunks gives the splitters; they decide on balance alone.
    share = max(1, -(-whole["n"] // SAMPLE_CHUNKS))
    sample = bits.where((F.col("bucket") == -1) & (F.abs(F.xxhash64("chunk")) % share == 0)).select("bits").limit(2 * SAMPLE_CHUNKS).collect()
    grams = sorted(row["bits"][i : i + GRAM] for row in sample for i in range(0, len(row["bits"]), GRAM))
    splitters = sorted({grams[len(grams) * i // ranges] for i in range(1, ranges)}) if grams else []

    marks = bits.where("bucket >= 0 and n > 0").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias("marks"))
    marked = table.join(marks, "chunk")
    slices = sorted_slices(marked, splitters, buckets)
    masks = sorted_groups(slices, ["range"], ["chunk", "first"], judged_slices, MASKS)
    masks = cut(masks.groupBy("chunk").agg(F.collect_list(F.struct("first", "masks")).alias("masks")))
    final = table.join(marks, "chunk", "left").join(masks, "chunk", "left")
    kind = documents.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            chunk = Chunk(row)
            gone = covered(chunk, Run(chunk, row["marks"], buckets), row["masks"]) if row["marks"] else np.zeros(len(chunk.text), bool)
            left = np.concatenate(([0], np.cumsum(~gone)))[np.concatenate(([0], chunk.ends))]
            kept = chunk.text[~gone].tobytes()
            # Runs of removed bytes, never across the end of a document.
            edge = np.zeros(len(gone) + 1, bool)
            edge[np.concatenate(([0], chunk.ends))] = True
            now, before = np.append(gone, False), np.concatenate(([False], gone))
            begin = np.flatnonzero(now & (~before | edge))
            end = np.flatnonzero(before & (~now | edge))
            doc = chunk_docs(chunk, begin)
            base = (chunk.ends - chunk.sizes)[doc]
            spans = pa.StructArray.from_arrays([pa.array(begin - base, pa.int64()), pa.array(end - base, pa.int64())], ["start", "end"])
            offsets = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=len(chunk.ids))))).astype(np.int32)
            ids = pa.array(chunk.ids, pa.int64(), mask=~chunk.known)
            texts = pa.array([kept[a:b] for a, b in zip(left.tolist(), left[1:].tolist())], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, pa.array(chunk.sizes), pa.ListArray.from_arrays(pa.array(offsets), spans), texts], ["doc_id", "n_bytes", "spans", "kept"])

    out = final.mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def repeat_report(documents: DataFrame) -> DataFrame:
    """The contract's row for every document."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return remove_repeats(documents).select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
