"""Language identification by prediction by partial matching (PPM).

For each language a variable-order byte context tree holds counts of the byte
that follows each context of 0 to ``order`` bytes. Escape method C: a byte seen
c times after a context with n bytes and d distinct ones costs
-log2(c / (n + d)) bits; one not seen there costs -log2(d / (n + d)) bits and
is coded after the next shorter context; below order 0 a byte costs 8 bits. A
context never seen passes down for nothing. The statistics are frozen, so the
code length of a text is a sum over its positions, and the language of the
shortest code wins.

Learning takes whole texts from a bounded random sample (``sample_bytes`` of
text in all, dealt evenly to the languages; chosen by a hash of doc_id), and
Spark counts the byte strings. The frozen costs have at most one row per
sampled byte and order, so they are small enough to broadcast by construction.

Defined results: null text or text without a letter: ``und``, score 0. Without
any learnable row every text is ``und``. Ties go to the language first in
alphabetical order. Repeated rows are each predicted; a null doc_id is held
out = false and never learned from. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, crc_mod, prepare

ORDER = 4
SAMPLE_BYTES = 2_000_000


def prepared(text: str, order: int) -> bytes:
    return b"\n" * order + text.lower().encode("utf-8", "replace")


def grams(data: np.ndarray, width: int) -> np.ndarray:
    """Every run of ``width`` bytes as one integer (width <= 8)."""
    out = np.zeros(len(data) - width + 1, np.uint64)
    for i in range(width):
        out = (out << np.uint64(8)) | data[i : len(data) - width + 1 + i].astype(np.uint64)
    return out


class Frozen:
    """Frozen code lengths of every language, one row per byte string seen in any of them."""

    def __init__(self, langs: list[str], order: int, rows: list[tuple[int, int, int]]):
        """rows: (language number, byte string of order + 1 bytes, count)."""
        self.langs, self.order = langs, order
        n = len(langs)
        lang, gram, count = (np.array(x, t) for x, t in zip(zip(*rows) if rows else ((), (), ()), (np.int64, np.uint64, np.float64)))
        self.levels = []
        for k in range(order, -1, -1):
            # Counts of strings of k + 1 bytes: sums over what stands before them.
            low = gram & np.uint64((1 << (8 * (k + 1))) - 1)
            keys, inverse = np.unique(low, return_inverse=True)
            seen = np.zeros((len(keys), n))
            np.add.at(seen, (inverse, lang), count)
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, of, seen)
            np.add.at(distinct, of, seen > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(distinct > 0, -np.log2(distinct / (total + distinct)), 0.0)
                cost = -np.log2(seen / (total + distinct)[of])
            self.levels.append([k, keys, seen, contexts, escape, of, cost])
        below = np.full(n, 8.0)
        for level in reversed(self.levels):  # a string seen in one language only gets its escaped cost in the others
            k, keys, seen, contexts, escape, of, cost = level
            shorter = self._cost_below(k, keys, below)
            level[6] = np.where(seen > 0, cost, escape[of] + shorter)
        self.levels = [(k, Table(keys), cost.astype(np.float32), Table(contexts), escape.astype(np.float32)) for k, keys, _, contexts, escape, _, cost in self.levels]

    def _cost_below(self, k: int, keys: np.ndarray, floor: np.ndarray) -> np.ndarray:
        """Costs of the same bytes with one byte less of context; every such shorter string is itself known."""
        if k == 0:
            return np.broadcast_to(floor, (len(keys), len(floor)))
        level = next(x for x in self.levels if x[0] == k - 1)
        short = keys & np.uint64((1 << (8 * k)) - 1)
        return level[6][np.searchsorted(level[1], short)]

    def costs(self, data: np.ndarray) -> np.ndarray:
        """Bits for each position after the first ``order`` bytes, by language."""
        full = grams(data, self.order + 1)
        out = np.zeros((len(full), len(self.langs)), np.float32)
        todo = np.arange(len(full))
        for k, table, cost, contexts, escape in self.levels:
            key = full[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            row = table.find(key)
            hit = row >= 0
            out[todo[hit]] += cost[row[hit]]
            todo, key = todo[~hit], key[~hit]
            row = contexts.find(key >> np.uint64(8))
            hit = row >= 0
            out[todo[hit]] += escape[row[hit]]
        out[todo] += 8.0
        return out


def learn(train: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> Frozen:
    """Frozen statistics from ``train`` (doc_id, text, lang; no nulls)."""
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    langs = sorted(k for k, n in sizes.items() if n)
    if not langs:
        return Frozen([], order, [])
    share = sample_bytes / len(langs)
    limit = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(share / sizes[k]))])
    number = F.create_map(*[x for i, k in enumerate(langs) for x in (F.lit(k), F.lit(i))])
    chosen = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)) < F.element_at(limit, F.col("lang"))
    sample = train.where(F.col("lang").isin(langs) & chosen).select(F.element_at(number, F.col("lang")).alias("lang"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[int, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = np.frombuffer(prepared(text, order), np.uint8)
                if len(data) > order:
                    by.setdefault(lang, []).append(grams(data, order + 1))
            for lang, parts in by.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), lang, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n)], ["lang", "gram", "n"])

    counted = sample.mapInArrow(count, "lang int, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counted.toPandas()  # at most one row per sampled byte
    return Frozen(langs, order, list(zip(rows["lang"], rows["gram"].astype("uint64"), rows["n"])))


def predict(docs: DataFrame, model: Frozen) -> DataFrame:
    """doc_id, held_out, lang_pred, score for ``docs`` (doc_id, text, held_out, letters)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frozen = shared.value
        langs, order = frozen.langs, frozen.order
        for batch in batches:
            texts, letters = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            pred, score = ["und"] * len(texts), np.zeros(len(texts))
            rows = [i for i, ok in enumerate(letters) if ok] if langs else []
            for part in parts([(i, prepared(texts[i], order)) for i in rows]):
                starts = np.cumsum([0] + [len(x) for _, x in part])[:-1]
                costs = frozen.costs(np.frombuffer(b"".join(x for _, x in part) + b"\n" * order, np.uint8))
                # A text's positions begin behind its own padding, so that no byte is coded after another text.
                own = np.add.reduceat(costs, starts, axis=0, dtype=np.float64)
                ends = np.array([len(x) for _, x in part]) - order
                for j, (i, x) in enumerate(part):
                    if order:
                        tail = costs[starts[j] + ends[j] : starts[j] + len(x)]
                        own[j] -= tail.sum(axis=0, dtype=np.float64)
                    best = int(np.argmin(own[j]))
                    pred[i] = langs[best]
                    score[i] = 1.0 / np.exp2(np.clip(own[j][best] - own[j], -1000, 0)).sum()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text", "letters").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def parts(items: list[tuple[int, bytes]], most: int = 1 << 19) -> Iterator[list[tuple[int, bytes]]]:
    """Texts in runs of about ``most`` bytes (a longer text stands alone), to bound the arrays of a step."""
    run, size = [], 0
    for item in items:
        if run and size + len(item[1]) > most:
            yield run
            run, size = [], 0
        run.append(item)
        size += len(item[1])
    if run:
        yield run


def language_id(documents: DataFrame, order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """Learn from the rows whose crc32(doc_id) mod 4 is not 2 and predict every row."""
    prepare(documents.sparkSession)
    part = crc_mod(F.col("doc_id"), 4)
    train = documents.select("doc_id", "text", "lang").where((part != 2) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    model = learn(train, order, sample_bytes)
    docs = documents.select(
        "doc_id",
        F.coalesce(part == 2, F.lit(False)).alias("held_out"),
        "text",
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"),
    )
    return predict(docs, model)
