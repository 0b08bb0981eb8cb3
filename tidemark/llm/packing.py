"""Best-fit packing of token sequences by fitted length patterns.

1. Every text becomes ids; pieces of at most ``size`` ids are cut from it.
2. The histogram of piece lengths (at most ``size`` rows, whatever the corpus)
   goes to the driver. All patterns of up to three lengths that add up to
   ``size`` are enumerated, and non-negative least squares finds how often to
   repeat each so that together they use up the histogram. The repeats are
   rounded, the most repeated first, against what is still there.
3. What the rounded patterns leave over, still a histogram, is packed best-fit
   decreasing, whole counts at a time, which gives further patterns.
4. Patterns with repeat counts are a plan of bounded size. Each piece gets its
   rank among the pieces of its length (counted by Spark in hash buckets, so
   that a length held by a third of all pieces is still ranked by many tasks)
   and looks up its sequence and place there.

A piece's place in the plan is a pure function of checkpointed rows, so tasks
can be run again anywhere.

Defined results: null or empty text has the one id 0 that ends every text.
Repeated rows are each packed. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare
from tidemark.llm.word_pieces import encoder

SIZE = 2048
BUCKETS = 256
RESERVE = 10


def pieces(documents: DataFrame, path: str, size: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece."""
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, step, end = encoder(path), 4 * size, bytes(4)
        for batch in batches:
            if not batch.num_rows:
                continue
            row, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode(batch.column(1).to_pylist())):
                ids += end
                for k, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    row.append(i), piece.append(k), start.append(at // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def full_patterns(lengths: np.ndarray, size: int) -> np.ndarray:
    """All patterns of one to three of the lengths that add up to ``size``; rows of three, unused places 0."""
    there = np.zeros(size + 1, bool)
    there[lengths] = True
    out = [np.array([[size, 0, 0]])] if there[size] else []
    a = lengths[lengths * 2 >= size]
    a = a[(a < size)]
    a = a[there[size - a]]
    out.append(np.stack([a, size - a, np.zeros_like(a)], 1))
    for c in lengths[lengths * 3 <= size]:
        b = lengths[(lengths >= c) & (lengths * 2 <= size - c)]
        a = size - c - b
        ok = there[a]
        out.append(np.stack([a[ok], b[ok], np.full(ok.sum(), c)], 1))
    return np.concatenate(out)


def fit_repeats(patterns: np.ndarray, counts: np.ndarray, steps: int = 400) -> np.ndarray:
    """Non-negative least squares of pattern repeats to the histogram, by accelerated projected gradient.

    Column p of the matrix holds how often pattern p uses each length, so the
    gradient of a pattern is the sum of the residuals at its lengths.
    """
    if not len(patterns):
        return np.zeros(0)
    scale = counts.sum()
    target = counts / scale
    used = patterns > 0
    # A bound on the largest eigenvalue: largest row sum times largest column sum.
    rows = np.bincount(patterns[used], minlength=len(counts)).max()
    rate = 1.0 / (3.0 * rows)
    x = np.zeros(len(patterns))
    y, t = x, 1.0
    for _ in range(steps):
        made = np.zeros(len(counts))
        for j in range(3):
            made += np.bincount(patterns[:, j], y, minlength=len(counts))
        residual = target - made
        residual[0] = 0.0
        gradient = residual[patterns[:, 0]] + residual[patterns[:, 1]] + residual[patterns[:, 2]]
        new = np.maximum(0.0, y + rate * gradient)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        if (new - x) @ gradient < 0:
            y, t_new = new, 1.0
        x, t = new, t_new
    return x * scale


def best_fit(left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on a histogram: sequences with the same content move together."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}  # free space -> content -> how many
    done: dict[tuple[int, ...], int] = {}
    for length in range(size, 0, -1):
        todo = int(left[length])
        while todo:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                # As many of this length as fit are laid into a new sequence.
                each = min(todo, size // length)
                content, free = (length,) * each, size - each * length
                n = todo // each
                todo -= n * each
            else:
                group = open_[room]
                old, have = next(iter(group.items()))
                each = min(room // length, todo)
                n = min(have, todo // each)
                content, free = old + (length,) * each, room - each * length
                todo -= n * each
                if n == have:
                    del group[old]
                    if not group:
                        del open_[room]
                else:
                    group[old] = have - n
            to = open_.setdefault(free, {}) if free else done
            to[content] = to.get(content, 0) + n
    for group in open_.values():
        for content, n in group.items():
            done[content] = done.get(content, 0) + n
    return list(done.items())


def rounded(patterns: np.ndarray, repeats: np.ndarray, counts: np.ndarray) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Whole repeats of the fitted patterns, and the counts left over.

    Patterns are taken from the most repeated on: first each by the whole part of its
    fitted repeats, then again by as much as the counts still allow, so that repeats below one,
    of which a fit over many patterns has most, are rounded against what is left
    and not all down to nothing. One piece in ``RESERVE`` of each length stays
    out: best-fit needs some of every length to fill up what the patterns leave.
    """
    left = counts - (counts + RESERVE - 1) // RESERVE
    kept, out = counts - left, []
    order = np.argsort(-repeats, kind="stable")
    order = order[repeats[order] > 0]
    own = [tuple(v for v in p if v) for p in patterns[order].tolist()]
    whole = np.floor(repeats[order]).astype(np.int64).tolist()
    have = left.tolist()
    for limits in (whole, [None] * len(own)):
        for content, limit in zip(own, limits):
            n = min(have[v] // content.count(v) for v in content)
            n = n if limit is None else min(n, limit)
            if n > 0:
                for v in content:
                    have[v] -= n
                out.append((content, n))
    return out, np.array(have, np.int64) + kept


def plan(counts: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with repeat counts that use up the histogram (counts[length]) exactly.

    Whole pieces of ``size`` are sequences of their own. If best-fit alone needs fewer sequences than fitted
    patterns with best-fit for the rest, its patterns are taken: the plan is never worse than either.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    short = counts.copy()
    short[size] = 0
    whole = [((size,), int(counts[size]))] if counts[size] else []
    patterns = full_patterns(lengths[lengths < size], size) if short.any() else np.zeros((0, 3), np.int64)
    fitted, left = rounded(patterns, fit_repeats(patterns, short.astype(float)), short)
    plans = [fitted + best_fit(left, size), best_fit(short, size)]
    return whole + min(plans, key=lambda p: sum(n for _, n in p))


class Places:
    """Where the r-th piece of a length goes: runs of ranks, each with its first sequence and its offset."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]], size: int):
        ranks, first, rows = np.zeros(size + 1, np.int64), 0, []
        for content, n in patterns:
            offset = 0
            for length in content:  # equal lengths of a pattern take one run of ranks each
                rows.append((length, int(ranks[length]), first, offset))
                ranks[length] += n
                offset += length
            first += n
        rows.sort()
        table = np.array(rows, np.int64).reshape(-1, 4)
        self.length, self.rank, self.first, self.offset = table.T
        self.key = self.length * (1 << 48) + self.rank

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, length * (1 << 48) + rank, side="right") - 1
        return self.first[at] + rank - self.rank[at], self.offset[at]


def packing(documents: DataFrame, tokenizer: str | None = None, size: int = SIZE) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every text."""
    spark = prepare(documents.sparkSession, 2048)
    table = cut(pieces(documents, tokenizer or public_tokenizers.path("word_bpe_49k.json"), size).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(BUCKETS)).cast("int")))
    by_bucket = cut(table.groupBy("length", "bucket").agg(F.count("*").alias("n")))
    counts = np.zeros(size + 1, np.int64)
    for row in by_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(Places(plan(counts, size), size))

    earlier = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    # At most size x BUCKETS rows.
    before = by_bucket.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = table.withColumn("inside", F.row_number().over(inside)).join(F.broadcast(before), ["length", "bucket"])
    kind = table.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = places.value.find(batch.column(3).to_numpy(), batch.column(5).to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("inside") - 1).alias("rank")).mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
