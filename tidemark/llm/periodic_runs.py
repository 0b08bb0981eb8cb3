"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a stretch of words with smallest period q and at least ``MIN_POWERS`` * q
(and ``MIN_LENGTH``) words that can't be extended with period q.

1. Harmonic grid. A run of 4 * q words holds four neighbouring multiples of q,
   and their words are equal. For each q the words at the multiples of q are
   compared, in all documents of a batch that are long enough: n / 1 + n / 2 +
   ... comparisons, done as strided slices. Four equal words in a row make a
   candidate (place, q).
2. Extensions. How far the words at a place and q words on agree, forwards and
   backwards, bounds the run. The documents that have candidates are sorted by
   their suffixes at the places of a difference cover only: for any two places
   there is a distance of less than V words after which both are sampled, so an
   extension is a few words compared, and then a range minimum over the common
   prefixes of neighbours in that order, from a sparse table.
3. A stretch found for a multiple of its smallest period is the same stretch, so
   of equal stretches the one of the smallest period stays.

Every document is judged by itself, in the task that reads it: nothing is
shuffled. Texts of a batch share one order of suffixes, parted by words that
occur nowhere else.

Defined results: null and empty texts have no runs; other columns are ignored
(``doc_id`` is passed through, null or repeated ids too).
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare

MIN_LENGTH, MIN_POWERS = 6, 4
CHUNK = 400_000
QUERIES = 1_000_000
# A difference cover modulo 31 (every difference modulo 31 occurs once).
V = 31
COVER = np.array([1, 5, 11, 24, 25, 27])


def synchronised() -> np.ndarray:
    """For two places modulo V, the least distance after which both are in the cover."""
    inside = np.zeros(V, bool)
    inside[COVER] = True
    a, b, d = np.ogrid[:V, :V, :V]
    both = inside[(a + d) % V] & inside[(b + d) % V]
    assert both.any(2).all()
    return both.argmax(2)


SHIFT = synchronised()


class Extensions:
    """Longest common extensions of words behind any two places of ``x``, which must end in a word that occurs once."""

    def __init__(self, x: np.ndarray):
        n, m = len(x), len(COVER)
        top = int(x.max()) + 1
        # Two blocks of words that differ from all others and from each other, so that no place reaches out.
        self.x = np.concatenate((x, top + np.arange(2 * V)))
        count = (n // V + 1) * m
        self.place = np.arange(count) // m * V + COVER[np.arange(count) % m]
        self.number = np.full(V, -1)
        self.number[COVER] = np.arange(m)
        ranks = [self.blocks()]
        step = m
        while int(ranks[-1].max()) + 1 < count:
            now = ranks[-1]
            behind = np.zeros(count, np.int64)
            behind[: max(0, count - step)] = now[step:] + 1
            ranks.append(np.unique(now * (count + 1) + behind, return_inverse=True)[1])
            step *= 2
        self.rank = ranks[-1]
        order = np.argsort(self.rank, kind="stable")
        self.low = [self.common(order, ranks)]
        while 2 ** len(self.low) < count:
            last, half = self.low[-1], 2 ** (len(self.low) - 1)
            self.low.append(np.minimum(last[:-half], last[half:]) if len(last) > half else last[:0])

    def blocks(self) -> np.ndarray:
        """Ranks of the sampled places by their first V words."""
        bits = max(1, int(self.x.max()).bit_length())
        pack = max(1, 62 // bits)
        keys = []
        for first in range(0, V, pack):
            key = np.zeros(len(self.place), np.int64)
            for d in range(first, min(first + pack, V)):
                key = (key << bits) | self.x[self.place + d]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), bool)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.zeros(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def common(self, order: np.ndarray, ranks: list[np.ndarray]) -> np.ndarray:
        """Common words of each sampled suffix and the next one in order."""
        a, b = order[:-1].copy(), order[1:].copy()
        out, count, m = np.zeros(len(a), np.int64), len(order), len(COVER)
        for level in range(len(ranks) - 1, -1, -1):
            inside = np.flatnonzero((a < count) & (b < count))
            same = inside[ranks[level][a[inside]] == ranks[level][b[inside]]]
            a[same] += m << level
            b[same] += m << level
            out[same] += V << level
        # Beyond the last sampled place all words differ.
        inside = np.flatnonzero((a < count) & (b < count))
        left, right = self.place[a[inside]], self.place[b[inside]]
        for d in range(V):
            same = self.x[left + d] == self.x[right + d]
            inside, left, right = inside[same], left[same], right[same]
            if not len(inside):
                break
            out[inside] += 1
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Number of equal words from places i and j on (i and j differ)."""
        shift = SHIFT[i % V, j % V]
        out, live = np.zeros(len(i), np.int64), np.arange(len(i))
        done = np.zeros(len(i), bool)
        for d in range(int(shift.max(initial=0))):
            live = live[shift[live] > d]
            same = self.x[i[live] + d] == self.x[j[live] + d]
            done[live[~same]] = True
            live = live[same]
            out[live] += 1
        rest = np.flatnonzero(~done)
        a, b = i[rest] + shift[rest], j[rest] + shift[rest]
        m = len(COVER)
        inside = (a < len(self.x) - 2 * V) & (b < len(self.x) - 2 * V)
        rest, a, b = rest[inside], a[inside], b[inside]
        a, b = (self.rank[p // V * m + self.number[p % V]] for p in (a, b))
        a, b = np.minimum(a, b), np.maximum(a, b)
        level = np.frexp((b - a).astype(np.float64))[1] - 1
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            low = self.low[k]
            out[rest[at]] += np.minimum(low[a[at]], low[b[at] - 2**k])
        return out


def candidates(x: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods whose grid words are equal four times; documents lie in ``x`` from the longest on, each with a word behind it."""
    ends = np.cumsum(sizes + 1)
    longest = int(sizes[0]) if len(sizes) else 0
    long_enough = np.searchsorted(-sizes, -np.maximum(MIN_LENGTH, MIN_POWERS * np.arange(longest // MIN_POWERS + 1)), side="right")
    for q in range(1, longest // MIN_POWERS + 1):
        if not long_enough[q]:
            break
        grid = x[: ends[long_enough[q] - 1] : q]
        same = grid[1:] == grid[:-1]
        if len(same) >= 3:
            at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:])
            if len(at):
                yield at * q, np.full(len(at), q)


def runs_of(documents: list[np.ndarray]) -> list[np.ndarray]:
    """Rows (start, length, period), by start and then period, for each document of word numbers."""
    out = [np.zeros((0, 3), np.int64)] * len(documents)
    sizes = np.array([len(d) for d in documents], np.int64)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= MIN_LENGTH]
    if not len(order):
        return out
    words = 1 + max(int(documents[i].max()) for i in order)
    x = np.concatenate([part for n, i in enumerate(order) for part in (documents[i], [words + n])]).astype(np.int64)
    sizes = sizes[order]
    starts = np.cumsum(sizes + 1) - sizes - 1

    found: list[np.ndarray] = []
    held, size = [], 0
    for place, q in candidates(x.astype(np.int32) if x.max() < 2**31 else x, sizes):
        held.append((place, q))
        size += len(place)
        if size >= QUERIES:
            found.append(extended(x, starts, sizes, held))
            held, size = [], 0
    if held:
        found.append(extended(x, starts, sizes, held))
    if not found:
        return out
    rows = np.unique(np.concatenate(found), axis=0)  # document, start, end, period: of equal stretches the smallest period is first
    rows = rows[np.concatenate(([True], (rows[1:, :3] != rows[:-1, :3]).any(1)))[: len(rows)]]
    rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    for own in np.split(rows, np.flatnonzero(rows[1:, 0] != rows[:-1, 0]) + 1):
        if len(own):
            out[order[own[0, 0]]] = np.stack([own[:, 1], own[:, 2] - own[:, 1], own[:, 3]], 1)
    return out


def extended(x: np.ndarray, starts: np.ndarray, sizes: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Rows (document, start, end, period) of the candidates that are long enough; only their documents are sorted."""
    place, q = (np.concatenate(c) for c in zip(*held))
    doc = np.searchsorted(starts, place, side="right") - 1
    inside = place - starts[doc] + q < sizes[doc]
    place, q, doc = place[inside], q[inside], doc[inside]
    own = np.unique(doc)
    if not len(own):
        return np.zeros((0, 4), np.int64)
    part = np.concatenate([x[starts[d] : starts[d] + sizes[d] + 1] for d in own])
    begins = np.cumsum(sizes[own] + 1) - sizes[own] - 1
    at = place - starts[doc] + begins[np.searchsorted(own, doc)]
    n = len(part)
    part = np.unique(part, return_inverse=True)[1]
    after = Extensions(part)(at, at + q)
    # Backwards: the words before the place, in the text read from its end, with the parting words behind each document again.
    back = np.concatenate((part[-2::-1], part[-1:]))
    before = Extensions(back)(n - 1 - at, n - 1 - at - q)
    first = at == 0  # nothing lies before the first word of all
    before[first] = 0
    start, end = at - before, at + q + after
    ok = (end - start >= MIN_LENGTH) & (end - start >= MIN_POWERS * q)
    start, end, base = start[ok], end[ok], begins[np.searchsorted(own, doc[ok])]
    return np.unique(np.stack([doc[ok], start - base, end - base, q[ok]], 1), axis=0)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words without those that a run repeats after its first period."""
    if not len(runs):
        return b" ".join(words)
    mark = np.zeros(len(words) + 1, np.int64)
    np.add.at(mark, runs[:, 0] + runs[:, 2], 1)
    np.add.at(mark, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(mark)[:-1] == 0).tolist()])


def planted(doc_id, words: list[bytes]) -> list[bytes]:
    """The contract's repeats: from a word on, a tenth of the documents repeat a stretch of their own."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def periodic_runs(documents: DataFrame, change: Callable | None = None) -> DataFrame:
    """doc_id, runs (array of start, length, period), collapsed (text without what the runs repeat), for every row.

    ``change(doc_id, words)`` may give other words for a document before it is searched.
    """
    prepare(documents.sparkSession)
    key = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words, size, begin = batch.column(0).to_pylist(), [], 0, 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                own = (text or "").encode("utf-8", "replace").split()
                words.append(change(ids[i], own) if change else own)
                size += len(own)
                if size >= CHUNK:
                    yield judged(batch.column(0).slice(begin, len(words)), words)
                    words, size, begin = [], 0, i + 1
            if words:
                yield judged(batch.column(0).slice(begin, len(words)), words)

    def judged(ids: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        numbers: dict[bytes, int] = defaultdict()
        numbers.default_factory = numbers.__len__
        found = runs_of([np.fromiter(map(numbers.__getitem__, w), np.int64, len(w)) for w in words])
        texts = pa.array([collapsed(w, r) for w, r in zip(words, found)], pa.binary()).cast(pa.string())
        flat = np.concatenate(found)
        names = ["start", "length", "period"]
        cells = pa.StructArray.from_arrays([pa.array(flat[:, c], pa.int64()) for c in range(3)], names)
        offsets = np.concatenate(([0], np.cumsum([len(r) for r in found]))).astype(np.int32)
        return pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(offsets), cells), texts], ["doc_id", "runs", "collapsed"])

    schema = f"doc_id {key}, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def run_report(documents: DataFrame) -> DataFrame:
    """The contract's row for every document, after its repeats are planted."""
    found = periodic_runs(documents, planted)
    # Greatest length, then smallest start, then smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
