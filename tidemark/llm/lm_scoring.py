"""Language-model scores from a hierarchical Pitman-Yor model.

Tokens are words (A-Z lower-cased) and one end for each text. The context of a
token is the whole word before it (at the start of a text: the end of another).
Every context has a restaurant; all of them share one parent restaurant, whose
base is uniform over the V training tokens and one unknown. In a restaurant
with discount d and strength h

    p(w) = (c_w - d t_w + (h + d T) p_parent(w)) / (h + C)

with customers c, tables t and their totals C, T. A context's tables are the
parent's customers.

Seating is sampled by Gibbs. What binds the words of a restaurant together is
one number each, drawn as a variable of its own, given which words are
independent, so that words can be sampled in any order or place and each draw
is from its exact conditional distribution (S: generalised Stirling numbers):

- A context with T tables draws g from Gamma(h/d + T). Table counts of its
  words are then independent, with weights S(c, t) (d g b_w)^t, where b is the
  parent's distribution, itself drawn.
- The parent has a time y and a mass for each word, of sum Z. With C customers
  now, y is scaled by (Gamma(h + C) / Z)^d. Tables of its words have weights
  S(c, t) (d y / (V + 1))^t, then y is drawn from Gamma(h/d + T), then each
  word's mass as Gamma(c - d t) and a tilted stable variable of time
  y / (V + 1), for what lies at no table. b is the masses by their sum.
  (Pitman-Yor as a generalised gamma process whose time is a gamma variable.)

Weights are tabulated up to ``STIRLING`` customers; above that the same
distribution is drawn by rejection, see ``many``. The score uses the mean of
the predictive probabilities of ``SAMPLES`` seatings, each with its own totals,
after ``SWEEPS`` others. Discounts are set from counts of counts, strengths are
``STRENGTH``.

On Spark: counts of (word, context) are summed in each task and dealt out by
word, packed in a block for each bucket of words that numbers its own contexts.
The parent's counts of a word are in one place then. A sweep sends each block's
tables by context to the context's bucket, where they are added up and g is
drawn, and g back to the blocks; only sums of few numbers go to the driver.
Words and contexts travel as 64-bit hashes.

To score, the (word, context) pairs with most occurrences are broadcast (at most
``head_pairs``, a fixed bound) and summed where the text is read, so that no
hot pair is shuffled. Other occurrences are dealt out by word to meet
their block, and come back as partial sums, one row for each chunk of texts and
bucket of words. What a block has no context for goes on, with the parent's
probabilities, to the bucket of the context.

Learning covers every row whose crc32(doc_id) mod 10 is not 0; nothing is
capped or sampled.

Defined results: null text counts as empty, one token. A null doc_id is not
held out. Without any training row every probability is 1 and every score 0.
Repeated rows count and are scored each. Other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from copy import copy
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Table, crc_mod, cut, prepare, sorted_groups

CONTEXTS = 1024  # room for contexts in the totals of a model that is held in one place
SAMPLES = 3
SWEEPS = 2
STRENGTH = 1.0
HEAD_PAIRS = 1_000_000
CHUNK = 2_500_000
BLOCK_BYTES = 16 << 20  # of text, for each block
STIRLING = 512
CODEC = "zstd"
END = xxhash.xxh64_intdigest(b"\n")  # no word holds a line feed

SUMS = ["of", "known", "bases", "scores"]  # texts of a chunk by number, and what is added to each
CELLS = ["words", "ends", "ctx", "count", "ctxs", "t"]
PACKED = "bucket int, kind int, part int, total double, " + ", ".join(f"{c} binary" for c in CELLS)
# Kinds of rows. BLOCK: pairs of a bucket of words; STATE: the parent's customers by word (total: all of them); DOWN: what
# context bucket ``part`` says of a block's contexts; SEATED: tables by pair after sweep ``part``; UP: a block's (``part``)
# sums by context; SHARES: weights of the parent by context; ASK: occurrences to be scored; TEXT: a text, or sums for texts.
BLOCK, STATE, DOWN, SEATED, UP, SHARES, ASK, TEXT = range(8)


class Chunk:
    """Tokens of a run of texts: place of the word in ``hashes``, context, and number of the text."""

    def __init__(self) -> None:
        self.ids: dict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.tokens: list[np.ndarray] = []
        self.sizes: list[int] = []
        self.n = 0

    def add(self, text: str) -> int:
        words = text.encode("utf-8", "replace").lower().split()
        words.append(b"\n")
        self.tokens.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.sizes.append(len(words))
        self.n += len(words)
        return len(words)

    def done(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """hashes of the distinct words in order; word, context (both by place in them) and text number of every token."""
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter(map(digest, self.ids), np.uint64, len(self.ids))
        hashes, place = np.unique(hashes, return_inverse=True)
        word = place[np.concatenate(self.tokens)]
        sizes = np.array(self.sizes)
        context = np.roll(word, 1)  # a text's first word comes after the end of the one before, or of the last
        return hashes, word, context, np.repeat(np.arange(len(sizes)), sizes)


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of hashes, so what is in order of hashes is in order of buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def slices(hashes: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of sorted hashes."""
    ends = np.searchsorted(bucket_of(hashes, buckets), np.arange(buckets), side="right").tolist()
    return [(k, a, b) for k, (a, b) in enumerate(zip([0, *ends], ends)) if b > a]


def shut(x: np.ndarray) -> bytes:
    """Numbers, compressed byte place by byte place; hashes, which are in order, by their steps."""
    x = np.diff(x, prepend=np.uint64(0)) if x.dtype == np.uint64 else x
    planes = np.ascontiguousarray(np.ascontiguousarray(x).reshape(-1).view(np.uint8).reshape(-1, x.itemsize).T) if x.size else x
    return np.int64(x.nbytes).tobytes() + pa.Codec(CODEC, compression_level=1).compress(planes.tobytes(), asbytes=True)


def opened(cell: bytes, kind: type) -> np.ndarray:
    size, item = int(np.frombuffer(cell, np.int64, 1)[0]), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.Codec(CODEC).decompress(cell[8:], size, asbytes=True), np.uint8) if size else np.zeros(0, np.uint8)
    x = np.ascontiguousarray(planes.reshape(item, -1).T).reshape(-1).view(kind)
    return np.cumsum(x, dtype=np.uint64) if x.dtype == np.uint64 else x


def block(w: np.ndarray, c: np.ndarray, n: np.ndarray) -> dict[str, np.ndarray]:
    """Rows (word, context, number), sorted: distinct words, where each one's rows end, numbers of contexts and the contexts."""
    ctxs, ctx = np.unique(c, return_inverse=True)
    ends = np.flatnonzero(np.concatenate((w[1:] != w[:-1], np.ones(min(1, len(w)), bool)))) + 1
    return {"words": w[ends - 1], "ends": ends.astype(np.int32), "ctx": ctx.astype(np.uint32), "count": n.astype(np.uint32), "ctxs": ctxs}


def rows_of(rows: list[dict]) -> pa.RecordBatch:
    """Rows of ``PACKED``; arrays are compressed, what is missing is null."""
    kinds = {"bucket": pa.int32(), "kind": pa.int32(), "part": pa.int32(), "total": pa.float64()} | dict.fromkeys(CELLS, pa.binary())
    value = lambda x: shut(x) if isinstance(x, np.ndarray) else x
    return pa.RecordBatch.from_arrays([pa.array([value(r.get(c)) for r in rows], t) for c, t in kinds.items()], list(kinds))


TYPES = {"words": np.uint64, "ends": np.int32, "ctx": np.uint32, "count": np.uint32, "ctxs": np.uint64, "t": np.uint32}


def plain(row: dict) -> dict:
    """A row with its arrays' bytes."""
    return row | {c: opened(row[c], kind).tobytes() for c, kind in TYPES.items() if row.get(c) is not None}


def counts(docs: DataFrame, buckets: int) -> DataFrame:
    """Blocks of (word, context, count), summed over each chunk of texts."""

    def packed(chunk: Chunk) -> pa.RecordBatch:
        hashes, word, context, _ = chunk.done()
        pairs, n = np.unique(word.astype(np.int64) * len(hashes) + context, return_counts=True)
        w, c = hashes[pairs // len(hashes)], hashes[pairs % len(hashes)]
        return rows_of([{"bucket": k, "kind": BLOCK, **block(w[a:b], c[a:b], n[a:b])} for k, a, b in slices(w, buckets)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                chunk.add(text)
                if chunk.n >= CHUNK:
                    yield packed(chunk)
                    chunk = Chunk()
        if chunk.n:
            yield packed(chunk)

    return docs.select("text").mapInArrow(run, PACKED)


def unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """words, ends, ctx (in two bytes or four) and count of a plain row."""
    wide = np.uint32 if len(row["ctx"]) == len(row["count"]) else np.uint16
    return np.frombuffer(row["words"], np.uint64), np.frombuffer(row["ends"], np.int32), np.frombuffer(row["ctx"], wide), np.frombuffer(row["count"], np.uint32)


def by_bucket(table: pa.Table) -> Iterator[list[dict]]:
    """The rows of each bucket, in order; a row's arrays stay compressed."""
    rows = table.to_pylist()
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i]["bucket"] != rows[start]["bucket"]:
            yield rows[start:i]
            start = i


def merged(packed: DataFrame) -> DataFrame:
    """One block for each bucket: the chunks' counts added up."""

    def add(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            w, c, n = [], [], []
            for row in map(plain, rows):
                words, ends, ctx, count = unpack(row)
                w.append(np.repeat(words, np.diff(ends, prepend=0)))
                c.append(np.frombuffer(row["ctxs"], np.uint64)[ctx])
                n.append(count)
            w, c, n = np.concatenate(w), np.concatenate(c), np.concatenate(n).astype(np.int64)
            order = np.lexsort((c, w))
            w, c, n = w[order], c[order], n[order]
            first = np.flatnonzero(np.concatenate(([True], (w[1:] != w[:-1]) | (c[1:] != c[:-1]))))
            out.append(rows_of([{"bucket": rows[0]["bucket"], "kind": BLOCK, **block(w[first], c[first], np.add.reduceat(n, first))}]))
        return pa.Table.from_batches(out)

    return sorted_groups(packed, ["bucket"], [], add, PACKED)


@lru_cache
def log_stirling(d: float) -> np.ndarray:
    """log S[c, t], the weight of all seatings of c customers at t tables."""
    out = np.full((STIRLING + 1, STIRLING + 1), -np.inf)
    out[0, 0] = 0.0
    for c in range(STIRLING):
        t = np.arange(1, c + 2)
        stay = np.full(c + 1, -np.inf)
        np.log(c - d * t, out=stay, where=c - d * t > 0)
        out[c + 1, t] = np.logaddexp(out[c, t - 1], out[c, t] + stay)
    return out


def lgamma(x: np.ndarray) -> np.ndarray:
    """log of the gamma function of positive numbers."""
    x = np.asarray(x, float)
    low = np.ones_like(x)
    y = x
    for _ in range(10 if (x < 10).any() else 0):
        low = np.where(y < 10, low * y, low)
        y = np.where(y < 10, y + 1, y)
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z * (1 / 1680 - z / 1188)))) / y - np.log(low)


def seated_crp(c: np.ndarray, d: float, strength: np.ndarray, rng) -> np.ndarray:
    """Tables of c customers of a Pitman-Yor restaurant.

    Customers are seated one by one, 64 at a time; those of the others who come to none of the tables so far are a
    beta-binomial number, and are a restaurant of their own whose strength is greater by d for each table so far.
    """
    t, strength, left = np.zeros(len(c), np.int64), strength.astype(float), c.astype(np.int64)
    at = np.arange(len(c))
    while len(at):
        own = np.ones(len(at), np.int64)
        h, size = strength[at], np.minimum(left[at], 64)
        for i in range(1, int(size.max())):
            own += (i < size) & (rng.random(len(at)) * (h + i) < h + d * own)
        t[at] += own
        strength[at] = h + d * own
        left[at] = rng.binomial(left[at] - size, rng.beta(h + d * own, size - d * own))
        at = at[left[at] > 0]
    return t


def thinning(c: np.ndarray, t: np.ndarray, d: float) -> np.ndarray:
    """S(c, t) by its value for ever more customers, Gamma(c - d) / (Gamma(1 - d) d^(t - 1) (t - 1)!).

    One for t = 1, and at most f^(t - 1), f being one or the square of what t = 2 has, if that is more (see the tests).

    The numbers' alternating sum; term j is about (t c^-d)^j j!^(d - 1), so t c^-d has to be small.
    """
    out = np.zeros(len(c))
    for j in range(90):
        x = (j + 1) * d
        some = t > j
        if not some.any():
            break
        tt, cc = t[some].astype(float), c[some].astype(float)
        size = lgamma(tt) - lgamma(np.full(1, j + 1.0)) - lgamma(tt - j) + lgamma(cc - x) - lgamma(cc - d) + lgamma(np.array([1 - d])) + lgamma(np.array([x]))
        out[some] += (-1) ** j * np.sin(np.pi * x) / np.pi * np.exp(size)
        if j > 20 and size.max() < -40:
            break
    return out


def many(c: np.ndarray, a: np.ndarray, d: float, rng) -> np.ndarray:
    """As ``draw_tables`` for many customers, by rejection.

    Where a / d is small for so many customers, 1 + Poisson(a / d) is proposed, which is the distribution for
    ever more customers, of a mean so much greater that no value is proposed too seldom, and thinned. Elsewhere the tables of a Pitman-Yor restaurant are, of the strength at which
    one more customer would have a table of their own with weight a; S cancels in the ratio, which has one peak.
    """
    out = np.zeros(len(c), np.int64)
    few = a / d * c.astype(float) ** -d <= (12 ** (1 - d) if d <= 0.75 else 0.9 if d <= 0.9 else 0.6)
    at = np.flatnonzero(few)
    rise = np.zeros(len(c))
    rise[at] = 2 * np.maximum(0, np.log(thinning(c[at], np.full(len(at), 2), d)))
    while len(at):
        t = 1 + rng.poisson(a[at] / d * np.exp(rise[at]))
        ok = rng.random(len(at)) < thinning(c[at], t, d) * np.exp(-rise[at] * (t - 1))
        out[at[ok]] = t[ok]
        at = at[~ok]
    at = np.flatnonzero(~few)
    low, high = np.full(len(at), -60.0), np.full(len(at), 60.0)
    for _ in range(60):
        half = (low + high) / 2
        h = np.exp(half)  # the strength and d
        less = lgamma(h + c[at]) + lgamma(h + 1 - d) - lgamma(h) - lgamma(h - d + c[at]) < np.log(a[at])
        low, high = np.where(less, half, low), np.where(less, high, half)
    h = np.zeros(len(c))
    h[at] = np.exp(low) - d
    ratio = lambda t, i: t * np.log(a[i] / d) - lgamma(h[i] / d + t)
    peak = np.zeros(len(c))
    peak[at] = ratio(np.clip(np.ceil((a[at] - h[at]) / d), 1, c[at]), at)
    while len(at):
        t = seated_crp(c[at], d, h[at], rng)
        ok = np.log(rng.random(len(at))) < ratio(t, at) - peak[at]
        out[at[ok]] = t[ok]
        at = at[~ok]
    return out


def draw_tables(c: np.ndarray, a: np.ndarray, d: float, stirling: np.ndarray, rng) -> np.ndarray:
    """Table counts of c customers with weights S(c, t) a^t."""
    t = np.ones(len(c), np.int64)
    more = np.flatnonzero(c > 1)
    size = np.minimum(c[more], STIRLING + 1).astype(np.uint16)
    order = more[np.argsort(size, kind="stable")]
    edges = np.cumsum(np.bincount(size, minlength=STIRLING + 2))
    for k in range(2, STIRLING + 1):
        at = order[edges[k - 1] : edges[k]]
        step = max(1, 1_000_000 // k)
        for b in range(0, len(at), step):
            rows = at[b : b + step]
            weight = np.log(a[rows])[:, None] * np.arange(1, k + 1) + stirling[k, 1 : k + 1]
            weight = np.cumsum(np.exp(weight - weight.max(1, keepdims=True)), 1)
            t[rows] = 1 + (weight < rng.random(len(rows))[:, None] * weight[:, -1:]).sum(1).clip(max=k - 1)
    at = order[edges[STIRLING] :]
    if len(at):
        t[at] = many(c[at].astype(np.int64), a[at], d, rng)
    return t


def tilted_stable(n: int, time: float, d: float, rng) -> np.ndarray:
    """n draws with Laplace transform exp(-time ((1 + s)^d - 1)): sums of stable ones that are kept with chance e^-x."""
    pieces = max(1, int(np.ceil(time)))
    out = np.zeros(n)
    for _ in range(pieces):
        at = np.arange(n)
        while len(at):
            u, e = np.pi * (1 - rng.random(len(at))), rng.exponential(size=len(at))
            x = np.sin(d * u) / np.sin(u) ** (1 / d) * (np.sin((1 - d) * u) / e) ** ((1 - d) / d) * (time / pieces) ** (1 / d)
            ok = rng.random(len(at)) < np.exp(-x)
            out[at[ok]] += x[ok]
            at = at[~ok]
    return out


class Totals:
    """What restaurants know of each other: customers and tables by context, the parent's, and the fixed numbers."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray, parent_tables: float, words: int, d: tuple[float, float], parent_customers: float | None = None):
        self.customers, self.tables, self.parent_tables, self.words, self.d = customers, tables, parent_tables, words, d
        self.parent_customers = tables.sum() if parent_customers is None else parent_customers
        self.base = 1.0 / (words + 1)

    def parent(self, c: np.ndarray, t: np.ndarray) -> np.ndarray:
        return (c - self.d[0] * t + (STRENGTH + self.d[0] * self.parent_tables) * self.base) / (STRENGTH + self.parent_customers)

    def unknown(self) -> float:
        return float(self.parent(np.zeros(1), np.zeros(1))[0])

    def share(self) -> np.ndarray:
        """Weight of the parent in each context."""
        return (STRENGTH + self.d[1] * self.tables) / (STRENGTH + self.customers)


class Parent:
    """The parent's steps of a sweep; ``total`` gives the sum over all words of a step's results by block."""

    def __init__(self, words: int, d: float):
        self.words, self.d = words, d
        self.time = STRENGTH / d + words
        self.sum: float | None = None
        self.rest = 0.0

    def tables(self, c: np.ndarray, seed: list[int]) -> np.ndarray:
        return draw_tables(c, np.full(len(c), self.d * self.time_before / (self.words + 1)), self.d, log_stirling(self.d), np.random.default_rng([*seed, 1]))

    def masses(self, c: np.ndarray, seed: list[int]) -> np.ndarray:
        rng = np.random.default_rng([*seed, 2])
        return rng.gamma(c - self.d * self.tables(c, seed)) + tilted_stable(len(c), self.time / (self.words + 1), self.d, rng)

    def step(self, customers: float, total, rng) -> None:
        """New tables and masses, given all words' customers."""
        if self.sum is not None:
            self.time *= (rng.gamma(STRENGTH + customers) / self.sum) ** self.d
        self.time_before = self.time
        self.customers, self.all_tables = customers, total("tables")
        self.time = rng.gamma(STRENGTH / self.d + self.all_tables)
        self.rest = float(tilted_stable(1, self.time / (self.words + 1), self.d, rng)[0])
        self.sum = total("masses") + self.rest


def gibbs(words: np.ndarray, ends: np.ndarray, ctx: np.ndarray, n: np.ndarray, totals: Totals, keep: int, tables_: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Table counts by pair and by word in the parent, for the last ``keep`` sweeps over words that are all in one place."""
    starts = np.concatenate(([0], ends[:-1]))
    of = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    rng = np.random.default_rng(int(words[0]) if len(words) else 0)
    t, kept, kept_parent = np.ones(len(n), np.int64), [], []
    parent = Parent(totals.words, totals.d[0])
    for sweep in range(SWEEPS + keep + 1):
        seed = [sweep, int(words[0])]
        c = np.add.reduceat(t, starts)
        parent.step(c.sum(), lambda step, c=c, seed=seed: float(getattr(parent, step)(c, seed).sum()), rng)
        kept.append(t)
        kept_parent.append(parent.tables(c, seed))
        g = rng.gamma(STRENGTH / totals.d[1] + np.bincount(ctx, t, minlength=len(totals.customers)))
        t = seat(n, g[ctx], (parent.masses(c, seed) / parent.sum)[of], totals.d[1], tables_[1], rng)
    return np.stack(kept[-keep:]), np.stack(kept_parent[-keep:])


def seat(n: np.ndarray, g: np.ndarray, parent: np.ndarray, d: float, stirling: np.ndarray, rng) -> np.ndarray:
    """Tables by pair, given its context's variable and its word's probability in the parent."""
    return draw_tables(n, np.maximum(d * g * parent, 1e-300), d, stirling, rng)


def block_totals(row: dict, t: np.ndarray, sweep: int, keep: bool, buckets: int) -> list[dict]:
    """What a block tells of its tables: to its contexts' buckets, to the parent, and the tables themselves if ``keep``."""
    words, ends, ctx, _ = unpack(row)
    ctxs = np.frombuffer(row["ctxs"], np.uint64)
    tables = np.bincount(ctx, t, minlength=len(ctxs)).astype(np.uint32)
    c = np.add.reduceat(t, np.concatenate(([0], ends[:-1]))).astype(np.uint32)
    out = [{"bucket": k, "kind": UP, "part": row["bucket"], "ctxs": ctxs[a:b], "t": tables[a:b]} for k, a, b in slices(ctxs, buckets)]
    out.append({"bucket": row["bucket"], "kind": STATE, "part": sweep, "total": float(c.sum()), "t": c})
    return out + [{"bucket": row["bucket"], "kind": SEATED, "part": sweep, "t": t.astype(np.uint32)}] * keep


def met_contexts(told: DataFrame, sweep: int, d: float) -> DataFrame:
    """The blocks' tables added up by context, and each context's variable sent back to the blocks; other rows as they are."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            up = [plain(r) for r in rows if r["kind"] == UP]
            out.append(rows_of([r for r in rows if r["kind"] != UP]))
            if not up:
                continue
            ctxs, at = np.unique(np.concatenate([np.frombuffer(r["ctxs"], np.uint64) for r in up]), return_inverse=True)
            tables = np.bincount(at, np.concatenate([np.frombuffer(r["t"], np.uint32) for r in up]))
            g = np.random.default_rng([sweep, up[0]["bucket"], 3]).gamma(STRENGTH / d + tables).astype(np.float32)[at].view(np.uint32)
            ends = np.cumsum([len(r["ctxs"]) // 8 for r in up]).tolist()
            out.append(rows_of([{"bucket": r["part"], "kind": DOWN, "part": r["bucket"], "t": g[x:y]} for r, x, y in zip(up, [0, *ends], ends)]))
        return pa.Table.from_batches(out)

    return sorted_groups(told, ["bucket"], ["kind", "part"], run, PACKED)


def first_seating(blocks: DataFrame, keep: bool, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = plain(batch.slice(i, 1).to_pylist()[0])
                yield rows_of(block_totals(row, np.ones(len(row["count"]) // 4, np.int64), 0, keep, buckets))

    return blocks.mapInArrow(run, PACKED)


def reseated(blocks: DataFrame, before: DataFrame, parent: Parent, d: float, sweep: int, keep: bool, buckets: int) -> DataFrame:
    """All pairs' tables drawn anew, given the contexts' variables and the parent's masses."""
    own = copy(parent)

    def run(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            row, state = plain(rows[0]), plain(rows[1])
            words, ends, ctx, n = unpack(row)
            g = np.concatenate([np.frombuffer(plain(r)["t"], np.float32) for r in rows[2:]]).astype(float)
            share = own.masses(np.frombuffer(state["t"], np.uint32).astype(np.int64), [sweep - 1, row["bucket"]]) / own.sum
            t = seat(n, g[ctx], np.repeat(share, np.diff(ends, prepend=0)), d, log_stirling(d), np.random.default_rng([sweep, row["bucket"], 4]))
            out.append(rows_of(block_totals(row, t, sweep, keep, buckets)))
        return pa.Table.from_batches(out)

    return sorted_groups(blocks.unionAll(before.where(F.col("kind").isin(STATE, DOWN))), ["bucket"], ["kind", "part"], run, PACKED)


def parent_step(seated: DataFrame, parent: Parent, sweep: int, rng) -> None:
    """The parent's step, summed over the blocks' words."""
    state = seated.where(F.col("kind") == STATE).select("bucket", "total", "t")

    def total(step: str) -> float:
        own = copy(parent)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    c = opened(row["t"], np.uint32).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([row["bucket"]], pa.int32()), pa.array([float(getattr(own, step)(c, [sweep, row["bucket"]]).sum())])], ["bucket", "n"])

        return sum(r["n"] for r in sorted(state.mapInArrow(run, "bucket int, n double").collect()))

    parent.step(sum(r["total"] for r in state.select("bucket", "total").collect()), total, rng)


def contexts_of(blocks: DataFrame, kept: DataFrame, d: float, samples: int, buckets: int) -> DataFrame:
    """Customers and the kept seatings' tables by context: told to the blocks (DOWN), and as weights of the parent (SHARES)."""

    def tell(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            row = plain(rows[0])
            ctx, n = unpack(row)[2:]
            ctxs = np.frombuffer(row["ctxs"], np.uint64)
            customers = np.bincount(ctx, n, minlength=len(ctxs)).astype(np.uint32)
            tables = np.stack([np.bincount(ctx, opened(r["t"], np.uint32), minlength=len(ctxs)) for r in rows[1:]]).astype(np.uint32)
            out.append(rows_of([{"bucket": k, "kind": UP, "part": row["bucket"], "ctxs": ctxs[a:b], "count": customers[a:b], "t": tables[:, a:b]} for k, a, b in slices(ctxs, buckets)]))
        return pa.Table.from_batches(out)

    def run(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            up = [plain(r) for r in rows]
            ctxs, at = np.unique(np.concatenate([np.frombuffer(r["ctxs"], np.uint64) for r in up]), return_inverse=True)
            customers = np.bincount(at, np.concatenate([np.frombuffer(r["count"], np.uint32) for r in up]))
            told = np.concatenate([np.frombuffer(r["t"], np.uint32).reshape(samples, -1) for r in up], 1)
            tables = np.stack([np.bincount(at, x) for x in told])
            share = ((STRENGTH + d * tables) / (STRENGTH + customers)).astype(np.float32)
            ends = np.cumsum([len(r["ctxs"]) // 8 for r in up]).tolist()
            out.append(rows_of([{"bucket": r["part"], "kind": DOWN, "part": r["bucket"], "ctxs": customers[at[x:y]].astype(np.uint64), "t": tables[:, at[x:y]].astype(np.uint32)} for r, x, y in zip(up, [0, *ends], ends)]))
            out.append(rows_of([{"bucket": rows[0]["bucket"], "kind": SHARES, "ctxs": ctxs, "t": share.view(np.uint32)}]))
        return pa.Table.from_batches(out)

    told = sorted_groups(blocks.unionAll(kept.where(F.col("kind") == SEATED)), ["bucket"], ["kind", "part"], tell, PACKED)
    return sorted_groups(told, ["bucket"], ["part"], run, PACKED)


def whole_block(rows: list[dict], parents: list[Parent], first: int) -> dict | None:
    """A bucket's block with the kept seatings' tables by pair, by word in the parent and by context."""
    if rows[0]["kind"] != BLOCK:
        return None  # no word of the bucket was learned
    state, down, seated = ([r for r in rows if r["kind"] == k] for k in (STATE, DOWN, SEATED))
    up = np.stack([p.tables(opened(r["t"], np.uint32).astype(np.int64), [first + s, r["bucket"]]) for s, (p, r) in enumerate(zip(parents, state))])
    cells = {"t": np.stack([opened(r["t"], np.uint32) for r in seated]), "t_parent": up.astype(np.uint32), "customers": np.concatenate([opened(r["ctxs"], np.uint64) for r in down])}
    cells["tables"] = np.concatenate([opened(r["t"], np.uint32).reshape(len(up), -1) for r in down], 1)
    return plain(rows[0]) | {c: np.ascontiguousarray(x).tobytes() for c, x in cells.items()}


def seatings_of(row: dict | None, parents: list[tuple], d: tuple[float, float]) -> list[Totals]:
    """The kept seatings as a block sees them; (parent's customers, tables, words) of each."""
    customers = np.frombuffer(row["customers"], np.uint64).astype(float) if row else np.zeros(0)
    tables = np.frombuffer(row["tables"], np.uint32).astype(float).reshape(len(parents), -1) if row else np.zeros((len(parents), 0))
    return [Totals(customers, t, own, words, d, c) for t, (c, own, words) in zip(tables, parents)]


def first_totals(table: DataFrame) -> tuple[int, tuple[float, float], int, np.ndarray]:
    """V, the discounts, N, and numbers of pairs by their count in steps of a factor (for the head)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(6 + 512)
        for batch in batches:
            for row in (plain(batch.slice(i, 1).to_pylist()[0]) for i in range(batch.num_rows)):
                words, ends, _, n = unpack(row)
                size = np.diff(ends, prepend=0)
                total[:6] += [len(words), n.sum(), (n == 1).sum(), (n == 2).sum(), (size == 1).sum(), (size == 2).sum()]
                total[6:] += np.bincount(level(n), minlength=512)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["at", "n"])

    x = np.zeros(6 + 512)
    for row in table.mapInArrow(run, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        x[row["at"]] = row["n"]
    words, n, n1, n2, m1, m2 = x[:6]
    rate = lambda a, b: float(np.clip(a / max(1.0, a + 2 * b), 0.05, 0.95))
    return int(words), (rate(m1, m2), rate(n1, n2)), int(n), x[6:]


def level(count: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of 512 steps."""
    return np.minimum(511, np.log2(np.maximum(1, count)) * 8).astype(np.int64)


class Model:
    """Predictive probabilities of some words: a table by word, and one by (word, context). Contexts are those of the first row."""

    def __init__(self, rows: list[dict], seatings: list[Totals], n: int):
        words, counts_, parents, keys, probs = [], [], [], [], []
        self.unknown = np.mean([s.share() * s.unknown() for s in seatings], 0)
        self.contexts = np.uint64(max(1, len(seatings[0].customers)))
        self.ctxs = Table(np.frombuffer(rows[0]["ctxs"], np.uint64) if rows and "ctxs" in rows[0] else np.zeros(0, np.uint64))
        at = 0
        for row in rows:
            w, ends, ctx, c = unpack(row)
            if not len(w):
                continue
            starts = np.concatenate(([0], ends[:-1]))
            of = np.repeat(np.arange(len(w)), np.diff(ends, prepend=0))
            t = np.frombuffer(row["t"], np.uint32).reshape(len(seatings), -1).astype(float)
            t_parent = np.frombuffer(row["t_parent"], np.uint32).reshape(len(seatings), -1)
            p, parent = 0.0, []
            for s, (seating, own, up) in enumerate(zip(seatings, t, t_parent)):
                parent.append(seating.parent(np.add.reduceat(own, starts), up))
                p = p + (c - seating.d[1] * own) / (STRENGTH + seating.customers[ctx]) + seating.share()[ctx] * parent[s][of]
            words.append(w)
            counts_.append(np.add.reduceat(c, starts).astype(np.int64))
            parents.append(np.stack(parent, 1).astype(np.float32))
            keys.append((at + of).astype(np.uint64) * self.contexts + ctx)
            probs.append((p / len(seatings)).astype(np.float32))
            at += len(w)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
        self.table = Table(join(words, np.uint64))
        self.count = join(counts_, np.int64)
        self.parent = np.concatenate([*parents, [[s.unknown() for s in seatings]]]).astype(np.float32)  # the last: unknown words
        self.keys, self.probs = join(keys, np.uint64), join(probs, np.float32)  # keys are in order
        self.shares = np.stack([s.share() for s in seatings], 1).astype(np.float32)
        self.base = np.append(np.log10((self.count + 0.1) / (n + 0.1 * (seatings[0].words + 1))), np.log10(0.1 / (n + 0.1 * (seatings[0].words + 1))))

    def rows(self, hashes: np.ndarray) -> np.ndarray:
        return self.table.find(hashes)

    def scores(self, row: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        """log10 probability of tokens: rows of the model (-1: unknown) in their contexts."""
        out = self.unknown[ctx]
        hit = np.flatnonzero(row >= 0)
        if len(hit):
            key = row[hit].astype(np.uint64) * self.contexts + ctx[hit].astype(np.uint64)
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            seen = self.keys[at] == key
            known = np.empty(len(hit))
            known[seen] = self.probs[at[seen]]
            rest = hit[~seen]
            known[~seen] = (self.shares[ctx[rest]].astype(float) * self.parent[row[rest]]).mean(1)
            out[hit] = known
        return np.log10(out)


class Head:
    """Base and predictive probabilities of the most frequent (word, context) pairs; it travels without its tables."""

    def __init__(self, w: np.ndarray, c: np.ndarray, probs: np.ndarray, base: np.ndarray):
        words, first, row = np.unique(w, return_index=True, return_inverse=True)
        ctxs, ctx = np.unique(c, return_inverse=True)
        self.__setstate__((words, base[first], ctxs, row.astype(np.uint32), ctx.astype(np.uint32), probs))

    def __getstate__(self) -> tuple:
        return self.state

    def __setstate__(self, state: tuple) -> None:
        self.state = words, base, ctxs, row, ctx, probs = state
        self.words, self.ctxs, self.wide = Table(words), Table(ctxs), np.uint64(len(ctxs))
        self.pairs = Table(row.astype(np.uint64) * self.wide + ctx)
        self.score, self.base = np.log10(probs.astype(float)), base[row]

    def find(self, hashes: np.ndarray, word: np.ndarray, context: np.ndarray) -> np.ndarray:
        """Places of (word, context), given by place in ``hashes``; -1: not here."""
        row, ctx = self.words.find(hashes)[word], self.ctxs.find(hashes)[context]
        out = np.full(len(word), -1, np.int32)
        at = np.flatnonzero((row >= 0) & (ctx >= 0))
        out[at] = self.pairs.find(row[at].astype(np.uint64) * self.wide + ctx[at].astype(np.uint64))
        return out


def head_of(model_rows: DataFrame, model_of: Callable[[list[dict]], tuple[Model, dict | None]], least: int) -> Head:
    """The pairs of at least the given level."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        for rows in by_bucket(table):
            model, row = model_of(rows)
            words, ends, ctx, count = unpack(row)
            take = np.flatnonzero(level(count) >= least)
            of = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))[take]
            cells = [words[of], np.frombuffer(row["ctxs"], np.uint64)[ctx[take]], model.probs[take], model.base[of]]
            out.append(pa.table([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in cells], names))
        return pa.concat_tables(out)

    names = ["w", "c", "probs", "base"]
    found = [r.asDict() for r in cut(sorted_groups(model_rows, ["bucket"], ["kind", "part"], run, ", ".join(f"{x} binary" for x in names)), free=True).collect()]
    return Head(*(np.frombuffer(b"".join(r[x] for r in found), kind) for x, kind in zip(names, (np.uint64, np.uint64, np.float32, float))))


def lm_scoring(documents: DataFrame, samples: int = SAMPLES, sweeps: int = SWEEPS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = prepare(documents.sparkSession, 256)
    kind = documents.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(crc_mod(F.col("doc_id"), 10) == 0, F.lit(False))
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), held.alias("held_out"))

    size = docs.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    buckets = 1 + size // BLOCK_BYTES
    blocks = cut(merged(counts(docs.where(~F.col("held_out")), buckets)), free=True)
    vocabulary, d, n, pairs_by_level = first_totals(blocks)
    parent, rng = Parent(vocabulary, d[0]), np.random.default_rng(vocabulary)
    seated = cut(met_contexts(first_seating(blocks, False, buckets), 0, d[1]), free=True)
    parent_step(seated, parent, 0, rng)
    kept, parents = None, []
    for sweep in range(1, sweeps + samples + 1):
        keep = sweep > sweeps
        seated = cut(met_contexts(reseated(blocks, seated, parent, d[1], sweep, keep, buckets), sweep, d[1]), free=True)
        parent_step(seated, parent, sweep, rng)
        if keep:
            kept = seated if kept is None else kept.unionAll(seated)
            parents.append(copy(parent))
    contexts = cut(contexts_of(blocks, kept, d[1], samples, buckets), free=True)
    model_rows = blocks.unionAll(kept.where(F.col("kind").isin(STATE, SEATED))).unionAll(contexts.where(F.col("kind") == DOWN))
    seen = [(p.customers, p.all_tables, vocabulary) for p in parents]

    def model_of(rows: list[dict]) -> tuple[Model, dict | None]:
        row = whole_block(rows, parents, sweeps + 1)
        return Model([row] if row else [], seatings_of(row, seen, d), n), row

    held_pairs = np.cumsum(pairs_by_level[::-1])[::-1]  # pairs of at least each level
    head = spark.sparkContext.broadcast(head_of(model_rows, model_of, int(np.flatnonzero(np.append(held_pairs, 0) <= head_pairs)[0])))

    result = f"first long, rid long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double"
    names = [x.split(" ")[0] for x in result.split(", ")]
    asked = PACKED + ", " + result
    asked_names = [x.split(" ")[0] for x in asked.split(", ")]

    def filled(rows: dict[str, pa.Array], wanted: list[str], types: dict[str, pa.DataType]) -> pa.RecordBatch:
        """A batch with the given columns, the others null."""
        size = len(next(iter(rows.values())))
        return pa.RecordBatch.from_arrays([rows[c] if c in rows else pa.nulls(size, types[c]) for c in wanted], wanted)

    def types_of(doc_type: pa.DataType) -> dict[str, pa.DataType]:
        fixed = dict.fromkeys(["first", "rid", "n_tokens", "n_known"], pa.int64()) | dict.fromkeys(["base", "score", "total"], pa.float64())
        fixed |= dict.fromkeys(["bucket", "kind", "part"], pa.int32()) | {"doc_id": doc_type, "held_out": pa.bool_()}
        return defaultdict(pa.binary, fixed)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = head.value
        chunk, rows = Chunk(), []

        def flush():
            hashes, word, context, text = chunk.done()
            types = types_of(doc_type)
            at = model.find(hashes, word, context)
            own = at >= 0
            m = len(chunk.sizes)
            score, base, known = (np.bincount(text[own], x, minlength=m) for x in (model.score[at[own]], model.base[at[own]], np.ones(own.sum())))
            rid, ids, out = zip(*rows)
            columns = {"bucket": pa.array([r % buckets for r in rid], pa.int32()), "kind": pa.array(np.full(m, TEXT, np.int32)), "first": pa.array(np.full(m, rid[0], np.int64)), "rid": pa.array(rid, pa.int64())}
            columns |= {"doc_id": pa.array(ids, doc_type), "held_out": pa.array(out), "n_tokens": pa.array(chunk.sizes, pa.int64()), "n_known": pa.array(known.astype(np.int64)), "base": pa.array(base.astype(float)), "score": pa.array(score.astype(float))}
            yield filled(columns, asked_names, types)
            # The other occurrences, by bucket and word; ``count`` holds the number of the text in this chunk, and
            # ``first`` the row number of its first text: row numbers follow each other within a task's input.
            rest = np.flatnonzero(~own)
            rest = rest[np.argsort(word[rest].astype(np.int64) * len(hashes) + context[rest], kind="stable")]
            w, c, text = hashes[word[rest]], hashes[context[rest]], text[rest]
            for k, a, b in slices(w, buckets):
                one = rows_of([{"bucket": k, "kind": ASK, **block(w[a:b], c[a:b], text[a:b])}])
                yield filled(dict(zip(one.schema.names, one.columns)) | {"first": pa.array([rid[0]], pa.int64())}, asked_names, types)

        doc_type = None
        for batch in batches:
            doc_type = batch.column(0).type
            for one in zip(batch.column(3).to_pylist(), batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist()):
                chunk.add(one[3])
                rows.append(one[:3])
                if chunk.n >= CHUNK:
                    yield from flush()
                    chunk, rows = Chunk(), []
        if rows:
            yield from flush()

    read_rows = docs.withColumn("rid", F.monotonically_increasing_id()).mapInArrow(read, asked)
    for name, what in (x.split(" ") for x in result.split(", ")):
        model_rows = model_rows.withColumn(name, F.lit(None).cast(what))
    # Answers for the texts of chunk ``first`` (SUMS), and questions to context buckets: by occurrence the context, the
    # chunk (``words``), the text (``count``) and the parent's probabilities (``t``).
    answers = f"bucket int, kind int, {result}, " + ", ".join(f"{c} binary" for c in [*SUMS, "ctxs", "words", "count", "t"])
    answer_names = [x.split(" ")[0] for x in answers.split(", ")]

    def summed(first: int, text: np.ndarray, values: list[np.ndarray], types: dict, bucket: int) -> pa.RecordBatch:
        m = int(text.max()) + 1
        some = np.flatnonzero(np.bincount(text, minlength=m))
        sums = [np.bincount(text, x, minlength=m)[some] for x in values]
        cells = {name: pa.array([x.tobytes()], pa.binary()) for name, x in zip(SUMS, (some, *sums))}
        return filled({"bucket": pa.array([bucket], pa.int32()), "kind": pa.array([TEXT], pa.int32()), "first": pa.array([first], pa.int64()), **cells}, answer_names, types)

    def meet(table: pa.Table) -> pa.Table:
        types = types_of(table.schema.field("doc_id").type)
        kinds = table.column("kind").to_numpy()
        texts = table.filter(pa.array(kinds == TEXT)).combine_chunks()
        out = [filled({c: texts.column(c).combine_chunks() for c in ("bucket", "kind", *names)}, answer_names, types)] if texts.num_rows else []
        for rows in by_bucket(table.filter(pa.array(kinds != TEXT))):
            model, _ = model_of(rows)
            wanted = []
            for row in (plain(r) for r in rows if r["kind"] == ASK):
                words, ends, ctx, text = unpack(row)
                asked_ctx = np.frombuffer(row["ctxs"], np.uint64)
                found = np.repeat(model.rows(words), np.diff(ends, prepend=0))
                at = model.ctxs.find(asked_ctx)[ctx]
                here = at >= 0
                score = np.zeros(len(text))
                score[here] = model.scores(found[here], at[here])
                out.append(summed(row["first"], text, [(found >= 0).astype(float), model.base[found], score], types, row["bucket"]))
                away = np.flatnonzero(~here)
                wanted.append((asked_ctx[ctx[away]], np.full(len(away), row["first"], np.int64), text[away], model.parent[found[away]]))
            if wanted:
                ctxs, first, text, up = (np.concatenate(x) for x in zip(*wanted))
                order = np.argsort(ctxs, kind="stable")
                ctxs, first, text, up = ctxs[order], first[order], text[order], up[order]
                for k, a, b in slices(ctxs, buckets):
                    cells = {"ctxs": ctxs[a:b], "words": first[a:b], "count": text[a:b], "t": up[a:b]}
                    out.append(filled({"bucket": pa.array([k], pa.int32()), "kind": pa.array([ASK], pa.int32()), **{c: pa.array([shut(x)], pa.binary()) for c, x in cells.items()}}, answer_names, types))
        return pa.Table.from_batches(out)

    def away(table: pa.Table) -> pa.Table:
        """The parent's probabilities, weighted as their contexts do."""
        types = types_of(table.schema.field("doc_id").type)
        kinds = table.column("kind").to_numpy()
        out = table.filter(pa.array(kinds == TEXT)).to_batches()
        for rows in by_bucket(table.filter(pa.array(kinds != TEXT))):
            has = rows[0]["kind"] == SHARES
            ctxs = Table(opened(rows[0]["ctxs"], np.uint64) if has else np.zeros(0, np.uint64))
            share = opened(rows[0]["t"], np.float32).reshape(samples, -1).T if has else np.zeros((0, samples), np.float32)
            share = np.concatenate((share, np.ones((1, samples), np.float32)))  # the last: contexts that were not seen
            asks = [r for r in rows if r["kind"] == ASK]
            if not asks:
                continue
            of, first, text = (np.concatenate([opened(r[c], t) for r in asks]) for c, t in (("ctxs", np.uint64), ("words", np.int64), ("count", np.uint32)))
            up = np.concatenate([opened(r["t"], np.float32).reshape(-1, samples) for r in asks])
            score = np.log10((share[ctxs.find(of)].astype(float) * up).mean(1))
            order = np.lexsort((text, first))
            first, text, score = first[order], text[order], score[order]
            for at in np.split(np.arange(len(first)), np.flatnonzero(first[1:] != first[:-1]) + 1):
                none = np.zeros(len(at))
                out.append(summed(int(first[at[0]]), text[at], [none, none, score[at]], types, rows[0]["bucket"]))
        return pa.Table.from_batches(out, table.schema)

    def total(table: pa.Table) -> pa.Table:
        """The texts of whole chunks, with what each bucket found for them added."""
        table = table.combine_chunks()
        own = table.column("rid").is_valid()
        texts, found = table.filter(own), table.filter(pa.compute.invert(own))
        rid = texts.column("rid").to_numpy()
        order = np.argsort(rid)
        sums = [texts.column(c).to_numpy().astype(float) for c in ("n_known", "base", "score")]
        found = sorted(found.select(["first", *SUMS]).to_pylist(), key=lambda r: (r["first"], r["scores"]))
        for row in found:
            at = order[np.searchsorted(rid, row["first"] + np.frombuffer(row["of"], np.int64), sorter=order)]
            for x, name in zip(sums, SUMS[1:]):
                x[at] += np.frombuffer(row[name], float)
        cells = [texts.column(c) for c in ("doc_id", "held_out", "n_tokens")]
        return pa.table([*cells, pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    # One row for each chunk and bucket, not one for each text and bucket.
    met = cut(sorted_groups(model_rows.unionByName(read_rows), ["bucket"], ["kind", "part"], meet, answers), free=True)
    shares = contexts.where(F.col("kind") == SHARES).select("bucket", "kind", "ctxs", "t")
    questions = met.where(F.col("kind") == ASK).unionByName(shares, allowMissingColumns=True)
    answered = met.where(F.col("kind") == TEXT).unionAll(sorted_groups(questions, ["bucket"], ["kind"], away, answers))
    added = sorted_groups(answered.select("first", "rid", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", *SUMS), ["first"], [], total, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return added.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
