"""Exact top-k inner products with a pivot-distance index.

Vectors are turned into integers, floor(scale * x). With M the largest norm,
the extended vector x' = (x, sqrt(M^2 - |x|^2)) has norm M, and a query
q' = (q, 0) satisfies |q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>: the largest inner
products are the nearest extended vectors.

Index: every vector is keyed by its nearest pivot and its distance from it;
each pivot's distances are cut into rings (annuli). Pivots come from a bounded
sample (``sample`` vectors, k-means); every vector is indexed. Ring sizes are
counted, at most pivots x rings rows, and a ring with more than ``block``
vectors is dealt into several blocks by a hash, so that equal vectors without
number do not meet in one task.

Search: for a query the rings are put in order of the smallest distance that
the triangle inequality leaves, max(0, |d(q, p) - r|) to the ring. The first
rings that hold ``first`` vectors in all are expanded; the k-th best score so
far is a lower bound on the result. Then every other ring whose distance bound
could still reach that score is expanded, and no further one. In a task a block
is held as a matrix and its queries pass by a batch at a time; each batch
returns at most k candidates for each query, none below the query's bound. Bounds carry a relative slack far above
rounding; scores are exact integers.

Defined results: vectors that are null, or hold null or non-finite components,
take no part. Scaled components and scores are 64-bit integers; a table whose
components or scores go beyond is refused, never cut down. Vectors of
different length are compared as if padded with zeros. Empty vectors score 0
with everything. Fewer than k candidates: all are returned. A null vec_id takes
no part. A row is known by a number of its own, given in the order of vec_id:
rows that repeat a vec_id are queries each, and candidates of each other. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare

K = 20
SCALE = 64
SAMPLE = 4096
BLOCK = 16_384
SLACK = 1e-9
WIDE = b"\x08"  # behind the bytes of a vector that needs 64-bit integers


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v (integers as bytes, 32-bit ones where they suffice), norm2, dim of the rows that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = lists.flatten()
            values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes nan
            sizes = np.diff(lists.offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            ends = np.cumsum(sizes)
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
            keep = np.flatnonzero(odd[ends] == odd[ends - sizes])
            ints = np.floor(np.where(np.isfinite(values), values, 0.0) * scale)
            if np.abs(ints).max(initial=0.0) >= 2.0**62:
                raise ValueError("a scaled component leaves 64 bits")
            rows = [ints[ends[i] - sizes[i] : ends[i]] for i in keep]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep)),
                    pa.array([encoded(r) for r in rows], pa.binary()),
                    pa.array([float(r @ r) for r in rows], pa.float64()),
                    pa.array(sizes[keep].astype(np.int32)),
                ],
                ["vec_id", "v", "norm2", "dim"],
            )

    there = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    return there.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(run, "vec_id long, v binary, norm2 double, dim int")


def encoded(v: np.ndarray) -> bytes:
    return v.astype("<i4").tobytes() if np.abs(v).max(initial=0) < 2**31 else v.astype("<i8").tobytes() + WIDE


def decoded(v: bytes) -> np.ndarray:
    return np.frombuffer(v, "<i8", len(v) // 8) if len(v) % 4 else np.frombuffer(v, "<i4")


def matrix(values: list[bytes], dim: int) -> np.ndarray:
    """Integer vectors as rows, padded with zeros."""
    if all(len(v) == 4 * dim for v in values):
        return np.frombuffer(b"".join(values), "<i4").reshape(len(values), dim)
    out = np.zeros((len(values), dim), np.int64)
    for i, v in enumerate(values):
        own = decoded(v)
        out[i, : len(own)] = own
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows. Sums may wrap around on the way: they are right if the result fits."""
    top = float(max(1, np.abs(a).max(initial=0))) * float(max(1, np.abs(b).max(initial=0))) * max(1, a.shape[1])
    if top < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if top >= 2**62:
        near = a.astype(float) @ b.astype(float).T
        if np.abs(near).max(initial=0.0) + 1e-12 * top >= 2.0**63:
            raise ValueError("a score leaves 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


class Index:
    """Pivots in the extended space, and the rings around each."""

    def __init__(self, sample: np.ndarray, dim: int, top2: float, pivots: int, rings: int):
        self.dim, self.top2, self.rings = dim, top2, rings
        points = self.extended(sample)
        rng = np.random.default_rng(7)
        self.pivots = points[np.sort(rng.choice(len(points), min(pivots, len(points)), replace=False))]
        for _ in range(8):
            nearest, _ = self.nearest(points)
            for p in range(len(self.pivots)):
                if (nearest == p).any():
                    self.pivots[p] = points[nearest == p].mean(0)
        nearest, distance = self.nearest(points)
        # Ring edges: quantiles of the sample's distances; the first and last ring are open.
        self.edges = np.zeros((len(self.pivots), rings - 1))
        for p in range(len(self.pivots)):
            own = distance[nearest == p]
            self.edges[p] = np.quantile(own, np.arange(1, rings) / rings) if len(own) else 0.0

    def extended(self, v: np.ndarray) -> np.ndarray:
        v = v.astype(float)
        return np.hstack([v, np.sqrt(np.maximum(0.0, self.top2 - (v * v).sum(1)))[:, None]])

    def distances(self, points: np.ndarray) -> np.ndarray:
        squared = (points * points).sum(1)[:, None] + (self.pivots * self.pivots).sum(1)[None, :] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(squared, 0.0))

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = self.distances(points)
        p = d.argmin(1)
        return p, d[np.arange(len(p)), p]

    def ring(self, p: np.ndarray, distance: np.ndarray) -> np.ndarray:
        return (distance[:, None] >= self.edges[p]).sum(1)


class Rings:
    """What each non-empty ring holds: number of vectors, smallest and largest distance, blocks."""

    def __init__(self, rows: list, block: int):
        self.pivot = np.array([r["pivot"] for r in rows], int)
        self.ring = np.array([r["ring"] for r in rows], int)
        self.n = np.array([r["n"] for r in rows], np.int64)
        self.low = np.array([r["low"] for r in rows], float)
        self.high = np.array([r["high"] for r in rows], float)
        self.blocks = -(-self.n // block)
        self.number = {(p, r): i for i, (p, r) in enumerate(zip(self.pivot.tolist(), self.ring.tolist()))}

    def bounds(self, index: Index, q: np.ndarray) -> np.ndarray:
        """A lower bound on the distance of each query (extended) to the vectors of each ring, slack included."""
        d = index.distances(q)[:, self.pivot]
        gap = np.maximum(0.0, np.maximum(self.low[None, :] - d, d - self.high[None, :]))
        slack = 1e-6 * np.sqrt(index.top2 + (q * q).sum(1))[:, None]
        return np.maximum(0.0, gap - slack)


def scored(batches: Iterator[pa.RecordBatch], dim: int, k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score: each probe's k best of its block, for rows in order of cell, part and kind.

    Only one block's vectors are held; its queries, whose number grows with the table, pass by a batch at a time.
    """
    block, held, held_ids, vecs, own_ids = None, [], [], None, None
    for batch in batches:
        cell, part, kind, ids = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("cell", "part", "kind", "id"))
        bound = batch.column(batch.schema.get_field_index("bound")).fill_null(np.iinfo(np.int64).min).to_numpy()
        v = batch.column(batch.schema.get_field_index("v"))
        edges = np.flatnonzero((cell[1:] != cell[:-1]) | (part[1:] != part[:-1])) + 1
        out_q, out_v, out_s = [], [], []
        for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(cell)]))):
            if a == b:
                continue
            if block != (cell[a], part[a]):
                block, held, held_ids, vecs = (cell[a], part[a]), [], [], None
            split = a + int(np.searchsorted(kind[a:b], 1))
            if split > a:
                held += v.slice(a, split - a).to_pylist()
                held_ids.append(ids[a:split])
            if split == b or not held_ids:
                continue
            if vecs is None:
                own_ids = np.concatenate(held_ids)
                by_id = np.argsort(own_ids, kind="stable")
                vecs, own_ids, held = matrix(held, dim)[by_id], own_ids[by_id], []
            for at in range(split, b, 128):
                to = min(at + 128, b)
                s = products(matrix(v.slice(at, to - at).to_pylist(), dim), vecs)
                ok = (s >= bound[at:to, None]) & (own_ids[None, :] != ids[at:to, None])
                for i in range(to - at):
                    hit = np.flatnonzero(ok[i])
                    if len(hit) > k:
                        # The k best; among equal scores those that come first, in order of vec_id.
                        hit = hit[np.argsort(-s[i, hit], kind="stable")[:k]]
                    out_q.append(np.full(len(hit), ids[at + i]))
                    out_v.append(own_ids[hit])
                    out_s.append(s[i, hit])
        if out_q:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x), pa.int64()) for x in (out_q, out_v, out_s)], ["query_id", "vec_id", "score"])


def topk_search(vectors: DataFrame, k: int = K, scale: int = SCALE, every: int = 20, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each vector whose vec_id ``every`` divides."""
    spark = prepare(vectors.sparkSession, 4096)
    # Numbers in the order of vec_id stand for the rows from here on; the checkpoint fixes them.
    whole = cut(quantised(vectors, scale).orderBy("vec_id").withColumn("rid", F.monotonically_increasing_id()))
    table = whole.select(F.col("rid").alias("vec_id"), "v", "norm2", "dim")
    size = table.agg(F.count("*").alias("n"), F.max("norm2").alias("top2"), F.max("dim").alias("dim")).collect()[0]
    n, dim = size["n"], max(1, size["dim"] or 0)
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    top2 = float(size["top2"])
    # Bounded in every case: at most 64 pivots with 16 rings.
    cells = max(1, min(1024, n // 512))
    pivots = max(1, min(64, int(np.sqrt(cells) * 2)))
    rings = max(1, min(16, cells // pivots))
    chosen = table.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(sample).select("v").collect()
    index = Index(matrix([bytes(r["v"]) for r in chosen], dim), dim, top2, pivots, rings)
    shared = spark.sparkContext.broadcast(index)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            if batch.num_rows:
                p, d = own.nearest(own.extended(matrix(batch.column(1).to_pylist(), own.dim)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p.astype(np.int32)), pa.array(own.ring(p, d).astype(np.int32)), pa.array(d)], ["vec_id", "v", "pivot", "ring", "distance"])

    keyed = cut(table.mapInArrow(key, "vec_id long, v binary, pivot int, ring int, distance double"))
    rows = keyed.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("distance").alias("low"), F.max("distance").alias("high")).orderBy("pivot", "ring").collect()
    held = spark.sparkContext.broadcast(Rings(rows, block))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = held.value
            cell = np.array([own.number[c] for c in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], np.int32)
            ids = batch.column(0).to_numpy()
            part = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)) % own.blocks[cell].astype(np.uint64)
            none = pa.nulls(len(cell), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(part.astype(np.int32)), pa.array(np.zeros(len(cell), np.int32)), batch.column(0), batch.column(1), none], names)

    names = ["cell", "part", "kind", "id", "v", "bound"]
    schema = "cell int, part int, kind int, id long, v binary, bound long"
    data = keyed.mapInArrow(place, schema)
    queries = whole.where(F.col("vec_id") % every == 0).select(F.col("rid").alias("vec_id"), "v")

    def expand(later: bool):
        """Probe rows of the first rings of each query, or of all further rings that its bound leaves."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, rings_ = shared.value, held.value
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    q = matrix(part.column(1).to_pylist(), own.dim).astype(float)
                    q = np.hstack([q, np.zeros((len(q), 1))])
                    bound = rings_.bounds(own, q)
                    order = np.argsort(bound, axis=1, kind="stable")
                    before = np.cumsum(rings_.n[order], 1) - rings_.n[order]
                    early = np.zeros(bound.shape, bool)
                    np.put_along_axis(early, order, before < 8 * k, 1)
                    want = early
                    least = part.column(2).to_numpy(zero_copy_only=False) if later else None
                    if later:
                        reach = ((q * q).sum(1)[:, None] + own.top2 - bound**2) / 2
                        reach = reach + SLACK * (own.top2 + (q * q).sum(1))[:, None] + 1e-6
                        want = ~early & (np.isnan(least.astype(float))[:, None] | (reach >= np.nan_to_num(least.astype(float), nan=0.0)[:, None]))
                    i, cell = np.nonzero(want)
                    times = rings_.blocks[cell]
                    i, cell, block_of = np.repeat(i, times), np.repeat(cell, times), np.concatenate([np.arange(t) for t in times]) if len(times) else times
                    for a in range(0, len(i), 4096):
                        run_ = pa.array(i[a : a + 4096])
                        m = len(run_)
                        limit = part.column(2).take(run_) if later else pa.nulls(m, pa.int64())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(cell[a : a + 4096].astype(np.int32)), pa.array(block_of[a : a + 4096].astype(np.int32)), pa.array(np.ones(m, np.int32)), part.column(0).take(run_), part.column(1).take(run_), limit], names
                        )

        return run

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def search(probes: DataFrame) -> DataFrame:
        dealt = data.unionAll(probes).repartition("cell", "part").sortWithinPartitions("cell", "part", "kind")
        return dealt.mapInArrow(lambda batches: scored(batches, dim, k), "query_id long, vec_id long, score long")

    first = cut(best(search(queries.mapInArrow(expand(False), schema))).select("query_id", "vec_id", "score"))
    reached = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("bound"))
    asked = queries.join(reached, queries["vec_id"] == reached["query_id"], "left").select("vec_id", "v", "bound")
    rest = search(asked.mapInArrow(expand(True), schema))
    found = best(first.unionAll(rest))
    names = [whole.select(F.col("rid").alias(f"__{side}"), F.col("vec_id").alias(f"{side}_name")) for side in ("query", "other")]
    named = found.join(names[0], F.col("query_id") == F.col("__query")).join(names[1], F.col("vec_id") == F.col("__other"))
    return named.select(F.col("query_name").alias("query_id"), "rank", F.col("other_name").alias("vec_id"), "score")


ORACLE_SQL = """
WITH clean AS (
  SELECT vec_id, embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), ints AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS v FROM clean
), pairs AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM ints q JOIN ints c ON q.vec_id % 20 = 0 AND q.rid <> c.rid
)
SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
FROM pairs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) <= 20
"""
