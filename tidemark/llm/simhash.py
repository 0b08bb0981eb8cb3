"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints: a text's words (A-Z lower-cased) give shingles, repeats included;
bit i of the fingerprint is 1 if it is set in over half the shingles' hashes.

Links: two fingerprints link when at most ``distance`` bits differ. The 64 bits
are dealt into parts, correlated bits into the same part. If thresholds t of
the parts add up to distance - parts + 1, then fingerprints within the distance
differ by at most t in some part (t = -1: that part is not probed). Every
distinct fingerprint chooses its own thresholds, by dynamic programming on the
candidates each would bring, estimated from histograms of the parts' values.
It probes the values within t of its own value in each part; who has such a
value is a candidate and is verified on all 64 bits.

What is shuffled are distinct fingerprints, so copies of a text cost one row.
Inside a bucket (part, value) verified links are reduced to a spanning forest
before they leave the task; the number of links out of a bucket is below its
number of rows. Histograms (at most 2^16 values for 16 bits) are the only thing
collected.

A bucket that more than ``crowd`` fingerprints share is not probed by anyone.
All its members, and all who would have probed it, instead give their value and
its 64 neighbours at one bit as keys. Two fingerprints within two bits have
such a key in common, and fingerprints with a common key are within two bits,
so linking each to the smallest with that key is exact, and linear in the
bucket. (For a distance of one the pair is verified again; larger distances
raise the bound on a bucket instead of this.)

Defined results: null or wordless text: fingerprint zero, linked like any
other. A text of fewer words than a shingle has one shingle, all its words.
Repeated rows each get a row; a null doc_id gets a fingerprint and the smallest
doc_id of its component, null if there is none. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, prepare, sorted_groups
from tidemark.llm.components import connected_components

WORDS = 3
DISTANCE = 2
SEED = 42
CROWD = 20_000
ROW_KEY = "tidemark text key"


def fingerprint(text: str, words: int = WORDS) -> np.uint64:
    return fingerprints([text], words)[0]


def fingerprints(texts: list[str], words: int = WORDS) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    ends = []
    for text in texts:
        parts = text.encode("utf-8", "replace").lower().split()  # bytes.lower and bytes.split know ASCII only
        if parts:
            joined = b" ".join(parts)
            last = list(itertools.accumulate(map(len, parts), lambda a, b: a + 1 + b))
            k = min(words, len(parts))
            first = [0, *[e + 1 for e in last[: len(parts) - k]]]
            hashes += [digest(joined[a:b], SEED) for a, b in zip(first, last[k - 1 :])]
        ends.append(len(hashes))
    out = np.zeros(len(texts), np.uint64)
    ends = np.array(ends, np.int64)
    sizes = np.diff(ends, prepend=0)
    h = np.array(hashes, np.uint64)
    full = np.flatnonzero(sizes)
    at = 0
    while at < len(full):  # runs of texts with some 100,000 shingles, to bound the bit matrix
        to = max(at + 1, int(np.searchsorted(ends[full], (ends[full[at]] - sizes[full[at]]) + 100_000, "right")))
        rows = full[at:to]
        starts = ends[rows] - sizes[rows]
        counts = np.zeros((len(rows), 64), np.int64)
        if len(rows) == 1:
            for a in range(starts[0], ends[rows[0]], 100_000):
                part = h[a : min(a + 100_000, ends[rows[0]])]
                counts[0] += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        else:
            bits = np.unpackbits(h[starts[0] : ends[rows[-1]]].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts = np.add.reduceat(bits, starts - starts[0], axis=0, dtype=np.int32)
        set_ = counts * 2 > sizes[rows][:, None]
        out[rows] = np.packbits(set_, axis=1, bitorder="little").view("<u8").ravel()
        at = to
    return out


def text_key(text: Column) -> Column:
    """What tells texts of one doc_id (or of none) apart; null is as an empty text, like its fingerprint."""
    return F.md5(F.coalesce(text, F.lit("")))


def fingerprint_table(documents: DataFrame, words: int = WORDS, keyed: bool = False) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long); keyed: text_key too."""
    prepare(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = pa.array(fingerprints(batch.column(1).to_pylist(), words).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp, *batch.columns[2:]], ["doc_id", "fp", *more])

    more = ["text_key"] if keyed else []
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[text_key(F.col("text")).alias(c) for c in more])
    return texts.mapInArrow(run, f"doc_id {kind}, fp long" + "".join(f", {c} string" for c in more))


def bits_of(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def part_bits(together: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Deal the bits into parts of equal width, each with the bits most correlated with those already in it."""
    p = np.diag(together) / max(1, n)
    cov = together / max(1, n) - np.outer(p, p)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    like = np.abs(cov / np.outer(sd, sd))
    np.fill_diagonal(like, 0.0)
    left, out = set(range(64)), []
    for k in range(parts):
        width = len(left) // (parts - k)
        rest = sorted(left)
        own = [max(rest, key=lambda b: like[b, rest].sum())]
        while len(own) < width:
            rest = sorted(left - set(own))
            own.append(max(rest, key=lambda b: like[b, own].sum()))
        left -= set(own)
        out.append(sorted(own))
    return out


def gather(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as an integer."""
    out = np.zeros(len(fp), np.uint64)
    for i, b in enumerate(bits):
        out |= (fp >> np.uint64(b) & np.uint64(1)) << np.uint64(i)
    return out


class Parts:
    """The parts of the 64 bits, and what each threshold would cost a fingerprint.

    A part of up to 16 bits is one block with an exact histogram of its values;
    a wider one is estimated as independent blocks.
    """

    def __init__(self, bits: list[list[int]], distance: int, n: int):
        self.bits, self.distance, self.n = bits, distance, n
        self.blocks = []
        for own in bits:
            k = -(-len(own) // 16)
            self.blocks.append([own[i * len(own) // k : (i + 1) * len(own) // k] for i in range(k)])
        self.near: list[list[np.ndarray]] = []

    def set_counts(self, counts: dict[tuple[int, int], np.ndarray]) -> None:
        """counts[part, block][value]; keeps for each value the share of fingerprints at exactly d bits from it."""
        for i, blocks in enumerate(self.blocks):
            rows = []
            for j, own in enumerate(blocks):
                near = np.zeros((self.distance + 1, 1 << len(own)), np.float32)
                near[0] = counts[i, j] / max(1, self.n)
                flip = np.arange(1 << len(own))
                for b in range(len(own)):  # after bit b: differences among the first b + 1 bits only
                    moved = near[:, flip ^ (1 << b)]
                    near[1:] += moved[:-1]
                rows.append(near)
            self.near.append(rows)

    def candidates(self, fp: np.ndarray, part: int) -> np.ndarray:
        """Estimated candidates of each fingerprint in a part, for thresholds 0 to distance."""
        shares = None
        for j, own in enumerate(self.blocks[part]):
            near = self.near[part][j][:, gather(fp, own).astype(np.int64)]
            if shares is None:
                shares = near
            else:
                shares = np.stack([sum(shares[a] * near[d - a] for a in range(d + 1)) for d in range(self.distance + 1)])
        return np.cumsum(shares, 0) * self.n

    def thresholds(self, fp: np.ndarray) -> np.ndarray:
        """The cheapest thresholds (-1 to distance) of each fingerprint; rows add up to distance - parts + 1."""
        m, budget = len(self.bits), self.distance + 1
        best = np.full((budget + 1, len(fp)), np.inf)
        best[0] = 0.0
        chosen = []
        for i in range(m):
            width = len(self.bits[i])
            balls = np.cumsum([1.0, *[self._ball(width, d) for d in range(1, self.distance + 1)]])
            cost = self.candidates(fp, i) + 4.0 * balls[:, None]
            new = best.copy()
            pick = np.zeros(new.shape, np.int8)
            for s in range(1, budget + 1):
                for a in range(1, s + 1):  # a = threshold + 1 of this part
                    value = best[s - a] + cost[a - 1]
                    better = value < new[s]
                    new[s] = np.where(better, value, new[s])
                    pick[s] = np.where(better, a, pick[s])
            best = new
            chosen.append(pick)
        out = np.empty((len(fp), m), np.int8)
        left, row = np.full(len(fp), budget), np.arange(len(fp))
        for i in range(m - 1, -1, -1):
            a = chosen[i][left, row]
            out[:, i] = a - 1
            left = left - a
        return out

    @staticmethod
    def _ball(width: int, d: int) -> float:
        out = 1.0
        for k in range(d):
            out *= (width - k) / (k + 1)
        return out


def probes(value: np.ndarray, width: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and values at one to ``radius`` bits from each value."""
    flips = [sum(1 << b for b in which) for d in range(1, radius + 1) for which in itertools.combinations(range(width), d)]
    rows = np.repeat(np.arange(len(value)), len(flips))
    return rows, (value[:, None] ^ np.array(flips, np.uint64)[None, :]).ravel()


def spanning(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Links of a spanning forest of the graph with these links."""
    parent = list(range(n))
    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        rx, ry = x, y
        while parent[rx] != rx:
            parent[rx] = parent[parent[rx]]
            rx = parent[rx]
        while parent[ry] != ry:
            parent[ry] = parent[parent[ry]]
            ry = parent[ry]
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            out.append((x, y))
    return out


def links(distinct: DataFrame, distance: int = DISTANCE, parts: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct`` (fp) within the distance."""
    spark = prepare(distinct.sparkSession, 10_000)
    n = distinct.count()
    # More parts have fewer bits each: cheap while few fingerprints share a value.
    m = parts or (4 if n <= 1 << 22 else 3 if n <= 1 << 27 else 2)
    if distance != 2:
        m = parts or distance + 2
        crowd = 1 << 62

    def co_occur(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((64, 64))
        for batch in batches:
            bits = bits_of(batch.column(0).to_numpy().view(np.uint64)).astype(np.float32)
            total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(4096, dtype=np.int32)), pa.array(total.ravel())], ["at", "n"])

    together = np.zeros(4096)
    for row in distinct.mapInArrow(co_occur, "at int, n double").groupBy("at").agg(F.sum("n").alias("n")).collect():
        together[row["at"]] = row["n"]
    plan = Parts(part_bits(together.reshape(64, 64), n, m), distance, n)

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {(i, j): np.zeros(1 << len(own), np.int64) for i, blocks in enumerate(plan.blocks) for j, own in enumerate(blocks)}
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for (i, j), total in seen.items():
                total += np.bincount(gather(fp, plan.blocks[i][j]).astype(np.int64), minlength=len(total))
        for (i, j), total in seen.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), i, np.int32)), pa.array(np.full(len(at), j, np.int32)), pa.array(at), pa.array(total[at])], ["part", "block", "value", "n"])

    rows = distinct.mapInArrow(histogram, "part int, block int, value long, n long").groupBy("part", "block", "value").agg(F.sum("n").alias("n")).toPandas()
    counts = {(i, j): np.zeros(1 << len(own)) for i, blocks in enumerate(plan.blocks) for j, own in enumerate(blocks)}
    for (i, j), group in rows.groupby(["part", "block"]):
        counts[i, j][group["value"].to_numpy()] = group["n"].to_numpy()
    plan.set_counts(counts)
    shared = spark.sparkContext.broadcast(plan)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (part, value, fp, kind): 0 has the value, 1 has and probes it, 2 probes it; part -1: a crowd's keys."""
        own_plan = shared.value
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            if not len(fp):
                continue
            t = own_plan.thresholds(fp)
            out = []
            crowded = np.zeros(len(fp), bool)
            for i, bits in enumerate(own_plan.bits):
                value = gather(fp, bits)
                hot = own_plan.candidates(fp, i)[0] > crowd
                crowded |= hot
                kind = np.where(t[:, i] >= 0, 1, 0)
                cool = ~hot
                out.append((i, value[cool], fp[cool], kind[cool]))
                for radius in range(1, own_plan.distance + 1):
                    rows = np.flatnonzero(t[:, i] == radius)
                    if len(rows):
                        which, values = probes(value[rows], len(bits), radius)
                        near = rows[which]
                        if crowd < 1 << 62:
                            met = own_plan.candidates(spread_bits(values, bits), i)[0] > crowd
                            crowded[near[met]] = True
                            near, values = near[~met], values[~met]
                        out.append((i, values, fp[near], np.full(len(near), 2)))
            if crowded.any():
                own = fp[crowded]
                flips = np.concatenate([np.zeros(1, np.uint64), np.uint64(1) << np.arange(64, dtype=np.uint64)])
                out.append((-1, (own[:, None] ^ flips[None, :]).ravel(), np.repeat(own, 65), np.zeros(65 * len(own), int)))
            for i, values, who, kind in out:
                for a in range(0, len(values), 50_000):
                    cutoff = slice(a, a + 50_000)
                    k = len(values[cutoff])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, i, np.int32)), pa.array(values[cutoff].view(np.int64)), pa.array(who[cutoff].view(np.int64)), pa.array(kind[cutoff].astype(np.int32))],
                        ["part", "value", "fp", "kind"],
                    )

    dealt = distinct.mapInArrow(deal, "part int, value long, fp long, kind int")

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        part, value, fp, kind = (table.column(c).to_numpy() for c in ("part", "value", "fp", "kind"))
        fp = fp.view(np.uint64)
        edges = np.flatnonzero((part[1:] != part[:-1]) | (value[1:] != value[:-1])) + 1
        left, right = [], []
        for a, b in zip(np.concatenate(([0], edges)), np.concatenate((edges, [len(part)]))):
            if b - a < 2:
                continue
            own, what = fp[a:b], kind[a:b]
            has, asks = np.flatnonzero(what < 2), np.flatnonzero(what > 0)
            if not len(has) or not len(asks):
                continue
            x, y = [], []
            for k in range(0, len(asks), max(1, 2_000_000 // len(has))):
                run = asks[k : k + max(1, 2_000_000 // len(has))]
                i, j = np.nonzero(np.bitwise_count(own[run][:, None] ^ own[has][None, :]) <= distance)
                i, j = run[i], has[j]
                ok = own[i] != own[j]
                if len(i) > 4 * (b - a):  # a dense block: its own forest says the same
                    pairs = spanning(i[ok], j[ok], b - a)
                    x += [p for p, _ in pairs]
                    y += [p for _, p in pairs]
                else:
                    x += i[ok].tolist()
                    y += j[ok].tolist()
            if x:
                for i, j in spanning(np.array(x), np.array(y), b - a):
                    left.append(own[i])
                    right.append(own[j])
        return pa.table({"a": pa.array(np.array(left, np.uint64).view(np.int64)), "b": pa.array(np.array(right, np.uint64).view(np.int64))})

    probed = sorted_groups(dealt.where("part >= 0"), ["part", "value"], [], verify, "a long, b long")
    if crowd >= 1 << 62:
        return probed
    keys = cut(dealt.where("part = -1").select("value", "fp"))
    first = keys.groupBy("value").agg(F.min("fp").alias("first"))
    return probed.unionAll(keys.join(first, "value").where("fp != first").select(F.col("fp").alias("a"), F.col("first").alias("b")).distinct())


def spread_bits(values: np.ndarray, bits: list[int]) -> np.ndarray:
    """Fingerprints that have the given values in the given bits and 0 elsewhere."""
    out = np.zeros(len(values), np.uint64)
    for i, b in enumerate(bits):
        out |= (values >> np.uint64(i) & np.uint64(1)) << np.uint64(b)
    return out


def rooted(table: DataFrame, distance: int, parts: int | None, crowd: int) -> DataFrame:
    """fp, first (its smallest doc_id), root (a fingerprint that names its component) of every distinct fingerprint."""
    distinct = cut(table.groupBy("fp").agg(F.min("doc_id").alias("first")))
    component = connected_components(cut(links(distinct.select("fp"), distance, parts, crowd)))
    return cut(distinct.join(component, distinct["fp"] == component["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))


def simhash_dedup(documents: DataFrame, words: int = WORDS, distance: int = DISTANCE, parts: int | None = None, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id for every row of ``documents``."""
    table = cut(fingerprint_table(documents, words))
    # The smallest doc_id of each component, then of each fingerprint: one row per distinct fingerprint all along.
    roots = rooted(table, distance, parts, crowd)
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    of = roots.join(least, "root").select("fp", "component_id")
    return table.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(documents: DataFrame, words: int = WORDS, distance: int = DISTANCE) -> DataFrame:
    """One row of ``documents`` for each component: that of its smallest doc_id, or without any doc_id one of its rows.

    Rows are told apart by doc_id and text, so texts that share a doc_id, or have none, stand for themselves. Of rows
    that are equal in both, one is kept.
    """
    table = cut(fingerprint_table(documents, words, keyed=True))
    # The first row of each fingerprint, then of each component.
    row = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_key")
    firsts = table.groupBy("fp").agg(F.min(row).alias("row"))
    kept = firsts.join(rooted(table, distance, None, CROWD).select("fp", "root"), "fp").groupBy("root").agg(F.min("row").alias("row"))
    kept = kept.select(F.col("row.doc_id").alias("of"), F.col("row.text_key").alias("of_text"))
    marked = documents.withColumn(ROW_KEY, text_key(documents["text"]))
    same = marked["doc_id"].eqNullSafe(kept["of"]) & (marked[ROW_KEY] == kept["of_text"])
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", ROW_KEY]).drop(ROW_KEY)
