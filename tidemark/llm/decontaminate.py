"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of an item (a shorter item is one
window). It is a set of shingles, and a text that contains the window contains
all of them, so joining one shingle of each window is enough: the rarest. That
is the prefix filter at full containment.

1. Benchmark windows and their shingles of ``SHINGLE`` words (fewer for shorter
   windows).
2. One pass over the texts: words, shingle hashes with their positions, joined
   with the distinct benchmark shingles. What matches is checkpointed with one
   row for each text.
3. Rarity: how often each matched shingle occurs in the texts. Every window
   keeps its rarest shingle; a window with a shingle that never occurs is out.
4. Matches of a window's rarest shingle give candidate places. Positional
   bound: the window must not start before the text. Length bound: it must end
   within it.
5. Candidates join their texts, and the window's words are compared with the
   text's words at that place: exact containment.

Built-in functions only. The benchmark side is broadcast if its shingle count,
which is counted first, is small enough, and joined by a shuffle otherwise.

Defined results: null or wordless text: 0 words, no hits; null or wordless
items have no window. Repeated rows of documents each get a row, repeated items
count once by item_id, null item_ids are left out. Items that share windows are
all named. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, cut
from tidemark.session import configure, scratch_root

WIDTH = 10
SHINGLE = 4
BROADCAST_ROWS = 1_000_000  # shingles of at most some 20 bytes each
BROADCAST_BYTES = 32 << 20


def words_of(text: Column) -> Column:
    parts = F.split(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    # Only the first and the last part can be empty.
    return F.filter(parts, lambda w: w != "")


def shingle_hashes(words: Column, n: int, start: Column, end: Column) -> Column:
    """Hashes of the runs of n words that begin at places start to end (from 0)."""

    def one(i):
        return F.xxhash64(*[F.get(words, i + k) for k in range(n)])

    return F.when(end >= start, F.transform(F.sequence(start, end), one)).otherwise(F.array().cast("array<bigint>"))


def windows(benchmark: DataFrame, width: int) -> DataFrame:
    """item_id, win (the window's words) of every distinct window of every item."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string").alias("item_id"), words_of(F.col("text")).alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - width, F.lit(0))
    return items.select("item_id", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, width))).alias("win")).distinct()


def bounded(df: DataFrame, size: Column, rows: int) -> DataFrame:
    """``df`` hinted for broadcast if its own rows and bytes (``size`` of a row) are within the bounds, else as it is."""
    found = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).collect()[0]
    return F.broadcast(df) if found["n"] <= rows and found["bytes"] <= BROADCAST_BYTES else df


def contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for every row of ``documents``."""
    return keyed_contamination(documents, benchmark, width, shingle, broadcast_rows).drop("key")


def keyed_contamination(documents: DataFrame, benchmark: DataFrame, width: int = WIDTH, shingle: int = SHINGLE, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The same, with the rows' keys."""
    spark = configure(documents.sparkSession)
    scratch_root(spark)
    found = cut(windows(benchmark, width))
    distinct = found.select("win").distinct().withColumn("wid", F.xxhash64("win", F.size("win")))
    size = F.least(F.size("win"), F.lit(shingle))
    sizes = sorted(r[0] for r in distinct.select(size.alias("n")).distinct().collect())  # at most ``shingle`` values

    # Every window's shingles: (wid, len, off, size, h).
    def at_size(n: int) -> DataFrame:
        rows = distinct.where(size == n).withColumn("hs", shingle_hashes(F.col("win"), n, F.lit(0), F.size("win") - n))
        return rows.select("wid", F.size("win").alias("len"), F.posexplode("hs").alias("off", "h"))

    need = None
    for n in sizes:
        need = at_size(n) if need is None else need.unionAll(at_size(n))
    if need is None:
        need = distinct.select("wid", F.size("win").alias("len"), F.lit(0).alias("off"), F.lit(0).cast("long").alias("h"))
    need = cut(need)
    keys = need.select("h").distinct()

    docs = documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    texts = docs.select("doc_id", "key", words_of(F.col("text")).alias("w"))
    hashes = F.concat(*[shingle_hashes(F.col("w"), n, F.lit(0), F.size("w") - n) for n in sizes]) if sizes else F.array().cast("array<bigint>")
    # One list of hashes for a text: those of the first size come first, so the place gives position and size.
    spread = texts.select("doc_id", "key", F.size("w").alias("n_words"), hashes.alias("hs")).select("doc_id", "key", "n_words", F.posexplode_outer("hs").alias("i", "h"))
    marked = keys.withColumn("hit", F.lit(True))
    seen = spread.join(bounded(marked, F.lit(16), broadcast_rows), "h", "left").where(F.col("hit") | (F.coalesce("i", F.lit(0)) == 0))
    seen = cut(seen.select("doc_id", "key", "n_words", F.coalesce("i", F.lit(0)).alias("i"), "h", F.coalesce("hit", F.lit(False)).alias("hit")))

    # Place within the text, for the sizes before it in the list.
    pos, before = F.col("i"), F.lit(0)
    for n in sizes:
        inside = (F.col("i") >= before) & (F.col("i") < before + F.greatest(F.col("n_words") - n + 1, F.lit(0)))
        pos = F.when(inside, F.col("i") - before).otherwise(pos)
        before = before + F.greatest(F.col("n_words") - n + 1, F.lit(0))
    matches = seen.where("hit").select("key", "n_words", pos.alias("pos"), "h").distinct()

    rarity = matches.groupBy("h").agg(F.count("*").alias("freq"))
    ranked = need.join(rarity, "h", "left").withColumn("freq", F.coalesce("freq", F.lit(0)))
    prefix = ranked.groupBy("wid", "len").agg(F.min(F.struct("freq", "h", "off")).alias("rarest")).where("rarest.freq > 0")
    # One row for each window with a shingle in the corpus; read twice, so computed once.
    prefix = cut(prefix.select("wid", "len", F.col("rarest.h").alias("h"), F.col("rarest.off").alias("off")))
    start = F.col("pos") - F.col("off")
    candidates = (
        matches.join(bounded(prefix, F.lit(32), broadcast_rows), "h")
        .where((start >= 0) & (start + F.col("len") <= F.col("n_words")))
        .select("key", start.alias("start"), "wid")
        .distinct()
    )
    content = distinct.select("wid", "win")
    placed = candidates.join(bounded(content, F.length(F.concat_ws(" ", "win")) + 8 * F.size("win"), broadcast_rows), "wid").groupBy("key").agg(F.collect_list(F.struct("start", "wid", "win")).alias("c"))
    of_text = docs.select("key", "text").join(placed, "key").select("key", "c", words_of(F.col("text")).alias("w"))
    true = of_text.select(
        "key",
        F.filter("c", lambda x: F.slice(F.col("w"), x["start"] + 1, F.size(x["win"])) == x["win"]).alias("c"),
    ).where(F.size("c") > 0)
    true = cut(true.select("key", F.transform("c", lambda x: F.struct(x["start"].alias("start"), F.size(x["win"]).alias("len"), x["wid"].alias("wid"))).alias("c")).dropDuplicates(["key"]))

    def covered(c):
        """Words inside the union of the windows, taken in order of their starts."""
        ordered = F.array_sort(c)
        zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))

        def step(acc, x):
            end = x["start"] + x["len"]
            return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["n"] + F.greatest(end - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("n"))

        return F.aggregate(ordered, zero, step, lambda acc: acc["n"])

    hits = true.select("key", covered(F.col("c")).cast("long").alias("n_hit"))
    named = true.select("key", F.explode(F.array_distinct(F.transform("c", lambda x: x["wid"]))).alias("wid"))
    owners = found.select("item_id", F.xxhash64("win", F.size("win")).alias("wid")).distinct()
    items = named.join(bounded(owners, F.length("item_id") + 16, broadcast_rows), "wid").groupBy("key").agg(F.collect_set("item_id").alias("items"))
    joined = hits.join(items, "key", "left")
    own = seen.where("i = 0").select("doc_id", "key", F.col("n_words").cast("long").alias("n_words"))
    none = F.coalesce("items", F.array().cast("array<string>"))
    return own.join(joined, "key", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(none).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(none)), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "key",
    )


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` without any benchmark window, all columns kept; rows that share a doc_id, or have none, are judged by their own texts."""
    bad = keyed_contamination(documents, benchmark).where("contaminated").select(F.col("doc_id").alias("of"), F.col("key").alias("of_key")).distinct()
    matched = documents["doc_id"].eqNullSafe(bad["of"]) & (F.xxhash64(documents["doc_id"], documents["text"]) == bad["of_key"])
    return documents.join(bad, matched, "left_anti")


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), b AS (
  SELECT item_id::VARCHAR AS item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, w[i + 1 : i + 10] AS win FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)
), lens AS (
  SELECT DISTINCT len(win) AS n FROM win
), places AS (
  SELECT doc_id, n, i, w[i + 1 : i + n] AS win FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (
  SELECT p.doc_id, p.n, p.i, v.item_id FROM places p JOIN win v ON p.win = v.win
), covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM (SELECT DISTINCT doc_id, n, i FROM hit)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
