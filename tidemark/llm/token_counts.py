"""Token counts without token ids.

Every text is split into pre-tokens. Each distinct pre-token of the corpus goes
through the tokenizer once, and a text's count is the sum of its pre-token
frequencies times their pieces.

1. Distinct pre-tokens with their corpus frequency: counted inside each batch,
   then grouped.
2. Pieces of each distinct pre-token, from the tokenizer library itself.
3. The join. Pre-token frequencies follow a power law, so the ``head_size``
   most frequent pre-tokens (a fixed bound, whatever the corpus) are broadcast
   and summed where the text is read; only occurrences of rarer ones are
   shuffled and joined by key. A hot key is thus never shuffled.

Pre-tokens: ``pattern`` splits texts whose characters all lie below U+0558,
where it agrees with the library's splitter on every code point; other texts
use the library's splitter. Added special tokens inside a text are cut out
first and count one each, which is the library's default.

Defined results: null or empty text: 0 bytes, 0 tokens. Repeated rows are each
counted. Other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import os
from collections import Counter, defaultdict
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import cut, prepare

HEAD_SIZE = 200_000
LIMIT = 1024
FLUSH = 100_000  # distinct pre-tokens held in a task before they are passed on


@functools.lru_cache(maxsize=1)
def library(path: str) -> Tokenizer:
    """One tokenizer for each worker. The workers are the parallelism, so it starts no threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    own = Tokenizer.from_file(path)
    own.encode_special_tokens = True
    return own


@functools.lru_cache(maxsize=1)
def splitter(path: str, pattern: str) -> Splitter:
    return Splitter(path, pattern)


class Splitter:
    """Pre-tokens of a text, and how many special tokens were cut out of it."""

    ODD = regex.compile("[^\x00-\u0557]")

    def __init__(self, path: str, pattern: str):
        self.path = path
        self.split = regex.compile(pattern).findall
        with open(path, encoding="utf-8") as f:
            special = [t["content"] for t in json.load(f).get("added_tokens", ())]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None

    def pieces(self, text: str) -> tuple[list[str], int]:
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for part in parts:
            if self.ODD.search(part):
                out += [part[a:b] for _, (a, b) in library(self.path).pre_tokenizer.pre_tokenize_str(part)]
            else:
                out += self.split(part)
        return out, len(parts) - 1


def token_counts(
    documents: DataFrame,
    tokenizer: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    limit: int = LIMIT,
    head_size: int = HEAD_SIZE,
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``documents``."""
    spark = prepare(documents.sparkSession, 256)
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    kind = documents.schema["doc_id"].dataType.simpleString()
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, seen = splitter(path, pattern), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(split.pieces(text)[0])
            if len(seen) >= FLUSH:
                yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "n"])
                seen.clear()
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.string()), pa.array(seen.values(), pa.int64())], ["piece", "n"])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = library(path)
        for batch in batches:
            found = own.encode_batch_fast(batch.column(0).to_pylist(), add_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int32())], ["piece", "n", "tokens"])

    distinct = docs.select("text").mapInArrow(frequencies, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    table = cut(distinct.mapInArrow(encode, "piece string, n long, tokens int"))

    # The smallest frequency that keeps the head within its bound.
    by_n = table.groupBy(F.least("n", F.lit(1 << 20)).cast("int").alias("n")).count().orderBy(F.desc("n")).limit(head_size).collect()
    total, least = 0, None
    for row in by_n:
        total += row["count"]
        if total > head_size:
            break
        least = row["n"]
    rows = table.where(F.col("n") >= least).select("piece", "tokens").toPandas() if least is not None else None
    head = spark.sparkContext.broadcast(dict(zip(rows["piece"], rows["tokens"].tolist())) if rows is not None else {})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = splitter(path, pattern), head.value
        for batch in batches:
            ids, rids, texts = batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            counts, rare = [], defaultdict(list)
            for i, text in enumerate(texts):
                pieces, special = split.pieces(text)
                got = list(map(known.get, pieces))
                if None in got:
                    for piece, n in zip(pieces, got):
                        if n is None:
                            rare[piece].append(rids[i])
                    counts.append(special + sum(filter(None, got)))
                else:
                    counts.append(special + sum(got))
            n = len(texts)
            sizes = pa.array([len(t.encode("utf-8", "replace")) for t in texts], pa.int64())
            # A text's own row has no pre-token to join; its key only spreads it.
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([f"\x00{r}" for r in rids]), pa.array([True] * n), ids, sizes, pa.array(counts, pa.int64()), pa.nulls(n, pa.list_(pa.int64()))],
                names,
            )
            if rare:
                m = len(rare)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, pa.int64()), pa.array(list(rare)), pa.array([False] * m), pa.nulls(m, ids.type), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(list(rare.values()), pa.list_(pa.int64()))],
                    names,
                )

    names = ["rid", "piece", "own", "doc_id", "n_bytes", "n", "rids"]
    first = docs.select("doc_id", F.monotonically_increasing_id().alias("rid"), "text").mapInArrow(
        summed, f"rid long, piece string, own boolean, doc_id {kind}, n_bytes long, n long, rids array<long>"
    )
    tail = table.select("piece", "tokens")
    if least is not None:
        tail = tail.where(F.col("n") < least)
    joined = first.join(tail, "piece", "left")
    spread = joined.select(
        F.explode(F.when(F.col("own"), F.array("rid")).otherwise(F.col("rids"))).alias("rid"),
        "own",
        "doc_id",
        "n_bytes",
        F.when(F.col("own"), F.col("n")).otherwise(F.col("tokens").cast("long")).alias("n"),
    )
    return (
        spread.groupBy("rid")
        .agg(F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("n").alias("n_tokens"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
    )
