"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. The state scores are linear in features of
the line and of the lines before and after it; a 2 x 2 matrix scores the step
from one line's label to the next. Forward-backward gives each line's marginal
probability of being good, and a document's quality is the mean of these,
weighted by line length.

The field is fitted by gradient ascent on the penalised likelihood of a bounded
random sample of labelled documents (``sample_bytes`` of text at most in
expectation, chosen by a hash of doc_id): every line of a document carries the
document's label. Features, from the text alone, are computed by Spark for the
sample and again for every document that is scored; the fitted weights, some
dozens of numbers, are all that is shipped.

Defined results: null text counts as empty, and an empty text is one empty
line. Without labelled rows every score is 0.5. Labels that are null, or that
name a document more than once with different values, count as the smaller
value. Repeated rows are each scored. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, prepare

SAMPLE_BYTES = 12_000_000
THRESHOLD = 0.3
STEPS = 120

N_OWN = 17
DIGITS, UPPER = b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COMMON, RARE, SPACE = b".,;:'\"()-?", b"!#$%&*+/<=>@[\\]^_`{|}~", b" \t\n\r\x0b\x0c"


def line_features(line: bytes) -> list[float]:
    """What one line says about itself; every value lies between 0 and about 1.

    Bytes beyond ASCII count as letters.
    """
    words = line.split()
    n, m = len(line), len(words)
    if not m:
        return [1.0, 1.0] + [0.0] * (N_OWN - 2)
    digits, upper, common, rare, spaces = (n - len(line.translate(None, x)) for x in (DIGITS, UPPER, COMMON, RARE, SPACE))
    letters = n - digits - common - rare - spaces
    bare = m - len(line.translate(None, COMMON + RARE).split())
    again = sum(map(bytes.__eq__, words, words[1:]))
    capital = upper / max(1, letters)
    return [
        1.0,
        0.0,
        min(n, 2000) / 2000,
        min(m, 50) / 50,
        letters / n,
        capital,
        digits / n,
        common / n,
        rare / n,
        min(1.0, rare / m),
        bare / m,
        len(set(words)) / m,
        again / max(1, m - 1),
        min((n - spaces) / m, 30) / 30,
        float(again > 0.2 * m),
        float(capital > 0.6),
        float(rare > 0.2 * m),
    ]


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row for each line (its own features, then both neighbours'), and the lines' lengths."""
    lines = text.encode("utf-8", "replace").split(b"\n")
    own = np.array([line_features(x) for x in lines])
    edge = np.zeros((1, N_OWN))
    before, after = np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge])
    return np.hstack([own, before[:, 1:], after[:, 1:]]), np.array([max(1, len(x)) for x in lines], float)


N_ALL = N_OWN + 2 * (N_OWN - 1)


class Chains:
    """Documents of different numbers of lines side by side: step t of all chains that are that long."""

    def __init__(self, features: list[np.ndarray]):
        self.order = np.argsort([-len(x) for x in features], kind="stable")
        longest = [features[i] for i in self.order]
        self.lengths = np.array([len(x) for x in longest])
        steps = int(self.lengths.max())
        self.active = [int((self.lengths > t).sum()) for t in range(steps)]
        self.at = np.concatenate(([0], np.cumsum(self.active)))
        starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        stacked = np.concatenate(longest)
        self.rows = np.concatenate([starts[: self.active[t]] + t for t in range(steps)])  # step-major order
        self.features = stacked[self.rows]

    def step(self, t: int) -> slice:
        return slice(self.at[t], self.at[t + 1])

    def marginals(self, weights: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(good) of every line in step-major order, the summed pair marginals, and each chain's log normaliser."""
        score = self.features @ weights  # score of good against bad, for which it is 0
        state = np.stack([np.zeros_like(score), score], 1)
        steps = len(self.active)
        forward, backward = np.empty_like(state), np.zeros_like(state)
        forward[self.step(0)] = state[self.step(0)]
        for t in range(1, steps):
            n = self.active[t]
            last = forward[self.at[t - 1] : self.at[t - 1] + n]
            forward[self.step(t)] = state[self.step(t)] + np.logaddexp(last[:, :1] + moves[0], last[:, 1:] + moves[1])
        for t in range(steps - 2, -1, -1):
            n = self.active[t + 1]
            after = state[self.step(t + 1)] + backward[self.step(t + 1)]
            backward[self.at[t] : self.at[t] + n] = np.logaddexp(after[:, :1] + moves[:, 0], after[:, 1:] + moves[:, 1])
        whole = np.logaddexp(forward[:, 0] + backward[:, 0], forward[:, 1] + backward[:, 1])
        good = np.exp(forward[:, 1] + backward[:, 1] - whole)
        pairs = np.zeros((2, 2))
        for t in range(1, steps):
            n = self.active[t]
            last = forward[self.at[t - 1] : self.at[t - 1] + n]
            after = state[self.step(t)] + backward[self.step(t)]
            both = last[:, :, None] + moves[None] + after[:, None, :] - whole[self.step(t)][:, None, None]
            pairs += np.exp(both).sum(0)
        return good, pairs, whole[: self.active[0]]


class Field:
    """Weights of the states (for good, against bad) and of the moves between them."""

    def __init__(self, weights: np.ndarray | None, moves: np.ndarray | None):
        self.weights, self.moves = weights, moves

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), 0.5)
        both = [text_features(t) for t in texts]
        chains = Chains([x for x, _ in both])
        good, _, _ = chains.marginals(self.weights, self.moves)
        flat = np.empty_like(good)
        flat[chains.rows] = good
        out = np.empty(len(texts))
        ends = np.cumsum(chains.lengths)
        for i, end in zip(chains.order, ends):
            w = both[i][1]
            out[i] = (flat[end - len(w) : end] @ w) / w.sum()
        return np.clip(out, 0.0, 1.0)


def fit(features: list[np.ndarray], labels: np.ndarray, steps: int = STEPS, penalty: float = 1e-4) -> Field:
    """Adam on the mean penalised log likelihood of the label sequences."""
    if not features:
        return Field(None, None)
    chains = Chains(features)
    label = labels[chains.order]
    n = len(chains.features)
    y = np.concatenate([label[:a] for a in chains.active]).astype(float)
    seen = np.zeros((2, 2))
    for v in (0, 1):
        seen[v, v] = (chains.lengths[label == v] - 1).sum()
    x = np.zeros(N_ALL + 4)
    first, second = np.zeros_like(x), np.zeros_like(x)
    for k in range(1, steps + 1):
        good, pairs, _ = chains.marginals(x[:N_ALL], x[N_ALL:].reshape(2, 2))
        gradient = np.concatenate([chains.features.T @ (y - good), (seen - pairs).ravel()]) / n - penalty * x
        first, second = 0.9 * first + 0.1 * gradient, 0.99 * second + 0.01 * gradient**2
        x = x + 0.15 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    return Field(x[:N_ALL], x[N_ALL:].reshape(2, 2))


def learn(documents: DataFrame, labels: DataFrame, sample_bytes: int = SAMPLE_BYTES, holdout: int | None = 5) -> Field:
    """Fit on labelled documents; rows whose crc32(doc_id) mod ``holdout`` is 0 are left out."""
    prepare(documents.sparkSession)
    marked = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    train = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    if holdout:
        train, marked = (x.where(crc_mod(F.col("doc_id"), holdout) != 0) for x in (train, marked))
    train = train.withColumn("size", F.octet_length("text"))
    sizes = train.select("doc_id", "size").join(marked, "doc_id", "left_semi").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).collect()[0]
    if not sizes["rows"]:
        return Field(None, None)
    share = min(1.0, sample_bytes / max(1, sizes["n"] or 0))
    chosen = (F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)) < share
    sample = train.where(chosen).join(marked.where(chosen), "doc_id").select(F.col("quality").cast("int").alias("quality"), "text")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [text_features(t)[0].astype(np.float32).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], ["quality", "features"])

    rows = sample.mapInArrow(features, "quality int, features binary").toPandas()
    return fit([np.frombuffer(x, np.float32).reshape(-1, N_ALL).astype(float) for x in rows["features"]], rows["quality"].to_numpy())


def score(documents: DataFrame, field: Field, threshold: float = THRESHOLD, holdout: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    spark = prepare(documents.sparkSession)
    shared = spark.sparkContext.broadcast(field)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = shared.value.scores(batch.column(2).to_pylist()) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array((scores >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    docs = documents.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), holdout) == 0, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def quality_classifier(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    return score(documents, learn(documents, labels, sample_bytes), threshold)


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """The rows of ``documents`` whose score reaches the threshold, all columns kept, in one pass over the texts."""
    field = learn(documents, labels, sample_bytes)
    shared = documents.sparkSession.sparkContext.broadcast(field)
    at = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(shared.value.scores([t or "" for t in batch.column(at).to_pylist()]) >= threshold))

    return documents.mapInArrow(run, documents.schema)
