"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages and only the bag has a label. Every passage
is encoded, a gated attention (tanh and sigmoid branches multiplied) learns
how much each passage counts, and the weighted mean of the encodings is
scored. Training sees a bounded sample of labelled documents on the driver;
scoring runs over all documents, all of their passages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch, documents, hashed_words, spare_memory

PASSAGE = 64  # words
# Training sample: documents per label, each with all its passages. Scoring
# has no such bound.
SAMPLE_PER_LABEL = 2000
ENCODED, ATTENTION = 24, 16
EPOCHS, BAGS, RATE = 30, 64, 0.01
THRESHOLD = 0.3
FOLDS = 5

# Byte classes of the surface features (fixed values); bytes above 0x7F are
# a class of their own.
CLASSES = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789",
           ".,;:'\"-()", "!?", "|<>", "#*$%&@^~_=+/\\{}[]`", "\n")
_HIGH, _REST = len(CLASSES), len(CLASSES) + 1
_CLASS = np.full(256, _REST, np.uint8)
_CLASS[128:] = _HIGH
for _k, _letters in enumerate(CLASSES):
    _CLASS[[ord(x) for x in _letters]] = _k
_CLASS = bytes(_CLASS)
PROJECTED = 16
FEATURES = _REST + 1 + 5 + PROJECTED


def passages(text: str | None) -> np.ndarray:
    """One feature row per passage of a text (none without words): shares
    of byte classes, word length, distinct and repeated words, and the mean
    of the words' hash signs."""
    raw = (text or "").encode()
    words, starts = hashed_words(raw)
    n = len(words)
    if not n:
        return np.empty((0, FEATURES), np.float32)
    first = np.arange(0, n, PASSAGE)
    if len(first) > 1 and n - first[-1] < PASSAGE // 2:
        first = first[:-1]  # a short end belongs to the passage before
    count = np.diff(np.append(first, n))
    which = np.repeat(np.arange(len(first)), count)
    # Bytes: a passage reaches to the first word of the next one.
    cut = np.append(starts[first], len(raw))
    cut[0] = 0
    size = np.diff(cut)
    kind = np.frombuffer(raw.translate(_CLASS), np.uint8)
    cells = np.repeat(np.arange(len(first)) * (_REST + 1), size) + kind
    shares = np.bincount(cells, minlength=len(first) * (_REST + 1)).reshape(len(first), -1)
    shares = shares / size[:, None]
    # Words: distinct ones, and those equal to the word before.
    keys = np.sort((which.astype(np.uint64) << np.uint64(44)) | (words >> np.uint64(20)))
    new = np.ones(n, bool)
    new[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[new] >> np.uint64(44)).astype(np.int64),
                           minlength=len(first)) / count
    again = np.zeros(n)
    again[1:] = words[1:] == words[:-1]
    again = np.add.reduceat(again, first) / count
    signs = np.unpackbits(words.view(np.uint8).reshape(n, 8)[:, :PROJECTED // 8], axis=1)
    mean = np.add.reduceat(signs, first, axis=0, dtype=np.float64) / count[:, None] * 2 - 1
    return np.column_stack([
        shares, size / count / 10, distinct, again, np.log1p(count) / 4,
        np.sqrt((mean ** 2).mean(1)), mean]).astype(np.float32)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def prepare(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.mean) / self.scale, -8, 8)

    def score(self, rows: np.ndarray) -> float:
        """Probability of label 1; a text without words scores 0."""
        if not len(rows):
            return 0.0
        return float(_forward(self.weights, self.prepare(rows), np.array([0]))[-1][0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict, x: np.ndarray, first: np.ndarray):
    """x: passages of some bags, each bag from first[i] on."""
    count = np.diff(np.append(first, len(x)))
    h = np.tanh(x @ w["encode"] + w["encode0"])
    tanh, gate = np.tanh(h @ w["tanh"]), _sigmoid(h @ w["gate"])
    s = (tanh * gate) @ w["attend"]
    e = np.exp(s - np.repeat(np.maximum.reduceat(s, first), count))
    a = e / np.repeat(np.add.reduceat(e, first), count)
    z = np.add.reduceat(a[:, None] * h, first, axis=0)
    return h, tanh, gate, a, z, _sigmoid(z @ w["out"] + w["out0"])


def _gradients(w: dict, x: np.ndarray, first: np.ndarray, y: np.ndarray, cost: np.ndarray):
    count = np.diff(np.append(first, len(x)))
    h, tanh, gate, a, z, p = _forward(w, x, first)
    miss = cost * (p - y) / cost.sum()
    dz = np.repeat(np.outer(miss, w["out"]), count, axis=0)
    da = (h * dz).sum(1)
    ds = a * (da - np.repeat(np.add.reduceat(a * da, first), count))
    dg = np.outer(ds, w["attend"])
    dt, du = dg * gate * (1 - tanh ** 2), dg * tanh * gate * (1 - gate)
    dh = (a[:, None] * dz + dt @ w["tanh"].T + du @ w["gate"].T) * (1 - h ** 2)
    return {"encode": x.T @ dh, "encode0": dh.sum(0), "tanh": h.T @ dt, "gate": h.T @ du,
            "attend": (tanh * gate).T @ ds, "out": z.T @ miss, "out0": miss.sum(keepdims=True)}


def train(bags: list[np.ndarray], labels: np.ndarray, cost: np.ndarray, seed: int = 7) -> Model:
    """Fit the encoder, the gated attention and the scorer with Adam.
    ``cost`` weighs the bags. Without bags every text scores by the bias."""
    rng = np.random.default_rng(seed)
    shapes = {"encode": (FEATURES, ENCODED), "encode0": (ENCODED,), "tanh": (ENCODED, ATTENTION),
              "gate": (ENCODED, ATTENTION), "attend": (ATTENTION,), "out": (ENCODED,),
              "out0": (1,)}
    w = {k: rng.normal(0, 1 / np.sqrt(v[0]), v) * (k[-1] != "0") for k, v in shapes.items()}
    if not bags:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), w)
    every = np.concatenate(bags)
    model = Model(every.mean(0), every.std(0) + 1e-3, w)
    bags = [model.prepare(b) for b in bags]
    m1 = {k: np.zeros(v) for k, v in shapes.items()}
    m2 = {k: np.zeros(v) for k, v in shapes.items()}
    step = 0
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for lo in range(0, len(bags), BAGS):
            take = order[lo:lo + BAGS]
            x = np.concatenate([bags[i] for i in take])
            first = np.cumsum([0, *[len(bags[i]) for i in take[:-1]]])
            step += 1
            for k, g in _gradients(w, x, first, labels[take], cost[take]).items():
                g = g + 1e-4 * w[k]
                m1[k] += 0.1 * (g - m1[k])
                m2[k] += 0.01 * (g * g - m2[k])
                w[k] -= rate * (m1[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-8)
    return model


def held_out(key):
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
        label: str = "quality", per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Train on at most ``per_label`` documents of each label, those with
    the smallest key hashes, outside the held-out fold. Rows without key or
    label are not used, texts without words neither. The bags are weighted
    back to the labels' shares in the whole table."""
    usable = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where(
        F.col("k").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("k")))
    shares = dict(usable.groupBy("y").count().collect())
    sample = None
    for y in sorted(shares):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(per_label)
        sample = part if sample is None else sample.unionByName(part)
    if sample is None:
        return train([], np.empty(0), np.empty(0))

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, y, t in zip(*(c.to_pylist() for c in b.columns)):
                rows = passages(t)
                if len(rows):
                    yield batch(_BAG, [k], [y], [rows.tobytes()])

    # The sample is bounded by its limits, so it can be broadcast.
    rows = (docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
            .join(F.broadcast(sample.select(F.col("k").cast("bigint").alias("k"), "y")), "k")
            .select(F.col("k").cast("bigint"), "y", "t")
            .mapInArrow(bags, "k bigint, y int, bag binary").toArrow().sort_by("k"))
    labels_ = rows.column("y").to_numpy()
    found = [np.frombuffer(x, np.float32).reshape(-1, FEATURES)
             for x in rows.column("bag").to_pylist()]
    counts = {y: max(1, int((labels_ == y).sum())) for y in shares}
    cost = np.array([shares[y] / counts[y] for y in labels_.tolist()])
    return train(found, labels_.astype(float), cost)


_BAG = pa.schema([("k", pa.int64()), ("y", pa.int32()), ("bag", pa.binary())])


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` rows as (key, score), one per row. Null and blank texts
    score 0; null keys and repeated rows are scored like all others."""
    schema = pa.schema([("key", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_memory()
        for b in batches:
            yield batch(schema, b.column(0), [model.score(passages(t.as_py()))
                                              for t in b.column(1)])

    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string")) \
        .mapInArrow(run, "key bigint, score double")


def op1_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return scores(docs, fit(docs, labels)).select(
        F.col("key").alias("doc_id"), held_out(F.col("key")).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD,
             text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, all columns."""
    schema = docs.schema
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_memory()
        for b in batches:
            keep = [model.score(passages(t.as_py())) >= threshold for t in b.column(at)]
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, schema)
