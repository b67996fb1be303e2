"""Hard negatives by angular triangle filtering.

Every row stores its angles to a few reference directions. For an anchor at
angle a and a row at angle b from the same reference, the angle between the
two lies in [|a - b|, a + b]; the references together give an interval of
the cosine, and the norms turn it into bounds of the integer score, widened
by more than the rounding. Only rows whose interval reaches a window (the
best five of the label, or the scores allowed for a positive) are scored in
integers. Rows lie in blocks, near ones together; stretches of a block are
tested by the range of their angles before their rows are.

Anchors are a stated share of the rows, grouped into blocks as well; each
block of rows meets each block of anchors once, and hands on no more than
the best few rows of every anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import batch, staged

ANCHOR_EVERY, CHANGED_EVERY, CLASSES, SCALE = 100, 7, 10, 256
POSITIVES, NEGATIVES = 5, 10
# A negative has at least and at most so many hundredths of the positive's score.
LOW_PERCENT, HIGH_PERCENT = 30, 90
# Reference directions, and the rows (first by hash) they are chosen from.
# They decide how much is filtered, not the result.
REFERENCES, REFERENCE_ROWS = 8, 2048
ROWS_A_BLOCK, ROWS_A_STRETCH, ANCHORS_A_BLOCK = 4096, 64, 256
# Blocks handed to Python at a time.
BATCH_BLOCKS = 4
# Scaled components beyond this are cut to it, so that scores of up to 512
# dimensions fit in 64 bits.
LARGEST = 1 << 27
# Integers below this are exact in float64.
EXACT = 1 << 53
# An arc cosine near 0 or pi is off by up to the root of the float's
# rounding, some 2e-8; the cosine of a sum by less than twice as much.
SLACK = 1e-7


def _rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, x): the rows that take part, one per vec_id."""
    vec, label = F.col("embedding"), F.col("label").cast("bigint")
    bad = F.exists(vec, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(vec, lambda v: F.greatest(F.lit(-LARGEST), F.least(
        F.lit(LARGEST), F.floor(F.greatest(F.lit(-1e15), F.least(F.lit(1e15), v.cast("double")))
                                * SCALE))).cast("bigint"))
    changed = F.when(F.col("vec_id") % CHANGED_EVERY == 0, (label + 1) % CLASSES) \
        .otherwise(label)
    rows = (embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
            .where(F.col("vec_id").isNotNull() & label.isNotNull() & vec.isNotNull())
            .where(~bad).select("vec_id", changed.alias("label"), scaled.alias("x")))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", "x")).alias("r")) \
        .select("vec_id", "r.label", "r.x")


def _matrix(vectors, dim: int) -> np.ndarray:
    """Rows padded with zeros to ``dim`` components."""
    out = np.zeros((len(vectors), dim), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _references(rows: DataFrame) -> np.ndarray:
    """Directions far from one another, from a bounded number of rows."""
    sample = [r.x for r in rows.select("x", "vec_id").orderBy(F.xxhash64("vec_id"), "vec_id")
              .limit(REFERENCE_ROWS).collect()]
    dim = max([len(x) for x in sample], default=0)
    m = _matrix(sample, dim).astype(float)
    norms = np.linalg.norm(m, axis=1)
    m = m[norms > 0] / norms[norms > 0][:, None]
    if not len(m):
        return np.zeros((0, dim))
    chosen = [0]
    nearest = np.abs(m @ m[0])
    while len(chosen) < min(REFERENCES, len(m)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, np.abs(m @ m[chosen[-1]]))
    return m[chosen]


_ANGLES = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int64())),
                     ("norm", pa.float64()), ("angles", pa.list_(pa.float64())),
                     ("near", pa.int32()), ("at", pa.float64())])
_ANGLES_SQL = ("vec_id bigint, label bigint, x array<bigint>, norm double, "
               "angles array<double>, near int, at double")


def _measured(references: Broadcast):
    """Norm and angles of every row; its nearest reference and that angle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = references.value
        for b in batches:
            xs = b.column(2).to_pylist()
            if not xs:
                continue
            dim = max(refs.shape[1], max(map(len, xs)))
            m = _matrix(xs, dim).astype(float)
            norms = np.linalg.norm(m, axis=1)
            cos = (m[:, :refs.shape[1]] @ refs.T) / np.maximum(norms, 1e-300)[:, None]
            angles = np.arccos(np.clip(cos, -1, 1))
            if len(refs):
                near = np.argmin(angles, axis=1)
                at = angles[np.arange(len(xs)), near]
            else:
                near, at = np.zeros(len(xs), int), np.zeros(len(xs))
            yield batch(_ANGLES, b.column(0), b.column(1), b.column(2), norms, list(angles),
                        near.astype(np.int32), at)
    return run


_BLOCK = pa.schema([("block", pa.string()), ("n", pa.int32()), ("dim", pa.int32()),
                    ("ids", pa.binary()), ("labels", pa.binary()), ("x", pa.binary()),
                    ("norms", pa.binary()), ("angles", pa.binary())])
_BLOCK_SQL = ("block string, n int, dim int, ids binary, labels binary, x binary, "
              "norms binary, angles binary")


def _packed(rows_a_block: int):
    """Blocks of rows, in the order they come in."""
    def block(held: list[dict]) -> pa.RecordBatch:
        dim = max(len(r["x"]) for r in held)
        ids = np.array([r["vec_id"] for r in held], np.int64)
        # The least id names the block: ids are unique.
        return batch(_BLOCK, [f"{ids.min()}"], [len(held)], [dim], [ids.tobytes()],
                     [np.array([r["label"] for r in held], np.int64).tobytes()],
                     [_matrix([r["x"] for r in held], dim).tobytes()],
                     [np.array([r["norm"] for r in held]).tobytes()],
                     [np.array([r["angles"] for r in held], float).tobytes()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for b in batches:
            for r in b.to_pylist():
                held.append(r)
                if len(held) == rows_a_block:
                    yield block(held)
                    held = []
        if held:
            yield block(held)
    return run


class Side:
    """Some rows (or anchors) as arrays, with bounds of their scores."""

    def __init__(self, ids, labels, x, norms, angles):
        self.ids, self.labels, self.x, self.norms = ids, labels, x, norms
        self.cos, self.sin = np.cos(angles), np.sin(angles)
        self.angles = angles
        self.largest = int(np.abs(x).max()) if x.size else 0

    def stretches(self) -> None:
        """Least and largest angle and norm of every stretch of rows."""
        self.starts = np.arange(0, len(self.ids), ROWS_A_STRETCH)
        self.low = np.minimum.reduceat(self.angles, self.starts, axis=0)
        self.high = np.maximum.reduceat(self.angles, self.starts, axis=0)
        self.norm_low = np.minimum.reduceat(self.norms, self.starts)
        self.norm_high = np.maximum.reduceat(self.norms, self.starts)
        self.stretch = np.arange(len(self.ids)) // ROWS_A_STRETCH


def _interval(low: np.ndarray, high: np.ndarray, n_low: np.ndarray, n_high: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds from bounds of cosines and of products of norms."""
    slack = SLACK * n_high + 1
    return (np.where(low >= 0, low * n_low, low * n_high) - slack,
            np.where(high >= 0, high * n_high, high * n_low) + slack)


def _stretch_bounds(anchors: Side, i: int, rows: Side) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of anchor i with whole stretches."""
    if not anchors.angles.shape[1]:
        n = len(rows.starts)
        low, high = np.full(n, -1.0), np.full(n, 1.0)
    else:
        a = anchors.angles[i]
        apart = np.maximum(0, np.maximum(a - rows.high, rows.low - a))
        together = np.minimum(np.pi, np.minimum(a + rows.high, 2 * np.pi - a - rows.low))
        high = np.cos(apart).min(axis=1)
        low = np.cos(together).max(axis=1)
    return _interval(low, high, anchors.norms[i] * rows.norm_low, anchors.norms[i] * rows.norm_high)


def _row_bounds(anchors: Side, i: int, rows: Side, at: np.ndarray
                ) -> tuple[np.ndarray, np.ndarray]:
    """Score bounds of anchor i with the rows at ``at``."""
    if not anchors.angles.shape[1]:
        low, high = np.full(len(at), -1.0), np.full(len(at), 1.0)
    else:
        c, s = rows.cos[at] * anchors.cos[i], rows.sin[at] * anchors.sin[i]
        high, low = (c + s).min(axis=1), (c - s).max(axis=1)
    n = anchors.norms[i] * rows.norms[at]
    return _interval(low, high, n, n)


def _scores(anchors: Side, i: int, rows: Side, at: np.ndarray) -> np.ndarray:
    """Integer inner products."""
    dim = min(anchors.x.shape[1], rows.x.shape[1])
    a, x = anchors.x[i, :dim], rows.x[at, :dim]
    if anchors.largest * rows.largest * max(dim, 1) < EXACT:
        return (x.astype(float) @ a.astype(float)).astype(np.int64)
    return x @ a


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first by score descending, then id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))[:k]]


def _kth_largest(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


def _block_of(b: pa.RecordBatch, i: int) -> Side:
    n, dim = b.column("n")[i].as_py(), b.column("dim")[i].as_py()

    def array(name: str, kind, *shape):
        return np.frombuffer(b.column(name)[i].as_py(), kind).reshape(shape)
    rows = Side(array("ids", np.int64, n), array("labels", np.int64, n),
                array("x", np.int64, n, dim), array("norms", np.float64, n),
                array("angles", np.float64, n, -1) if b.column("angles")[i].as_py()
                else np.zeros((n, 0)))
    rows.stretches()
    return rows


def _anchors_of(items: list[dict]) -> Side:
    dim = max(len(a["x"]) for a in items)
    return Side(np.array([a["vec_id"] for a in items], np.int64),
                np.array([a["label"] for a in items], np.int64),
                _matrix([a["x"] for a in items], dim),
                np.array([a["norm"] for a in items]),
                np.array([a["angles"] for a in items], float).reshape(len(items), -1))


_POSITIVE = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()),
                       ("positive_score", pa.int64())])
_POSITIVE_SQL = "anchor_id bigint, positive_id bigint, positive_score bigint"


def _positives(k: int):
    """The best k rows of a block with an anchor's label, itself excepted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                rows, anchors = _block_of(b, j), _anchors_of(b.column("anchors")[j].as_py())
                of_label: dict[int, np.ndarray] = {}
                out = []
                for i in range(len(anchors.ids)):
                    label = int(anchors.labels[i])
                    if label not in of_label:
                        of_label[label] = np.flatnonzero(rows.labels == label)
                    at = of_label[label]
                    at = at[rows.ids[at] != anchors.ids[i]]
                    if len(at) > k:
                        # What reaches the k-th best of the lower bounds.
                        low, high = _stretch_bounds(anchors, i, rows)
                        least = _kth_largest(low[rows.stretch[at]], k)
                        at = at[high[rows.stretch[at]] >= least]
                        low, high = _row_bounds(anchors, i, rows, at)
                        at = at[high >= _kth_largest(low, k)]
                    scores = _scores(anchors, i, rows, at)
                    for p in _best(scores, rows.ids[at], k).tolist():
                        out.append((int(anchors.ids[i]), int(rows.ids[at[p]]), int(scores[p])))
                if out:
                    yield batch(_POSITIVE, *zip(*out))
    return run


_NEGATIVE = pa.schema([*_POSITIVE, ("negative_id", pa.int64()), ("negative_score", pa.int64())])
_NEGATIVE_SQL = _POSITIVE_SQL + ", negative_id bigint, negative_score bigint"


def _negatives(k: int, low_percent: int, high_percent: int):
    """For every positive of an anchor the best k rows of a block that have
    another label and a score in the positive's window."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for j in range(b.num_rows):
                items = b.column("anchors")[j].as_py()
                rows, anchors = _block_of(b, j), _anchors_of(items)
                out = []
                for i, item in enumerate(items):
                    windows = [(p["positive_id"], s := p["positive_score"],
                                -(-low_percent * s // 100), high_percent * s // 100)
                               for p in item["positives"]]
                    windows = [w for w in windows if w[2] <= w[3]]
                    if not windows:
                        continue
                    least, most = min(w[2] for w in windows), max(w[3] for w in windows)
                    low, high = _stretch_bounds(anchors, i, rows)
                    at = np.flatnonzero(((low <= most) & (high >= least))[rows.stretch]
                                        & (rows.labels != anchors.labels[i]))
                    low, high = _row_bounds(anchors, i, rows, at)
                    needed = np.zeros(len(at), bool)
                    for _, _, lo, hi in windows:
                        # Rows surely in the window may fill it.
                        sure = low[(low >= lo) & (high <= hi)]
                        needed |= (low <= hi) & (high >= max(lo, _kth_largest(sure, k)))
                    at = at[needed]
                    scores = _scores(anchors, i, rows, at)
                    for positive, s, lo, hi in windows:
                        inside = np.flatnonzero((scores >= lo) & (scores <= hi))
                        for p in inside[_best(scores[inside], rows.ids[at[inside]], k)].tolist():
                            out.append((int(anchors.ids[i]), positive, s,
                                        int(rows.ids[at[p]]), int(scores[p])))
                if out:
                    yield batch(_NEGATIVE, *zip(*out))
    return run


def _tiles(blocks: DataFrame, anchors: DataFrame, n_blocks: int) -> DataFrame:
    """Every block of rows with every block of anchors (part, anchors): the
    list of their names is dealt out first, then the contents meet by name."""
    names = (blocks.select("block")
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))))
    return blocks.join(names.join(anchors, "part"), "block")


def _first(rows: DataFrame, keys: list[str], score: str, tie: str, k: int, out: str) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(tie))
    return rows.withColumn(out, F.row_number().over(by)).where(F.col(out) <= k)


def hard_negatives(embeddings: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low_percent: int = LOW_PERCENT, high_percent: int = HIGH_PERCENT) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score: for every anchor (vec_id divisible by 100) and each of
    its first ``positives`` rows of the same label, the first ``negatives``
    rows of other labels whose score lies in the positive's window. Higher
    scores come first, ties by the smaller vec_id.

    Left out: rows with a null vec_id, label or vector, or with a component
    that is null or not finite. Of rows that repeat a vec_id the least by
    (label, components) stands. Vectors may differ in length; missing
    components count as 0. Components are floor(256 x), cut to +-2^27. An
    anchor without positives, and a positive whose score is below 0, has no
    rows. No rows give no rows; other columns are not read.
    """
    sc = embeddings.sparkSession.sparkContext
    rows = staged(_rows(embeddings), "negatives-rows")
    references = sc.broadcast(_references(rows))
    measured = staged(rows.mapInArrow(_measured(references), _ANGLES_SQL), "negatives-angles")
    ordered = measured.repartitionByRange("near", "at", "vec_id") \
        .sortWithinPartitions("near", "at", "vec_id").drop("near", "at")
    blocks = staged(ordered.mapInArrow(_packed(ROWS_A_BLOCK), _BLOCK_SQL), "negatives-blocks")

    chosen = measured.where(F.col("vec_id") % ANCHOR_EVERY == 0).drop("near", "at")
    parts = -(-chosen.count() // ANCHORS_A_BLOCK) or 1
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    # About ANCHORS_A_BLOCK distinct ids to a part, dealt by hash.
    fields = ["vec_id", "label", "x", "norm", "angles"]
    anchors = staged(chosen.groupBy("part").agg(
        F.collect_list(F.struct(*fields)).alias("anchors")), "negatives-anchors")
    found = staged(_tiles(blocks, anchors, parts).drop("part", "block")
                   .mapInArrow(_positives(positives), _POSITIVE_SQL),
                   "negatives-positives", BATCH_BLOCKS)
    best = _first(found, ["anchor_id"], "positive_score", "positive_id", positives, "place")

    with_windows = best.groupBy("anchor_id").agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    armed = staged(
        chosen.join(with_windows, F.col("vec_id") == F.col("anchor_id"))
        .groupBy("part").agg(F.collect_list(F.struct(*fields, "positives")).alias("anchors")),
        "negatives-windows")
    out = staged(_tiles(blocks, armed, parts).drop("part", "block")
                 .mapInArrow(_negatives(negatives, low_percent, high_percent), _NEGATIVE_SQL),
                 "negatives-found", BATCH_BLOCKS)
    ranked = _first(out, ["anchor_id", "positive_id"], "negative_score", "negative_id",
                    negatives, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                         "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


OP13_SQL = f"""
WITH part AS (
  SELECT vec_id, CASE WHEN vec_id % {CHANGED_EVERY} = 0 THEN (label::BIGINT + 1) % {CLASSES}
                      ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda v: floor({SCALE} * v::DOUBLE)) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_inner_product(a.x, r.x)::BIGINT AS score
  FROM part a JOIN part r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % {ANCHOR_EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT p.anchor_id, positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER
         AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
WHERE {LOW_PERCENT} * positive_score <= 100 * score
  AND 100 * score <= {HIGH_PERCENT} * positive_score
QUALIFY rank <= {NEGATIVES}
"""
