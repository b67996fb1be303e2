"""Sharding by rendezvous hashing over weighted shards.

Every shard draws a score for a record key; the record goes to the shard
with the best one. A new shard draws its own scores and can only win
records for itself, so nothing moves between the old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, staged

SHARDS = 16


def rendezvous_shard(key: Column, weights: Sequence[float]) -> Column:
    """Shard number for a key: the smallest of ``-ln(u) / weight`` with
    ``u`` uniform from the hash of (key, shard); shard ``s`` gets a share
    proportional to its weight. Depends on the key and the weights alone.
    A null key counts as the text ''. Weights must be positive."""
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive and not empty")
    text = F.coalesce(key.cast("string"), F.lit(""))
    draws = []
    for s, w in enumerate(weights):
        u = (F.shiftrightunsigned(F.xxhash64(text, F.lit(s)), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
        draws.append(F.struct((-F.log(u) / F.lit(float(w))).alias("draw"), F.lit(s).alias("s")))
    return F.array_min(F.array(*draws))["s"]


def assign_shards(docs: DataFrame, weights: Sequence[float], grown: Sequence[float] | None = None,
                  key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per record: key, size, text_crc32, shard, grown_shard, slot.

    ``slot`` numbers the records of a shard from 0 in key order (null keys
    first). Records are range-partitioned by key and staged, the counts
    per (range, shard) give the offsets, and rows are numbered within
    (range, shard) only, so no task holds a whole shard. Null text has no
    bytes. Rows that repeat a key all get the key's shard and a slot each;
    other columns of the input are not read. An empty table gives no rows.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"))
    rows = rows.select(
        "*", rendezvous_shard(F.col("key"), weights).alias("shard"),
        (rendezvous_shard(F.col("key"), grown) if grown else F.lit(None).cast("int"))
        .alias("grown_shard"))
    order = ["key", "text_crc32", "size"]
    ranged = staged(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()),
                    "shards")
    counts = ranged.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part",
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "part").orderBy(*order)
    return (ranged.withColumn("rank", F.row_number().over(within))
            .join(offsets, ["shard", "part"])
            .select("key", "size", "text_crc32", "shard", "grown_shard",
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot")))


def op8_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 equal shards under the ``key`` law; grown_shard
    is the place with one more shard."""
    placed = assign_shards(documents(spark, sf_dir), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select(F.col("key").alias("doc_id"), "size", "text_crc32",
                         F.lit("key").alias("law"), "shard", "slot", "grown_shard")
