"""Event-time operators on streams (additions beyond the plain totals).

* ``windowed_totals`` – tumbling-window totals per category with a
  watermark; state for a window is dropped once the watermark passes it.
* ``dedupe_within_watermark`` – drop repeated txn_ids seen within the
  watermark delay (bounded state, unlike a global dedupe).
* ``cleaning.drop_orphans`` works on a stream as on a batch (stream-static
  semi-join against a dimension).

``withWatermark`` needs a TIMESTAMP (with time zone) column; a
``timestamp_ntz`` column is cast (session time zone UTC).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.streaming.tiers import FANOUT, TieredBatches, newest
from ledgerlake.streaming.totals import _trigger


def _event_time(df: DataFrame, ts: str) -> DataFrame:
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df


def windowed_totals(events: DataFrame, *, ts: str = "txn_ts", size: str = "1 day",
                    delay: str = "1 day") -> DataFrame:
    ev = _event_time(events, ts).withWatermark(ts, delay)
    return (ev.groupBy(F.window(ts, size).alias("w"), "category")
            .agg(F.sum("amount").alias("total"), F.count(F.lit(1)).alias("txn_count"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "category", "total", "txn_count"))


WINDOW_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampType(), True),
    T.StructField("window_end", T.TimestampType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("total", T.DoubleType(), True),
    T.StructField("txn_count", T.LongType(), True),
    T.StructField("batch_id", T.LongType(), True),
])


def windows_store(out_path: str, fanout: int = FANOUT) -> TieredBatches:
    """The batches of ``start_windowed_totals``; fold and vacuum them here."""
    return TieredBatches(out_path, WINDOW_SCHEMA, newest(
        ["window_start", "category"], ["window_end", "total", "txn_count"]), fanout)


def start_windowed_totals(events: DataFrame, out_path: str, checkpoint: str, *,
                          size: str = "1 day", delay: str = "1 day",
                          trigger: str | None = "availableNow") -> StreamingQuery:
    """Update mode: each batch writes the windows it changed to
    ``<out>/batch_id=<id>`` (overwrite → replay-safe)."""
    w = (windowed_totals(events, size=size, delay=delay).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(windows_store(out_path).write))
    return _trigger(w, trigger).start()


def latest_windows(spark: SparkSession, out_path: str) -> DataFrame:
    store = windows_store(out_path)
    return store.merge(store.rows(spark)).select(
        "window_start", "window_end", "category", "total", "txn_count")


def dedupe_within_watermark(events: DataFrame, *, key: str = "txn_id", ts: str = "txn_ts",
                            delay: str = "1 hour") -> DataFrame:
    ev = _event_time(events, ts).withWatermark(ts, delay)
    return ev.dropDuplicatesWithinWatermark([key])
