"""Running totals per category.

Two forms:

* ``start_running_totals`` – Spark's state store holds
  ``(category → running_total, txn_count)``; ``update`` mode emits only the
  categories a micro-batch changed, and ``foreachBatch`` appends them to
  ``<out>/batch_id=<id>``. The current totals are the row of the newest
  batch per category (``latest_totals``). A replayed batch rewrites its own
  folder with the same rows, so a retry never double counts. Offsets and
  state live in the checkpoint. ``totals_store`` folds the batches.

* ``CategoryLedger`` – the per-invocation merge of the original consumer,
  made idempotent: each micro-batch writes its partial sums
  ``(category, total, n)`` to ``<ledger>/batch_id=<id>`` with overwrite.
  The view sums the ledger: ``running_total``, ``txn_count`` (records) and
  ``batch_count`` (batches that touched the category – the count the
  original consumer kept under the name txn_count).
  The ledger belongs to one checkpoint: batch ids restart at 0 with a new
  checkpoint, so give each run its own ledger folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.streaming.parse import bad_events, good_events
from ledgerlake.streaming.tiers import FANOUT, TieredBatches, newest

TOTALS_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), True),
    T.StructField("running_total", T.DoubleType(), True),
    T.StructField("txn_count", T.LongType(), True),
    T.StructField("batch_id", T.LongType(), True),
])


def category_totals(events: DataFrame) -> DataFrame:
    """Per-category sum and record count (batch or streaming input)."""
    return events.groupBy("category").agg(F.sum("amount").alias("running_total"),
                                          F.count(F.lit(1)).alias("txn_count"))


def with_batch_metrics(events: DataFrame, name: str = "batch") -> DataFrame:
    """Attach per-micro-batch metrics (records, amount sum) to a stream;
    they appear in ``query.lastProgress["observedMetrics"][name]``."""
    return events.observe(name, F.count(F.lit(1)).alias("records"),
                          F.sum("amount").alias("amount_sum"))


def _trigger(writer, trigger):
    if trigger == "availableNow":
        return writer.trigger(availableNow=True)
    if trigger:
        return writer.trigger(processingTime=trigger)
    return writer


def totals_store(out_path: str, fanout: int = FANOUT) -> TieredBatches:
    """The batches of ``start_running_totals``; fold and vacuum them here."""
    return TieredBatches(out_path, TOTALS_SCHEMA,
                         newest(["category"], ["running_total", "txn_count"]), fanout)


def start_running_totals(events: DataFrame, out_path: str, checkpoint: str, *,
                         trigger: str | None = "availableNow",
                         name: str | None = None) -> StreamingQuery:
    w = (category_totals(events).writeStream.outputMode("update")
         .option("checkpointLocation", checkpoint).foreachBatch(totals_store(out_path).write))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def latest_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """Current totals: per category, the row written by the newest batch."""
    store = totals_store(out_path)
    return store.merge(store.rows(spark)).drop("batch_id")


LEDGER_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("total", T.DoubleType(), True),
    T.StructField("n", T.LongType(), True),
    T.StructField("batches", T.LongType(), True),
    T.StructField("reason", T.StringType(), True),
    T.StructField("data", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])
# Kinds of ledger rows: the sums of a category in one batch and in folded
# ones, a rejected envelope, a folded batch (n records in ``batches``
# categories).
SUM, FOLDED, BAD, BATCH = "sum", "folded", "bad", "batch"


def _ledger_rows(df: DataFrame, kind: str, **columns) -> DataFrame:
    values = {f.name: F.lit(None).cast(f.dataType) for f in LEDGER_SCHEMA.fields
              if f.name != "batch_id"}
    values |= {"kind": F.lit(kind), **columns}
    if "batch_id" in df.columns:
        values.setdefault("batch_id", F.col("batch_id"))
    return df.select(*[c.alias(n) for n, c in values.items()])


def _batches(rows: DataFrame) -> DataFrame:
    """One row per batch: those kept by folds, and those of unfolded sums."""
    fresh = rows.where(F.col("kind") == SUM).groupBy("batch_id").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"))
    return rows.where(F.col("kind") == BATCH).unionByName(
        _ledger_rows(fresh, BATCH, n=F.col("n"), batches=F.col("batches"))
        .select(*rows.columns))


def _merge_ledger(rows: DataFrame) -> DataFrame:
    """Sums by category; rejected envelopes and batch rows are carried on."""
    sums = rows.where(F.col("kind").isin(SUM, FOLDED)).groupBy("category").agg(
        F.sum("total").alias("total"), F.sum("n").alias("n"), F.sum("batches").alias("batches"),
        F.max("batch_id").alias("batch_id"))
    return (_ledger_rows(sums, FOLDED, category=F.col("category"), total=F.col("total"),
                         n=F.col("n"), batches=F.col("batches")).select(*rows.columns)
            .unionByName(rows.where(F.col("kind") == BAD))
            .unionByName(_batches(rows)))


class CategoryLedger:
    """Idempotent per-batch ledger of partial category sums.

    One write per micro-batch into ``<path>/live/batch_id=<id>``: the
    partial sums, plus - when the input carries ``_bad`` from
    ``decode_events`` - the rejected envelopes with their reason. A replayed
    batch overwrites its own folder with the same content.

    ``compact`` folds batches level by level (``tiers.TieredBatches``):
    sums are added up, rejected envelopes and batch rows carried on, so
    nothing is lost when ``vacuum`` deletes the folded folders.
    """

    def __init__(self, path: str, fanout: int = FANOUT):
        self.path = path.rstrip("/")
        self.store = TieredBatches(f"{self.path}/live", LEDGER_SCHEMA, _merge_ledger, fanout)

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body."""
        good = good_events(batch) if "_bad" in batch.columns else batch
        sums = good.groupBy("category").agg(F.sum("amount").alias("total"),
                                            F.count(F.lit(1)).alias("n"))
        out = _ledger_rows(sums, SUM, category=F.col("category"), total=F.col("total"),
                           n=F.col("n"), batches=F.lit(1).cast("long"))
        if "_bad" in batch.columns:
            out = out.unionByName(_ledger_rows(bad_events(batch), BAD, reason=F.col("reason"),
                                               data=F.col("data")))
        self.store.write(out, batch_id)

    def start(self, events: DataFrame, checkpoint: str, *, trigger: str | None = "availableNow",
              name: str | None = None) -> StreamingQuery:
        w = (events.writeStream.option("checkpointLocation", checkpoint)
             .foreachBatch(self.write_batch))
        if name:
            w = w.queryName(name)
        return _trigger(w, trigger).start()

    def entries(self, spark: SparkSession) -> DataFrame:
        return self.store.rows(spark)

    def quarantine(self, spark: SparkSession) -> DataFrame:
        return (self.entries(spark).where(F.col("kind") == BAD)
                .select("data", "reason", "batch_id"))

    def view(self, spark: SparkSession) -> DataFrame:
        return (self.entries(spark).where(F.col("kind").isin(SUM, FOLDED)).groupBy("category")
                .agg(F.sum("total").alias("running_total"),
                     F.sum("n").alias("txn_count"),
                     F.sum("batches").alias("batch_count")))

    def batch_summary(self, spark: SparkSession) -> DataFrame:
        """Per micro-batch: records processed and distinct categories seen
        (what the original consumer printed per call)."""
        return _batches(self.entries(spark)).select(
            "batch_id", F.col("n").alias("records"), F.col("batches").alias("categories"))

    def compact(self, spark: SparkSession) -> int:
        """Fold what fills a level; returns the number of merges."""
        return self.store.fold(spark)

    def vacuum(self, spark: SparkSession) -> int:
        return self.store.vacuum(spark)
