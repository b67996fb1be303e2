"""Registered queries over the storage side: publishing a set of tables at
once, catalog tables, folded streams, the fail-fast suite. Each reads the
driver's tables whole and has its DuckDB SQL in ``catalog``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake import compat
from ledgerlake.operators import cleaning, dims, sequence
from ledgerlake.operators.quality import DataQualityError
from ledgerlake.plans.incremental import IncrementalFact
from ledgerlake.schemas import GLOSSARY
from ledgerlake.session import scratch_path, staged
from ledgerlake.sinks import writers
from ledgerlake.sinks.versions import Snapshot, VersionedWriter
from ledgerlake.sources import curated, tables
from ledgerlake.streaming import parse, totals, windows

# Orders and line items before this day are the first load.
FIRST_LOAD = "1996-01-01"


class _Interrupted(RuntimeError):
    """Stands for whatever kills a publication between two tables."""


def star_tables(spark: SparkSession, sf_dir: str, before: str | None = None
                ) -> dict[str, DataFrame]:
    """The five curated tables; with ``before``, of what had happened then."""
    txn, acc = tables.transactions(spark, sf_dir), tables.accounts(spark, sf_dir)
    cus, dep, loan = (f(spark, sf_dir) for f in (tables.customers, tables.deposits, tables.loans))
    if before:
        day = F.lit(before).cast("date")
        txn, acc = txn.where(F.col("txn_ts") < day), acc.where(F.col("opened_date") < day)
        cus, dep = cus.where(F.col("onboarded_date") < day), dep.where(F.col("value_date") < day)
        loan = loan.where(F.col("origination_date") < day)
    return {"dim_customer": dims.build_dim_customer(cus), "dim_account": dims.build_dim_account(acc),
            "fact_transaction": sequence.build_fact_transaction(cleaning.clean_transactions(txn)),
            "fact_deposit": dims.build_fact_deposit(dep), "dim_loan": dims.build_dim_loan(loan)}


def _counts(snapshot: Snapshot, step: str) -> DataFrame:
    """Rows of every table of a set, and a key's least and largest value."""
    keys = {"dim_customer": "customer_id", "dim_account": "account_id",
            "fact_transaction": "account_id", "fact_deposit": "deposit_id", "dim_loan": "loan_id"}
    return reduce(DataFrame.unionByName, [
        snapshot.read(t).agg(F.count(F.lit(1)).alias("row_count"), F.min(k).alias("least_key"),
                             F.max(k).alias("largest_key"))
        .select(F.lit(step).alias("step"), F.lit(t).alias("table_name"), "row_count",
                "least_key", "largest_key")
        for t, k in keys.items()])


def q_atomic_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish what had happened before FIRST_LOAD; then the whole, which
    dies between two table writes: readers still see the old set whole; then
    the whole again, which switches; then back to the first set."""
    root = scratch_path(spark, "published")
    writer = VersionedWriter(root)
    with writer.publish(spark) as pub:
        for name, df in star_tables(spark, sf_dir, FIRST_LOAD).items():
            pub.write(df, name)
    steps = [_counts(Snapshot.latest(spark, root), "first")]
    later = star_tables(spark, sf_dir)
    try:
        with writer.publish(spark) as pub:
            for i, (name, df) in enumerate(later.items()):
                if i == 2:
                    raise _Interrupted
                pub.write(df, name)
    except _Interrupted:
        steps.append(_counts(Snapshot.latest(spark, root), "interrupted"))
    with writer.publish(spark) as pub:
        for name, df in later.items():
            pub.write(df, name)
    steps.append(_counts(Snapshot.latest(spark, root), "second"))
    writer.rollback(spark, 1)
    steps.append(_counts(Snapshot.latest(spark, root), "rolled back"))
    return reduce(DataFrame.unionByName, steps)


def q_publish_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per table of two publications, as counted on the way and
    kept in their manifests; no table is read again."""
    writer = VersionedWriter(scratch_path(spark, "audited"))
    rows = []
    for before in (FIRST_LOAD, None):
        with writer.publish(spark) as pub:
            for name, df in star_tables(spark, sf_dir, before).items():
                pub.write(df, name)
        snapshot = Snapshot.latest(spark, writer.root)
        rows += [(snapshot.version, name, e["rows"]) for name, e in snapshot.tables.items()]
    return spark.createDataFrame(rows, "version bigint, table_name string, written_rows bigint")


def q_incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact from three loads: late rows, copies that win and copies that
    lose, in other months than the rows they repeat. Equals one load of all
    rows."""
    fact = IncrementalFact(scratch_path(spark, "incremental"))
    for part in tables.more_transactions(spark, sf_dir):
        fact.load(spark, part)
        fact.tidy(spark)
    return fact.read(spark)


# ------------------------------------------------------------ catalog tables

MONTH = "txn_month"


def _in_database(spark: SparkSession, run: Callable[[str], DataFrame]) -> DataFrame:
    """Run with a database of its own; stage the result and drop it."""
    database = f"ledgerlake_{uuid.uuid4().hex[:12]}"
    writers.CatalogWriter(database).ensure_database(spark)
    try:
        return staged(run(database), "catalog-result")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def load_monthly(spark: SparkSession, fact: DataFrame, table: str, location: str) -> DataFrame:
    """The fact as a catalog table partitioned by month, files sorted by
    day, loaded in two steps: what lies before SLICE_FROM's last month, then
    that month again with all that follows. Returns the table."""
    fact = fact.withColumn(MONTH, F.date_format("txn_date", "yyyy-MM"))
    writers.create_partitioned(spark, table, writers.with_comments(
        fact, GLOSSARY["fact_transaction"]).schema, location, MONTH)
    writers.replace_partitions(fact.where(F.col("txn_date") < "1998-02-10"), table, MONTH,
                               "txn_date", "account_id")
    writers.replace_partitions(fact.where(F.col(MONTH) >= "1998-02"), table, MONTH,
                               "txn_date", "account_id")
    return spark.table(table)


def q_catalog_date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter of ``curated_date_slice`` from a catalog table: only the
    months of the slice are listed, and days inside them are filtered by row
    group."""
    fact = star_tables(spark, sf_dir)["fact_transaction"]

    def run(database: str) -> DataFrame:
        table = load_monthly(spark, fact, f"{database}.fact_transaction",
                             scratch_path(spark, "monthly"))
        return curated.month_slice(table, "1998-01-01", "1998-03-31", MONTH).drop(MONTH)
    return _in_database(spark, run)


def q_registered_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files written by path, registered as a catalog table; later files are
    registered by their new months alone. Totals per month, and by which of
    the two registrations the month came in."""
    fact = cleaning.clean_transactions(tables.transactions(spark, sf_dir)).withColumn(
        MONTH, F.date_format("txn_date", "yyyy-MM"))
    writer = writers.ParquetWriter(scratch_path(spark, "by-path"), dynamic=True)
    location = writer.path("fact_transaction")

    def run(database: str) -> DataFrame:
        table = f"{database}.fact_transaction"
        writers.create_partitioned(spark, table, fact.schema, location, MONTH)
        added = []
        for number, part in enumerate((F.col(MONTH) < FIRST_LOAD[:7], F.col(MONTH) >= FIRST_LOAD[:7])):
            writer.write(fact.where(part), "fact_transaction", MONTH)
            names = writers.register_new_partitions(spark, table, location, MONTH)
            added += [(n.partition("=")[2], number + 1) for n in names]
        loads = spark.createDataFrame(added, f"{MONTH} string, registration int")
        return (spark.table(table).groupBy(MONTH).agg(
            F.count(F.lit(1)).alias("txn_count"), F.round(F.sum("amount"), 2).alias("total_amount"))
            .join(loads, MONTH, "left"))
    return _in_database(spark, run)


CATALOG_PARTITIONS = {"dim_loan": "status"}


def q_catalog_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Create a database, create-or-replace the curated tables in it twice
    (the second write replaces the first), and read columns, comments,
    partition columns and row counts from the catalog."""
    star = star_tables(spark, sf_dir)

    def run(database: str) -> DataFrame:
        writer = writers.CatalogWriter(database)
        described, counts = [], []
        for name, df in star.items():
            writer.write(df.limit(0), name)
            writer.write(df, name, CATALOG_PARTITIONS.get(name))
            for c in spark.catalog.listColumns(writer.name(name)):
                described.append((name, c.name, c.description, c.isPartition))
            counts.append(writer.read(spark, name).agg(F.count(F.lit(1)).alias("row_count"))
                          .select(F.lit(name).alias("table_name"), "row_count"))
        columns = spark.createDataFrame(
            described, "table_name string, column_name string, comment string, "
                       "is_partition boolean")
        return columns.join(reduce(DataFrame.unionByName, counts), "table_name")
    return _in_database(spark, run)


# --------------------------------------------------------- folded streams

def _replayed(spark: SparkSession, store, batch_id: int) -> None:
    """A batch written again, as a restarted stream does."""
    again = staged(spark.read.parquet(f"{store.path}/batch_id={batch_id}"), "replayed")
    store.write(again, batch_id)


def q_folded_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ledger over the events in micro-batches of a week, folded and
    vacuumed twice midway; a folded batch and the newest one are replayed.
    Totals, and whether the reader's folders are as few as they should be."""
    from ledgerlake.plans.catalog import stage_weekly_envelopes
    path = stage_weekly_envelopes(spark, sf_dir)
    ledger = totals.CategoryLedger(scratch_path(spark, "ledger"), fanout=3)
    checkpoint = scratch_path(spark, "ledger-ckpt")
    decoded = parse.decode_events(parse.read_envelopes(spark, path, max_files_per_trigger=1))
    seen = 0

    def batch(df: DataFrame, batch_id: int) -> None:
        nonlocal seen
        ledger.write_batch(df, batch_id)
        seen += 1
        if seen in (FOLD_AT, 2 * FOLD_AT):
            ledger.compact(spark)
            if seen == FOLD_AT:
                _replayed(spark, ledger.store, 1)  # in a run already: not read again
            ledger.vacuum(spark)
    (decoded.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
     .trigger(availableNow=True).start().awaitTermination())
    _replayed(spark, ledger.store, ledger.store.batch_ids(spark)[-1])
    ledger.compact(spark)
    levels = 1
    while ledger.store.fanout ** levels <= seen:
        levels += 1
    few = ledger.store.folders(spark) <= (ledger.store.fanout - 1) * levels + 1
    return ledger.view(spark).select(
        "category", F.round("running_total", 2).alias("running_total"), "txn_count",
        "batch_count", F.lit(few).alias("few_folders"))


# Batches after which ``folded_ledger`` folds for the first time.
FOLD_AT = 7


def q_folded_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running totals and daily windows of the same stream, both folded
    between two runs of it: the state of the folded stores per category, and
    the sums over the windows."""
    from ledgerlake.plans.catalog import events_stream
    out, days = scratch_path(spark, "totals"), scratch_path(spark, "daily")
    stores = totals.totals_store(out, fanout=2), windows.windows_store(days, fanout=2)
    events = events_stream(spark, sf_dir, batches=6)
    totals.start_running_totals(events, out, scratch_path(spark, "ckpt")).awaitTermination()
    windows.start_windowed_totals(events, days, scratch_path(spark, "ckpt"),
                                  delay="3650 days").awaitTermination()
    for store in stores:
        store.fold(spark)
        store.vacuum(spark)
    by_day = windows.latest_windows(spark, days).groupBy("category").agg(
        F.round(F.sum("total"), 2).alias("window_total"), F.sum("txn_count").alias("window_count"),
        F.countDistinct("window_start").alias("days"))
    return totals.latest_totals(spark, out).select(
        "category", F.round("running_total", 2).alias("running_total"), "txn_count").join(
        by_day, "category")


# ------------------------------------------------------------- fail fast

def q_dq_fail_fast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fail-fast suite on four stars: as built, with dirty transactions,
    without the accounts opened before FIRST_LOAD, and with repeated
    customers; the error each raises, if any."""
    star = {n: staged(df, n) for n, df in star_tables(spark, sf_dir).items()
            if n != "fact_deposit"}
    star["dim_loan"] = star["dim_loan"].where("interest_rate <= 40")
    variants = {
        "clean": {},
        "dirty": {"fact_transaction": staged(cleaning.clean_transactions(
            tables.dirty_transactions(spark, sf_dir)), "dirty")},
        "accounts missing": {"dim_account": star["dim_account"].where(
            F.col("opened_date") >= F.lit(FIRST_LOAD).cast("date"))},
        "customers repeated": {"dim_customer": staged(tables.customers(spark, sf_dir),
                                                      "repeated")},
    }
    rows = []
    for name, changed in variants.items():
        try:
            compat.run_all_checks(**{**star, **changed})
            rows.append((name, None))
        except DataQualityError as e:
            rows.append((name, str(e)))
    return spark.createDataFrame(rows, "data_set string, error string")
