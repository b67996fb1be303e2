"""Registered queries over the driver's tables, each with its DuckDB oracle.

Every query reads the given tables (or data Spark derives from them), over
whole tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.columns import encode_envelope
from ledgerlake.operators import cleaning, dims, quality, sequence, star
from ledgerlake.operators.quality import ForeignKey, TableRules, ValueRange
from ledgerlake.plans import lakehouse
from ledgerlake.plans.etl import AUDIT_RULES, audit_transactions, run_etl
from ledgerlake.schemas import GLOSSARY
from ledgerlake.session import scratch_path
from ledgerlake.sinks.versions import Snapshot, VersionedWriter
from ledgerlake.sinks.writers import ParquetWriter
from ledgerlake.sources import curated, tables
from ledgerlake.sources.raw import load_raw
from ledgerlake.streaming import parse, totals, windows

Query = Callable[[SparkSession, str], DataFrame]


# ---------------------------------------------------------------- ETL core

def q_clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_transactions(tables.transactions(spark, sf_dir))


def q_fact_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.build_fact_transaction(q_clean_transactions(spark, sf_dir))


def q_dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_dim_customer(tables.customers(spark, sf_dir))


def q_dim_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_dim_account(tables.accounts(spark, sf_dir))


def q_fact_deposit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_fact_deposit(tables.deposits(spark, sf_dir))


def q_dim_loan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.build_dim_loan(tables.loans(spark, sf_dir))


# ---------------------------------------------------------- quality gate

# Rule sets over the driver tables. The raw transactions repeat txn_id;
# several foreign keys have real gaps (customers without events, orders
# without line items, documents without labels); discounts exceed 5 %.
NULL_RULES = (
    TableRules("customer", not_null=("c_custkey", "c_name", "c_nationkey")),
    TableRules("orders", not_null=("o_orderkey", "o_custkey", "o_orderdate")),
    TableRules("lineitem", not_null=("l_orderkey", "l_linenumber", "l_extendedprice",
                                     "l_shipdate")),
    TableRules("events", not_null=("event_id", "user_id", "ts", "value")),
    TableRules("documents", not_null=("doc_id", "text")),
)
UNIQUE_RULES = (
    TableRules("transactions", unique=("txn_id",)),
    TableRules("customer", unique=("c_custkey",)),
    TableRules("orders", unique=("o_orderkey", "o_custkey")),
    TableRules("events", unique=("event_id",)),
    TableRules("documents", unique=("doc_id",)),
    TableRules("labels", unique=("doc_id",)),
)
FK_RULES = (
    TableRules("orders", foreign_keys=(ForeignKey("o_custkey", "customer", "c_custkey"),)),
    TableRules("lineitem", foreign_keys=(ForeignKey("l_orderkey", "orders", "o_orderkey"),
                                         ForeignKey("l_partkey", "part", "p_partkey"),
                                         ForeignKey("l_suppkey", "supplier", "s_suppkey"))),
    TableRules("customer", foreign_keys=(ForeignKey("c_nationkey", "nation", "n_nationkey"),
                                         ForeignKey("c_custkey", "events", "user_id"))),
    TableRules("nation", foreign_keys=(ForeignKey("n_regionkey", "region", "r_regionkey"),)),
    TableRules("events", foreign_keys=(ForeignKey("user_id", "customer", "c_custkey"),)),
    TableRules("orders", foreign_keys=(ForeignKey("o_orderkey", "lineitem", "l_orderkey"),)),
    TableRules("documents", foreign_keys=(ForeignKey("doc_id", "labels", "doc_id"),)),
    TableRules("labels", foreign_keys=(ForeignKey("doc_id", "documents", "doc_id"),)),
)
RANGE_RULES = (
    TableRules("lineitem", ranges=(ValueRange("l_discount", 0, 0.05),
                                   ValueRange("l_tax", 0, 0.08))),
    TableRules("customer", ranges=(ValueRange("c_acctbal", 0, 10000),)),
    TableRules("events", ranges=(ValueRange("value", 0, 100),)),
)


# On the raw dirty rows.
DIRTY_RULES = (
    TableRules("transactions", not_null=("txn_id", "account_id", "amount", "txn_ts"),
               unique=("txn_id",),
               foreign_keys=(ForeignKey("account_id", "orders", "o_orderkey"),)),
)


def _driver_tables(spark: SparkSession, sf_dir: str, suite) -> dict[str, DataFrame]:
    names = {r.table for r in suite} | {fk.parent for r in suite for fk in r.foreign_keys}
    out = {}
    for n in names:
        out[n] = (tables.transactions(spark, sf_dir) if n == "transactions"
                  else tables.table(spark, sf_dir, n))
    return out


def _rules_query(suite) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return quality.run_rules(_driver_tables(spark, sf_dir, suite), suite)
    return q


FULL_SUITE = quality.STAR_SCHEMA_RULES + quality.STAR_SCHEMA_ADDITIONS


def q_dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole star-schema suite with the additions, every table of it
    built from the driver tables."""
    # The rules read no sequence column, so the fact's rows (cleaned,
    # deduplicated) are checked without building the sequence.
    star = {"dim_customer": q_dim_customer(spark, sf_dir),
            "dim_account": q_dim_account(spark, sf_dir),
            "fact_transaction": q_clean_transactions(spark, sf_dir),
            "fact_deposit": q_fact_deposit(spark, sf_dir),
            "dim_loan": q_dim_loan(spark, sf_dir)}
    return quality.run_rules(star, FULL_SUITE)


# ------------------------------------------------------ quarantine / report

def q_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quarantine_transactions(tables.transactions(spark, sf_dir),
                                            tables.accounts(spark, sf_dir))


def q_clean_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_summary(tables.transactions(spark, sf_dir),
                                  tables.accounts(spark, sf_dir))


def q_dq_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dirty-data audit's rule report (cleaned, not orphan-filtered
    transactions against the account dimension)."""
    return audit_transactions(tables.transactions(spark, sf_dir), tables.accounts(spark, sf_dir))


def q_dirty_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_time(cleaning.clean_transactions(tables.dirty_transactions(spark, sf_dir)))


def q_dirty_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequenced fact of the dirty rows (unknown accounts stay)."""
    return _plain_time(sequence.build_fact_transaction(
        cleaning.clean_transactions(tables.dirty_transactions(spark, sf_dir))))


def q_dirty_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.quarantine_transactions(tables.dirty_transactions(spark, sf_dir),
                                            tables.accounts(spark, sf_dir))


def q_dirty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_summary(tables.dirty_transactions(spark, sf_dir),
                                  tables.accounts(spark, sf_dir))


def q_dirty_removal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.removal_report(q_dirty_summary(spark, sf_dir))


def q_dirty_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the dirty rows: the referential rule fails."""
    return audit_transactions(tables.dirty_transactions(spark, sf_dir),
                              tables.accounts(spark, sf_dir))


def q_dirty_raw_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null, unique and referential rules on the raw dirty rows: all fail."""
    return quality.run_rules({"transactions": tables.dirty_transactions(spark, sf_dir),
                              "orders": tables.table(spark, sf_dir, "orders")}, DIRTY_RULES)


# Rows of a file of JSON lines, so that compressed files are read in parallel.
JSON_ROWS = 500_000


def q_dirty_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gated ETL job over JSON lines of the dirty rows: read as text,
    built, gated. The gate fails, so nothing but the report is published;
    returns the report."""
    raw = scratch_path(spark, "raw")
    entities = {"customers": tables.customers(spark, sf_dir),
                "accounts": tables.accounts(spark, sf_dir),
                "transactions": tables.dirty_transactions(spark, sf_dir),
                "deposits": tables.deposits(spark, sf_dir),
                "loans": tables.loans(spark, sf_dir)}
    for name, df in entities.items():
        # Compressed text cannot be split: many files, one task each.
        (df.write.option("compression", "gzip").option("maxRecordsPerFile", JSON_ROWS)
         .json(f"{raw}/{name}/{name}.jsonl"))
    result = run_etl(spark, load_raw(spark, raw), VersionedWriter(scratch_path(spark, "etl")),
                     rules=FULL_SUITE)
    if result.passed or "fact_transaction" in result.published:
        raise RuntimeError("the gate let dirty rows pass")
    return result.report


def _plain_time(df: DataFrame) -> DataFrame:
    # Text is read as an instant in UTC; the comparison is on naive times.
    return df.withColumns({"txn_ts": F.to_timestamp_ntz(F.date_format(
        "txn_ts", "yyyy-MM-dd HH:mm:ss"))})


def q_etl_gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole gated ETL job over the driver tables: write the star (the
    fact partitioned by txn_date), gate what was written, switch the set;
    returns the gate's report with the row count of each published table,
    read back."""
    raw = {"customers": tables.customers(spark, sf_dir),
           "accounts": tables.accounts(spark, sf_dir),
           "transactions": tables.transactions(spark, sf_dir),
           "deposits": tables.deposits(spark, sf_dir),
           "loans": tables.loans(spark, sf_dir)}
    writer = VersionedWriter(scratch_path(spark, "etl"))
    result = run_etl(spark, raw, writer, enforce=False)
    published = Snapshot.latest(spark, writer.root)
    counts = [published.read(name).agg(F.count(F.lit(1)).alias("published_rows"))
              .select(F.lit(name).alias("table_name"), "published_rows") for name in result.tables]
    return result.report.join(reduce(DataFrame.unionByName, counts), "table_name")


def q_removal_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.removal_report(q_clean_summary(spark, sf_dir))


def q_orphan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label row (anti-join, NULL keys count)."""
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    labels = tables.table(spark, sf_dir, "labels")
    return cleaning.orphans_of(docs, labels, "doc_id", parent_key="doc_id")


# ------------------------------------------------ curated layer / star use

SLICE = ("1998-01-01", "1998-03-31")


def q_curated_date_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publish the fact partitioned by txn_date, read one quarter back
    (PartitionFilters prune the other dates)."""
    fact = q_fact_transaction(spark, sf_dir)
    writer = ParquetWriter(scratch_path(spark, "curated"))
    path = writer.write(fact, "fact_transaction", "txn_date")
    return curated.read_date_slice(spark, path, *SLICE, schema=fact.schema)


def q_star_spend_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    # fact rows without the (unused) sequence column
    return star.spend_by_segment(q_clean_transactions(spark, sf_dir),
                                 q_dim_account(spark, sf_dir), q_dim_customer(spark, sf_dir))


def q_deposits_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.deposits_per_customer(q_fact_deposit(spark, sf_dir), q_dim_account(spark, sf_dir))


def q_loan_book_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.loan_book_by_status(q_dim_loan(spark, sf_dir))


# -------------------------------------------------------------- streaming

def events_stream(spark: SparkSession, sf_dir: str, batches: int = 1) -> DataFrame:
    """The events as a stream: their table is copied to the shared folder
    as ``batches`` groups of files in time order, one group per
    micro-batch. Works for a table of one file and of many."""
    ev = tables.table(spark, sf_dir, "events")
    path = scratch_path(spark, "events")
    (ev.repartitionByRange(batches, "ts") if batches > 1 else ev).write.parquet(path)
    src = spark.readStream.schema(ev.schema)
    if batches > 1:
        src = src.option("maxFilesPerTrigger", "1")
    return tables.stream_events(src.parquet(path))


def _cents(df: DataFrame, *cols: str) -> DataFrame:
    # Float sums depend on addition order; compare at cent precision.
    return df.withColumns({c: F.round(c, 2) for c in cols})


def q_category_totals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = tables.stream_events(tables.table(spark, sf_dir, "events"))
    return _cents(totals.category_totals(ev), "running_total")


def q_category_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = scratch_path(spark, "totals"), scratch_path(spark, "totals-ckpt")
    events = events_stream(spark, sf_dir, batches=4)
    totals.start_running_totals(events, out, ck).awaitTermination()
    return _cents(totals.latest_totals(spark, out), "running_total")


def stage_weekly_envelopes(spark: SparkSession, sf_dir: str) -> str:
    """Events as base64 envelopes, one file per ISO week (each file is one
    micro-batch below). Stand-in for the arriving stream."""
    ev = tables.stream_events(tables.table(spark, sf_dir, "events"))
    env = ev.select(F.date_trunc("week", "txn_ts").cast("date").alias("week"),
                    encode_envelope(*parse.EVENT_COLUMNS).alias("data"))
    path = scratch_path(spark, "envelopes")
    env.repartition("week").write.partitionBy("week").parquet(path)
    return path


def q_category_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = stage_weekly_envelopes(spark, sf_dir)
    decoded = parse.decode_events(parse.read_envelopes(spark, staged, max_files_per_trigger=1))
    ledger = totals.CategoryLedger(scratch_path(spark, "ledger"))
    ledger.start(decoded, scratch_path(spark, "ledger-ckpt")).awaitTermination()
    return _cents(ledger.view(spark), "running_total")


def _append_stream(spark: SparkSession, df: DataFrame, name: str) -> str:
    """Run a stateless (or watermarked) stream to a Parquet sink (append,
    exactly-once through the sink's commit log); return the sink path."""
    out, ck = scratch_path(spark, name), scratch_path(spark, f"{name}-ckpt")
    (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())
    return out


def q_stream_dedupe_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream dedupe by txn_id within the watermark's delay, then totals of
    the surviving events. Every third event arrives again in later files,
    which are a micro-batch of their own, so repeats are found by the state
    kept between batches."""
    events = tables.table(spark, sf_dir, "events")
    path, files = scratch_path(spark, "events"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    for part in (events, events.where("event_id % 3 = 0")):
        # The stream reads files in the order of their times.
        part.repartition(files).write.mode("append").parquet(path)
        time.sleep(0.05)
    src = (spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(files))
           .parquet(path))
    # The later files bring events as old as the oldest.
    deduped = windows.dedupe_within_watermark(tables.stream_events(src), delay="3650 days")
    out = _append_stream(spark, deduped, "dedupe")
    return _cents(totals.category_totals(spark.read.parquet(out)), "running_total")


def q_stream_known_user_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream-static semi-join: events of known customers only (here those
    with money on their account), then totals."""
    customers = tables.table(spark, sf_dir, "customer").where("c_acctbal > 0")
    known = cleaning.drop_orphans(events_stream(spark, sf_dir), customers, "account_id",
                                  parent_key="c_custkey")
    out = _append_stream(spark, known, "known-users")
    return _cents(totals.category_totals(spark.read.parquet(out)), "running_total")


def q_ledger_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and distinct categories per micro-batch (one batch per
    week of events)."""
    staged = stage_weekly_envelopes(spark, sf_dir)
    decoded = parse.decode_events(parse.read_envelopes(spark, staged, max_files_per_trigger=1))
    ledger = totals.CategoryLedger(scratch_path(spark, "ledger"))
    ledger.start(decoded, scratch_path(spark, "ledger-ckpt")).awaitTermination()
    return ledger.batch_summary(spark).drop("batch_id")


def q_daily_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.daily_spend(q_clean_transactions(spark, sf_dir))


def q_daily_totals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, ck = scratch_path(spark, "daily"), scratch_path(spark, "daily-ckpt")
    events = events_stream(spark, sf_dir, batches=4)
    # The files may be read in any order: nothing counts as too late.
    windows.start_windowed_totals(events, out, ck, delay="3650 days").awaitTermination()
    df = windows.latest_windows(spark, out)
    return _cents(df, "total").withColumns({
        "window_start": F.col("window_start").cast("timestamp_ntz"),
        "window_end": F.col("window_end").cast("timestamp_ntz")})


# ------------------------------------------------------------ SQL oracles

def _sql_table(name: str, sources=None) -> str:
    if sources and name in sources:
        return sources[name]
    return f"({_TXN})" if name == "transactions" else name


def _sql_rule(table, rule, column, detail, violations, from_sql) -> str:
    detail_sql = "CAST(NULL AS VARCHAR)" if detail is None else f"'{detail}'"
    return (f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{column}' AS column_name, "
            f"{detail_sql} AS detail, {violations} AS violations, count(*) AS total "
            f"FROM {from_sql} x")


def _sql_rules(suite, sources=None) -> str:
    parts = []
    for r in suite:
        t = _sql_table(r.table, sources)
        for c in r.not_null:
            parts.append(_sql_rule(r.table, "not_null", c, None,
                                   f"count(*) FILTER (WHERE {c} IS NULL)", t))
        for c in r.unique:
            parts.append(_sql_rule(
                r.table, "unique", c, None,
                f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT {c} FROM {t} y) d)", t))
        for g in r.ranges:
            parts.append(_sql_rule(
                r.table, "range", g.column, g.detail,
                f"count(*) FILTER (WHERE {g.column} < {g.lo} OR {g.column} > {g.hi})", t))
        for fk in r.foreign_keys:
            if sources and fk.parent not in sources:
                continue
            p = _sql_table(fk.parent, sources)
            parts.append(_sql_rule(
                r.table, "referential", fk.column, f"{fk.parent}.{fk.parent_column}",
                f"count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {p} p "
                f"WHERE p.{fk.parent_column} = x.{fk.column}))", t))
    body = "\n  UNION ALL ".join(parts)
    return (f"SELECT table_name, rule, column_name, detail, violations, total, "
            f"violations = 0 AS passed FROM (\n  {body}) r")


_TXN = """
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS txn_id,
         l_orderkey AS account_id, l_extendedprice AS amount,
         l_returnflag AS category, l_shipdate AS txn_ts
  FROM lineitem"""

# The damage of ``tables.dirty_transactions``, typed as cleaning types it.
DIRTY_SQL = """
  SELECT CASE WHEN l_orderkey % 50 = 7 AND l_linenumber = 1 THEN NULL
              WHEN l_orderkey % 40 = 3 THEN CAST(l_orderkey AS VARCHAR) || '-1'
              ELSE CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
              END AS txn_id,
         CASE WHEN l_orderkey % 60 = 11 AND l_linenumber = 2 THEN NULL
              WHEN l_orderkey % 100 = 13 THEN -l_orderkey ELSE l_orderkey END AS account_id,
         CASE WHEN l_orderkey % 70 = 5 AND l_linenumber = 1 THEN NULL
              WHEN l_orderkey % 70 = 6 AND l_linenumber = 1 THEN 'NaN'
              WHEN l_orderkey % 70 = 8 AND l_linenumber = 1 THEN 'n/a'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS VARCHAR) END AS amount,
         l_returnflag AS category,
         CASE WHEN l_orderkey % 80 = 9 AND l_linenumber = 1 THEN NULL
              WHEN l_orderkey % 80 = 10 AND l_linenumber = 1 THEN 'soon'
              ELSE strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') END AS txn_ts
  FROM lineitem"""

_DIRTY_TAGGED = f"""
  SELECT *, TRY_CAST(amount AS DOUBLE) AS amount_d, TRY_CAST(txn_ts AS TIMESTAMP) AS ts,
         CASE WHEN txn_id IS NULL OR account_id IS NULL OR amount IS NULL OR txn_ts IS NULL
                   THEN 'null_key'
              WHEN TRY_CAST(amount AS DOUBLE) IS NULL OR isnan(TRY_CAST(amount AS DOUBLE))
                   THEN 'bad_amount'
              WHEN TRY_CAST(txn_ts AS TIMESTAMP) IS NULL THEN 'bad_txn_ts' END AS row_reason
  FROM ({DIRTY_SQL}) t"""

_DIRTY_OUTCOME = f"""
  SELECT *, CASE WHEN row_reason IS NOT NULL THEN row_reason WHEN rn > 1 THEN 'duplicate'
                 WHEN NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = n.account_id)
                      THEN 'orphan' ELSE 'kept' END AS outcome
  FROM (SELECT t.*, row_number() OVER (PARTITION BY txn_id, row_reason IS NULL
               ORDER BY ts, amount_d, category NULLS FIRST, account_id) AS rn
        FROM ({_DIRTY_TAGGED}) t) n"""

_DIRTY_CLEAN = f"""
  SELECT txn_id, account_id, amount_d AS amount, category, ts AS txn_ts,
         CAST(ts AS DATE) AS txn_date
  FROM ({_DIRTY_OUTCOME}) o WHERE outcome IN ('kept', 'orphan')"""

_VALID = f"""
  SELECT * FROM ({_TXN}) t
  WHERE txn_id IS NOT NULL AND account_id IS NOT NULL AND amount IS NOT NULL
    AND NOT isnan(amount) AND txn_ts IS NOT NULL"""

_CLEAN = f"""
  SELECT txn_id, account_id, amount, category, txn_ts, CAST(txn_ts AS DATE) AS txn_date
  FROM ({_VALID}) v
  QUALIFY row_number() OVER (PARTITION BY txn_id
          ORDER BY txn_ts NULLS FIRST, amount NULLS FIRST, category NULLS FIRST,
                   account_id NULLS FIRST) = 1"""

_FACT = f"""
  SELECT *, CAST(row_number() OVER (PARTITION BY account_id
                 ORDER BY txn_ts NULLS FIRST, txn_id NULLS FIRST) AS INTEGER)
            AS txn_seq_in_account
  FROM ({_CLEAN}) c"""

_CUSTOMER_SNAPSHOTS = """
  SELECT c.c_custkey AS customer_id, c.c_name AS full_name, c.c_mktsegment AS segment,
         o.o_orderdate AS onboarded_date, n.n_name AS country
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN (SELECT o_custkey, o_orderdate FROM orders) o ON c.c_custkey = o.o_custkey"""

_DIM_CUSTOMER = f"""
  SELECT customer_id, full_name, segment, CAST(onboarded_date AS DATE) AS onboarded_date, country
  FROM ({_CUSTOMER_SNAPSHOTS}) s
  QUALIFY row_number() OVER (PARTITION BY customer_id
          ORDER BY full_name NULLS FIRST, segment NULLS FIRST,
                   onboarded_date NULLS FIRST, country NULLS FIRST) = 1"""

_DIM_ACCOUNT = """
  SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_orderpriority AS account_type,
         o_totalprice AS balance, CAST(o_orderdate AS DATE) AS opened_date
  FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_orderkey
          ORDER BY o_custkey NULLS FIRST, o_orderpriority NULLS FIRST,
                   o_totalprice NULLS FIRST, o_orderdate NULLS FIRST) = 1"""


_NUMBERED = f"""
  SELECT t.*,
         CASE WHEN txn_id IS NULL OR account_id IS NULL OR amount IS NULL OR isnan(amount)
                   OR txn_ts IS NULL THEN 'null_key' END AS row_reason,
         row_number() OVER (PARTITION BY txn_id,
                                 (txn_id IS NULL OR account_id IS NULL OR amount IS NULL
                                  OR isnan(amount) OR txn_ts IS NULL)
                            ORDER BY txn_ts NULLS FIRST, amount NULLS FIRST,
                                     category NULLS FIRST, account_id NULLS FIRST) AS rn
  FROM ({_TXN}) t"""

_OUTCOME = f"""
  SELECT n.*,
         CASE WHEN row_reason IS NOT NULL THEN row_reason
              WHEN rn > 1 THEN 'duplicate'
              WHEN NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = n.account_id)
                   THEN 'orphan'
              ELSE 'kept' END AS outcome
  FROM ({_NUMBERED}) n"""

_QUARANTINE = f"""
  SELECT txn_id, account_id, amount, category, txn_ts, outcome AS reason
  FROM ({_OUTCOME}) x WHERE outcome <> 'kept'"""

_CLEAN_SUMMARY = f"""
  SELECT outcome, count(*) AS row_count FROM ({_OUTCOME}) x GROUP BY outcome"""

def _sql_audit() -> str:
    return _sql_rules(AUDIT_RULES, {"fact_transaction": f"({_CLEAN})",
                                    "dim_account": f"({_DIM_ACCOUNT})"})


def _removal_report(outcome: str) -> str:
    return f"""
  SELECT count(*) AS raw_rows,
         count(*) FILTER (WHERE outcome IN ('kept', 'orphan')) AS clean_rows,
         count(*) FILTER (WHERE outcome NOT IN ('kept', 'orphan')) AS removed_rows,
         count(*) FILTER (WHERE outcome = 'orphan') AS orphan_rows
  FROM ({outcome}) x"""


_ORPHAN_ROWS = """
  SELECT doc_id, lang, source, n_chars FROM documents d
  WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"""

_FACT_DEPOSIT = """
  SELECT o_orderkey AS deposit_id, o_orderkey AS account_id, o_totalprice AS amount,
         CAST(o_orderdate AS DATE) AS value_date FROM orders"""

_DIM_LOAN = """
  SELECT o_orderkey AS loan_id, o_custkey AS customer_id, o_totalprice AS principal,
         CASE WHEN o_orderkey % 97 = 0 THEN 99.5
              ELSE CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) END AS interest_rate,
         o_orderstatus AS status, CAST(o_orderdate AS DATE) AS origination_date FROM orders"""

_STAR_TABLES = {"dim_customer": f"({_DIM_CUSTOMER})", "dim_account": f"({_DIM_ACCOUNT})",
                "fact_transaction": f"({_FACT})", "fact_deposit": f"({_FACT_DEPOSIT})",
                "dim_loan": f"({_DIM_LOAN})"}
_DIRTY_STAR = {**_STAR_TABLES, "fact_transaction": f"({_DIRTY_CLEAN})"}

_PUBLISHED = "\n  UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS published_rows FROM {sql} p"
    for name, sql in _STAR_TABLES.items())
_GATE_REPORT = f"""
  SELECT r.*, p.published_rows
  FROM ({_sql_rules(quality.STAR_SCHEMA_RULES, _STAR_TABLES)}) r
  JOIN ({_PUBLISHED}) p ON r.table_name = p.table_name"""

_DIRTY_FACT = f"""
  SELECT *, CAST(row_number() OVER (PARTITION BY account_id ORDER BY txn_ts, txn_id) AS INTEGER)
            AS txn_seq_in_account
  FROM ({_DIRTY_CLEAN}) c"""


_CURATED_SLICE = f"""
  SELECT * FROM ({_FACT}) f WHERE txn_date BETWEEN DATE '{SLICE[0]}' AND DATE '{SLICE[1]}'"""

_STAR_SPEND = f"""
  SELECT c.segment, f.category, round(sum(f.amount), 2) AS total_amount,
         count(*) AS txn_count
  FROM ({_FACT}) f
  JOIN ({_DIM_ACCOUNT}) a ON f.account_id = a.account_id
  JOIN ({_DIM_CUSTOMER}) c ON a.customer_id = c.customer_id
  GROUP BY c.segment, f.category"""

_LEDGER_BATCHES = """
  SELECT count(*) AS records, count(DISTINCT event_type) AS categories
  FROM events GROUP BY date_trunc('week', ts)"""

_DEPOSITS_PER_CUSTOMER = f"""
  SELECT a.customer_id, count(*) AS deposit_count, round(sum(d.amount), 2) AS deposit_total
  FROM ({_FACT_DEPOSIT}) d JOIN ({_DIM_ACCOUNT}) a ON d.account_id = a.account_id
  GROUP BY a.customer_id"""

_LOAN_BOOK = f"""
  SELECT status, count(*) AS loan_count, round(sum(principal), 2) AS principal_total,
         round(avg(interest_rate), 4) AS avg_interest_rate
  FROM ({_DIM_LOAN}) l GROUP BY status"""

_DAILY_SPEND = f"""
  SELECT txn_date, category, round(sum(amount), 2) AS total_amount, count(*) AS txn_count
  FROM ({_FACT}) f GROUP BY txn_date, category"""

_CATEGORY_TOTALS = """
  SELECT event_type AS category, round(sum(value), 2) AS running_total,
         count(*) AS txn_count
  FROM events GROUP BY event_type"""

_CATEGORY_LEDGER = """
  SELECT event_type AS category, round(sum(value), 2) AS running_total,
         count(*) AS txn_count, count(DISTINCT date_trunc('week', ts)) AS batch_count
  FROM events GROUP BY event_type"""

_KNOWN_USER_TOTALS = """
  SELECT event_type AS category, round(sum(value), 2) AS running_total,
         count(*) AS txn_count
  FROM events e WHERE EXISTS (SELECT 1 FROM customer c
                            WHERE c.c_custkey = e.user_id AND c.c_acctbal > 0)
  GROUP BY event_type"""

_DEDUPE_TOTALS = """
  SELECT event_type AS category, round(sum(value), 2) AS running_total,
         count(*) AS txn_count
  FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1) e
  GROUP BY event_type"""

_DAILY_TOTALS = """
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('day', ts) AS TIMESTAMP) + INTERVAL 1 DAY AS window_end,
         event_type AS category, round(sum(value), 2) AS total, count(*) AS txn_count
  FROM events GROUP BY 1, 2, 3"""

# Tables of the star, of all rows and of those before the first load's end.
def _star_before(day: str | None) -> dict[str, str]:
    if day is None:
        return _STAR_TABLES
    out = {}
    for name, sql in _STAR_TABLES.items():
        for source, column in (("lineitem", "l_shipdate"), ("orders", "o_orderdate")):
            sql = sql.replace(f"FROM {source}", f"FROM (SELECT * FROM {source} "
                                                f"WHERE {column} < DATE '{day}') o")
        out[name] = sql
    # Customers without an earlier order are not there yet.
    out["dim_customer"] = out["dim_customer"].replace("LEFT JOIN (SELECT o_custkey",
                                                      "JOIN (SELECT o_custkey")
    return out


_KEYS = {"dim_customer": "customer_id", "dim_account": "account_id",
         "fact_transaction": "account_id", "fact_deposit": "deposit_id", "dim_loan": "loan_id"}
_ATOMIC_PUBLISH = "\n  UNION ALL ".join(
    f"SELECT '{step}' AS step, '{name}' AS table_name, count(*) AS row_count, "
    f"min({_KEYS[name]}) AS least_key, max({_KEYS[name]}) AS largest_key FROM {sql} t"
    for step, day in (("first", lakehouse.FIRST_LOAD), ("interrupted", lakehouse.FIRST_LOAD),
                      ("second", None), ("rolled back", lakehouse.FIRST_LOAD))
    for name, sql in _star_before(day).items())

_REGISTERED_MONTHS = f"""
  SELECT strftime(txn_date, '%Y-%m') AS txn_month, count(*) AS txn_count,
         round(sum(amount), 2) AS total_amount,
         CASE WHEN strftime(txn_date, '%Y-%m') < '{lakehouse.FIRST_LOAD[:7]}' THEN 1 ELSE 2 END
           AS registration
  FROM ({_CLEAN}) c GROUP BY 1, 4"""


def _catalog_glossary() -> str:
    columns = {"dim_customer": dims.DIM_CUSTOMER, "dim_account": dims.DIM_ACCOUNT,
               "fact_transaction": (*cleaning.TXN_COLUMNS, "txn_date", sequence.SEQ),
               "fact_deposit": dims.FACT_DEPOSIT, "dim_loan": dims.DIM_LOAN}
    values = ",\n  ".join(
        "('{}', '{}', {}, {})".format(
            t, c, f"'{GLOSSARY[t][c]}'" if c in GLOSSARY[t] else "NULL::VARCHAR",
            str(lakehouse.CATALOG_PARTITIONS.get(t) == c).lower())
        for t, names in columns.items() for c in names)
    counts = "\n  UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {sql} x"
                                   for t, sql in _STAR_TABLES.items())
    return f"""
  SELECT d.*, row_count
  FROM (VALUES {values}) d(table_name, column_name, comment, is_partition)
  JOIN ({counts}) n ON n.table_name = d.table_name"""


_FOLDED_LEDGER = f"SELECT *, true AS few_folders FROM ({_CATEGORY_LEDGER}) l"

_FOLDED_TOTALS = """
  SELECT event_type AS category, round(sum(value), 2) AS running_total, count(*) AS txn_count,
         round(sum(value), 2) AS window_total, count(*) AS window_count,
         count(DISTINCT date_trunc('day', ts)) AS days
  FROM events GROUP BY event_type"""

# The rows of ``tables.more_transactions``.
_MORE_TXN = f"""
  SELECT * FROM ({_TXN}) t
  UNION ALL SELECT txn_id, account_id, amount, category, txn_ts - INTERVAL 40 DAY
  FROM ({_TXN}) t WHERE account_id % 10 = 3 AND txn_id LIKE '%-1'
  UNION ALL SELECT txn_id, account_id, amount + 1, category, txn_ts
  FROM ({_TXN}) t WHERE account_id % 10 = 4"""

_PUBLISH_AUDIT = "\n  UNION ALL ".join(
    f"SELECT CAST({number} AS BIGINT) AS version, '{name}' AS table_name, count(*) AS written_rows "
    f"FROM {sql} t"
    for number, day in ((1, lakehouse.FIRST_LOAD), (2, None))
    for name, sql in _star_before(day).items())

_FAIL_FAST = f"""
  SELECT 'clean' AS data_set, CAST(NULL AS VARCHAR) AS error
  UNION ALL
  SELECT 'dirty', '[fact_transaction] ' || count(*)
         || ' rows in ''account_id'' have no matching ''dim_account.account_id'''
  FROM ({_DIRTY_CLEAN}) f WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = f.account_id)
  UNION ALL
  SELECT 'accounts missing', '[fact_transaction] ' || count(*)
         || ' rows in ''account_id'' have no matching ''dim_account.account_id'''
  FROM ({_CLEAN}) f WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = f.account_id
                                      AND o.o_orderdate >= DATE '{lakehouse.FIRST_LOAD}')
  UNION ALL
  SELECT 'customers repeated', '[dim_customer] column ''customer_id'' is not unique: ' || count(*)
         || ' rows vs ' || count(DISTINCT customer_id) || ' distinct values'
  FROM ({_CUSTOMER_SNAPSHOTS}) s"""

QUERIES: dict[str, Query] = {
    "fact_transaction": q_fact_transaction,
    "clean_transactions": q_clean_transactions,
    "dim_customer": q_dim_customer,
    "dim_account": q_dim_account,
    "dq_nulls": _rules_query(NULL_RULES),
    "dq_unique": _rules_query(UNIQUE_RULES),
    "dq_referential": _rules_query(FK_RULES),
    "dq_range": _rules_query(RANGE_RULES),
    "dq_report": q_dq_report,
    "quarantine": q_quarantine,
    "clean_summary": q_clean_summary,
    "orphan_rows": q_orphan_rows,
    "removal_report": q_removal_report,
    "dq_audit": q_dq_audit,
    "etl_gate_report": q_etl_gate_report,
    "fact_deposit": q_fact_deposit,
    "dim_loan": q_dim_loan,
    "deposits_per_customer": q_deposits_per_customer,
    "loan_book_by_status": q_loan_book_by_status,
    "dirty_clean": q_dirty_clean,
    "dirty_fact": q_dirty_fact,
    "dirty_quarantine": q_dirty_quarantine,
    "dirty_summary": q_dirty_summary,
    "dirty_removal_report": q_dirty_removal_report,
    "dirty_audit": q_dirty_audit,
    "dirty_raw_report": q_dirty_raw_report,
    "dirty_gate": q_dirty_gate,
    "curated_date_slice": q_curated_date_slice,
    "star_spend_by_segment": q_star_spend_by_segment,
    "category_totals_batch": q_category_totals_batch,
    "category_totals_stream": q_category_totals_stream,
    "category_ledger": q_category_ledger,
    "daily_totals_stream": q_daily_totals_stream,
    "ledger_batch_summary": q_ledger_batch_summary,
    "daily_spend": q_daily_spend,
    "stream_dedupe_totals": q_stream_dedupe_totals,
    "stream_known_user_totals": q_stream_known_user_totals,
    "atomic_publish": lakehouse.q_atomic_publish,
    "catalog_date_slice": lakehouse.q_catalog_date_slice,
    "registered_months": lakehouse.q_registered_months,
    "catalog_glossary": lakehouse.q_catalog_glossary,
    "folded_ledger": lakehouse.q_folded_ledger,
    "folded_totals": lakehouse.q_folded_totals,
    "dq_fail_fast": lakehouse.q_dq_fail_fast,
    "incremental_fact": lakehouse.q_incremental_fact,
    "publish_audit": lakehouse.q_publish_audit,
}

ORACLES: dict[str, str] = {
    "fact_transaction": _FACT,
    "clean_transactions": _CLEAN,
    "dim_customer": _DIM_CUSTOMER,
    "dim_account": _DIM_ACCOUNT,
    "dq_nulls": _sql_rules(NULL_RULES),
    "dq_unique": _sql_rules(UNIQUE_RULES),
    "dq_referential": _sql_rules(FK_RULES),
    "dq_range": _sql_rules(RANGE_RULES),
    "dq_report": _sql_rules(FULL_SUITE, _STAR_TABLES),
    "quarantine": _QUARANTINE,
    "clean_summary": _CLEAN_SUMMARY,
    "orphan_rows": _ORPHAN_ROWS,
    "removal_report": _removal_report(_OUTCOME),
    "dq_audit": _sql_audit(),
    "etl_gate_report": _GATE_REPORT,
    "fact_deposit": _FACT_DEPOSIT,
    "dim_loan": _DIM_LOAN,
    "deposits_per_customer": _DEPOSITS_PER_CUSTOMER,
    "loan_book_by_status": _LOAN_BOOK,
    "dirty_clean": _DIRTY_CLEAN,
    "dirty_fact": _DIRTY_FACT,
    "dirty_quarantine": f"""
  SELECT txn_id, account_id, amount, category, txn_ts, outcome AS reason
  FROM ({_DIRTY_OUTCOME}) x WHERE outcome <> 'kept'""",
    "dirty_summary": f"""
  SELECT outcome, count(*) AS row_count FROM ({_DIRTY_OUTCOME}) x GROUP BY outcome""",
    "dirty_removal_report": _removal_report(_DIRTY_OUTCOME),
    "dirty_audit": _sql_rules(AUDIT_RULES, _DIRTY_STAR),
    "dirty_raw_report": _sql_rules(DIRTY_RULES, {"transactions": f"({DIRTY_SQL})",
                                                 "orders": "orders"}),
    "dirty_gate": _sql_rules(FULL_SUITE, _DIRTY_STAR),
    "curated_date_slice": _CURATED_SLICE,
    "star_spend_by_segment": _STAR_SPEND,
    "category_totals_batch": _CATEGORY_TOTALS,
    "category_totals_stream": _CATEGORY_TOTALS,
    "category_ledger": _CATEGORY_LEDGER,
    "daily_totals_stream": _DAILY_TOTALS,
    "ledger_batch_summary": _LEDGER_BATCHES,
    "daily_spend": _DAILY_SPEND,
    "stream_dedupe_totals": _DEDUPE_TOTALS,
    "stream_known_user_totals": _KNOWN_USER_TOTALS,
    "atomic_publish": _ATOMIC_PUBLISH,
    "catalog_date_slice": _CURATED_SLICE,
    "registered_months": _REGISTERED_MONTHS,
    "catalog_glossary": _catalog_glossary(),
    "folded_ledger": _FOLDED_LEDGER,
    "folded_totals": _FOLDED_TOTALS,
    "dq_fail_fast": _FAIL_FAST,
    "incremental_fact": _FACT.replace(_TXN, _MORE_TXN),
    "publish_audit": _PUBLISH_AUDIT,
}
