"""Adapters from the driver's TPC-H-like tables to the banking roles.

Operators work on the banking column names; these projections rename
(Catalyst folds them into the scan, so column pruning and filter pushdown
still reach Parquet).

| role          | table(s)                | mapping |
| customers     | customer, nation, orders | one snapshot per order: onboarded_date = o_orderdate, country = n_name |
| accounts      | orders                  | account_id = o_orderkey, customer_id = o_custkey |
| transactions  | lineitem                | txn_id = l_orderkey-l_linenumber, account_id = l_orderkey, amount = l_extendedprice, category = l_returnflag, txn_ts = l_shipdate |
| stream events | events                  | txn_id = event_id, account_id = user_id, amount = value, category = event_type, txn_ts = ts |
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table (one file, or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("txn_id"),
        F.col("l_orderkey").alias("account_id"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_returnflag").alias("category"),
        F.col("l_shipdate").alias("txn_ts"))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("account_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        F.col("o_totalprice").alias("balance"),
        F.col("o_orderdate").alias("opened_date"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer snapshots: one row per (customer, order), so the customer
    key repeats and the dimension's dedupe does real work."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"], "left")
            .join(o, c["c_custkey"] == o["o_custkey"], "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    F.col("c_name").alias("full_name"),
                    F.lit(None).cast("string").alias("email"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("o_orderdate").alias("onboarded_date"),
                    F.col("n_name").alias("country")))


def dirty_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with every kind of damage, as text: missing and repeated
    ids, missing and unknown accounts, missing, NaN and non-numeric
    amounts, missing and unreadable times. Which rows are hit depends on
    the line item's own numbers (see ``DIRTY_SQL`` in the catalog)."""
    o, n = "l_orderkey", "l_linenumber"
    return table(spark, sf_dir, "lineitem").selectExpr(
        f"CASE WHEN {o} % 50 = 7 AND {n} = 1 THEN NULL"
        f"     WHEN {o} % 40 = 3 THEN CAST({o} AS STRING) || '-1'"
        f"     ELSE CAST({o} AS STRING) || '-' || CAST({n} AS STRING) END AS txn_id",
        f"CASE WHEN {o} % 60 = 11 AND {n} = 2 THEN NULL"
        f"     WHEN {o} % 100 = 13 THEN -{o} ELSE {o} END AS account_id",
        f"CASE WHEN {o} % 70 = 5 AND {n} = 1 THEN NULL WHEN {o} % 70 = 6 AND {n} = 1 THEN 'NaN'"
        f"     WHEN {o} % 70 = 8 AND {n} = 1 THEN 'n/a'"
        "      ELSE CAST(CAST(l_extendedprice AS DECIMAL(18, 2)) AS STRING) END AS amount",
        "l_returnflag AS category",
        f"CASE WHEN {o} % 80 = 9 AND {n} = 1 THEN NULL WHEN {o} % 80 = 10 AND {n} = 1"
        "      THEN 'soon' ELSE date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') END AS txn_ts")


def more_transactions(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Transactions in three loads: those before 1996; the later ones but
    for every second of an order, with earlier copies of some rows of any
    load; the rest, with copies of other rows that differ in the amount."""
    txn = transactions(spark, sf_dir)
    first = F.col("txn_ts") < F.lit("1996-01-01").cast("date")
    second = F.col("txn_id").endswith("-2")
    earlier = txn.where("account_id % 10 = 3 AND txn_id LIKE '%-1'").withColumn(
        "txn_ts", F.expr("txn_ts - INTERVAL 40 DAYS"))
    dearer = txn.where("account_id % 10 = 4").withColumn("amount", F.col("amount") + 1)
    return [txn.where(first), txn.where(~first & ~second).unionByName(earlier),
            txn.where(~first & second).unionByName(dearer)]


def deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One deposit per order, on the order's account."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS deposit_id", "o_orderkey AS account_id", "o_totalprice AS amount",
        "o_orderdate AS value_date")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One loan per order of a customer; the rate is set by the priority's
    first digit, and far too high for some orders."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS loan_id", "o_custkey AS customer_id", "o_totalprice AS principal",
        "CASE WHEN o_orderkey % 97 = 0 THEN 99.5"
        " ELSE CAST(substring(o_orderpriority, 1, 1) AS DOUBLE) END AS interest_rate",
        "o_orderstatus AS status", "o_orderdate AS origination_date")


def stream_events(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("user_id").alias("account_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("category"),
        F.col("ts").alias("txn_ts"))
