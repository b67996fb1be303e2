"""Consumption queries over the star schema.

The fact is aggregated to (account_id, category) *before* it meets the
dimensions: partial aggregation runs map-side, so the join shuffles at
most one row per account and category per task, and an account holding a
third of all rows collapses to a handful of rows instead of one giant join
partition. The two dimensions are joined to each other first (account →
segment, far smaller than the fact); the result is broadcast when Spark's
size estimate or AQE's runtime size allows, shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def account_segments(dim_account: DataFrame, dim_customer: DataFrame) -> DataFrame:
    a = dim_account.select("account_id", "customer_id")
    c = dim_customer.select(F.col("customer_id").alias("_cid"), "segment")
    return a.join(c, a["customer_id"] == c["_cid"], "inner").select("account_id", "segment")


def spend_by_segment(fact: DataFrame, dim_account: DataFrame, dim_customer: DataFrame) -> DataFrame:
    seg = account_segments(dim_account, dim_customer).withColumnRenamed("account_id", "_aid")
    per_account = (fact.groupBy("account_id", "category")
                   .agg(F.sum("amount").alias("_sum"), F.count(F.lit(1)).alias("_n")))
    j = per_account.join(seg, F.col("account_id") == F.col("_aid"), "inner")
    return (j.groupBy("segment", "category")
            .agg(F.round(F.sum("_sum"), 2).alias("total_amount"),
                 F.sum("_n").alias("txn_count")))


def deposits_per_customer(fact_deposit: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Deposit count and sum per customer (deposit → account → customer);
    deposits are pre-aggregated per account before the join."""
    a = dim_account.select(F.col("account_id").alias("_aid"), "customer_id")
    per_account = (fact_deposit.groupBy("account_id")
                   .agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum")))
    j = per_account.join(a, F.col("account_id") == F.col("_aid"), "inner")
    return (j.groupBy("customer_id")
            .agg(F.sum("_n").alias("deposit_count"),
                 F.round(F.sum("_sum"), 2).alias("deposit_total")))


def loan_book_by_status(dim_loan: DataFrame) -> DataFrame:
    """Loan count, principal and average rate per lifecycle status."""
    return (dim_loan.groupBy("status")
            .agg(F.count(F.lit(1)).alias("loan_count"),
                 F.round(F.sum("principal"), 2).alias("principal_total"),
                 F.round(F.avg("interest_rate"), 4).alias("avg_interest_rate")))


def daily_spend(fact: DataFrame) -> DataFrame:
    """Per txn_date and category: the partition-aligned daily rollup that
    downstream reports read with date pruning."""
    return (fact.groupBy("txn_date", "category")
            .agg(F.round(F.sum("amount"), 2).alias("total_amount"),
                 F.count(F.lit(1)).alias("txn_count")))
