"""Fail-fast forms of the library's reports, for callers that expect them.

* ``run_all_checks`` raises ``DataQualityError`` for the first failing rule
  in suite order (``run_rules`` / ``enforce`` report every rule instead).
* ``aggregate_batch`` is the per-invocation stream aggregate (category →
  sum, records, and a count of 1).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import quality
from ledgerlake.operators.quality import DataQualityError


def _suite_position(suite):
    """(table, rule, column) → position in the order the suite lists them."""
    pos = {}
    for t, rules in enumerate(suite):
        for c in rules.not_null:
            pos.setdefault((rules.table, "not_null", c), (t, 0, len(pos)))
        for c in rules.unique:
            pos.setdefault((rules.table, "unique", c), (t, 1, len(pos)))
        for fk in rules.foreign_keys:
            pos.setdefault((rules.table, "referential", fk.column), (t, 2, len(pos)))
        for r in rules.ranges:
            pos.setdefault((rules.table, "range", r.column), (t, 3, len(pos)))
    return pos


def run_all_checks(dim_customer: DataFrame, dim_account: DataFrame,
                   fact_transaction: DataFrame, dim_loan: DataFrame) -> None:
    """The star-schema suite, fail-fast: raises for the first failing rule
    (all rules are still evaluated in one pass)."""
    suite = quality.STAR_SCHEMA_RULES
    tables = {"dim_customer": dim_customer, "dim_account": dim_account,
              "fact_transaction": fact_transaction, "dim_loan": dim_loan}
    bad = quality.failures(quality.run_rules(tables, suite))
    if bad:
        pos = _suite_position(suite)
        first = min(bad, key=lambda r: pos[(r.table_name, r.rule, r.column_name)])
        raise DataQualityError(quality.message(first), [first])


def aggregate_batch(events: DataFrame) -> DataFrame:
    """One invocation's records → (category, total, n records, count 1)."""
    return events.groupBy("category").agg(F.sum("amount").alias("total"),
                                          F.count(F.lit(1)).alias("n"),
                                          F.lit(1).cast("long").alias("count"))
