"""Dimensions and passthrough tables of the star schema.

A dimension keeps one row per key. The survivor is the first row under a
total order over the published columns (the reference keeps an arbitrary
row), so reruns publish the same table. ``keep_first`` is planned with a
partial ``WindowGroupLimit``: each map task forwards one row per key, so a
key repeated a billion times costs one row per task in the shuffle.
NULL keys are not dropped here; the quality gate reports them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import as_date, as_double
from ledgerlake.operators.ranking import keep_first

DIM_CUSTOMER = ("customer_id", "full_name", "segment", "onboarded_date", "country")
DIM_ACCOUNT = ("account_id", "customer_id", "account_type", "balance", "opened_date")
FACT_DEPOSIT = ("deposit_id", "account_id", "amount", "value_date")
DIM_LOAN = ("loan_id", "customer_id", "principal", "interest_rate", "status", "origination_date")


def _with_columns(df: DataFrame, cols) -> DataFrame:
    """Select ``cols``; a column absent from the input is NULL (string)."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c)
                       for c in cols])


def _dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: as_date(df, n) for n in names if n in df.columns})


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    """Text becomes a number, or NULL where it is none; absent columns are
    NULL numbers."""
    return df.withColumns({n: as_double(df, n) for n in names})


def dedupe_dimension(df: DataFrame, key: str, cols, order=None) -> DataFrame:
    """One row per ``key`` over the columns ``cols``. ``order`` picks the
    survivor (default: the published columns left to right)."""
    projected = _with_columns(df, cols)
    rest = [c for c in cols if c != key]
    return keep_first(projected, key, list(order) if order else rest)


def build_dim_customer(customers: DataFrame, order=None) -> DataFrame:
    return _dates(dedupe_dimension(customers, "customer_id", DIM_CUSTOMER, order),
                  "onboarded_date")


def build_dim_account(accounts: DataFrame, order=None) -> DataFrame:
    typed = _doubles(_with_columns(accounts, DIM_ACCOUNT), "balance")
    return _dates(dedupe_dimension(typed, "account_id", DIM_ACCOUNT, order), "opened_date")


def passthrough(df: DataFrame, cols, date_cols=()) -> DataFrame:
    """Published unchanged apart from typing (deposits, loans)."""
    return _dates(_with_columns(df, cols), *date_cols)


def build_fact_deposit(deposits: DataFrame) -> DataFrame:
    return _doubles(passthrough(deposits, FACT_DEPOSIT, ("value_date",)), "amount")


def build_dim_loan(loans: DataFrame) -> DataFrame:
    return _doubles(passthrough(loans, DIM_LOAN, ("origination_date",)),
                    "principal", "interest_rate")
