"""Explicit schemas for the raw banking entities and the stream records.

Reading with a fixed schema instead of inference means: no inference job,
stable types, an absent field becomes NULL (the large and dirty data sets
omit ``opened_date``), empty files still yield a typed DataFrame, and a
malformed line lands in ``_corrupt_record`` instead of vanishing.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


# Raw JSON-lines layouts. Everything is read as text, numbers too (a quoted
# number is a number), and typed by the builds.
CUSTOMERS = T.StructType(_strings(
    "customer_id", "full_name", "email", "segment", "onboarded_date", "country"))

ACCOUNTS = T.StructType(
    _strings("account_id", "customer_id", "account_type")
    + [T.StructField("balance", T.StringType(), True)]
    + _strings("opened_date"))

TRANSACTIONS = T.StructType(
    _strings("txn_id", "account_id")
    + [T.StructField("amount", T.StringType(), True)]
    + _strings("category", "txn_ts"))

DEPOSITS = T.StructType(
    _strings("deposit_id", "account_id")
    + [T.StructField("amount", T.StringType(), True)]
    + _strings("value_date"))

LOANS = T.StructType(
    _strings("loan_id", "customer_id")
    + [T.StructField("principal", T.StringType(), True),
       T.StructField("interest_rate", T.StringType(), True)]
    + _strings("status", "origination_date"))

RAW = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "transactions": TRANSACTIONS,
    "deposits": DEPOSITS,
    "loans": LOANS,
}

# A stream event carries the transaction fields; its txn_ts has a UTC offset.
STREAM_EVENT = T.StructType(
    _strings("txn_id", "account_id")
    + [T.StructField("amount", T.DoubleType(), True)]
    + _strings("category", "txn_ts"))

# Batch envelope: one text column holding base64 of the event JSON.
ENVELOPE = T.StructType([T.StructField("data", T.StringType(), True)])


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.fieldNames():
        return schema
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])


# Comments of curated columns, attached when tables are published.
GLOSSARY = {
    "dim_customer": {
        "customer_id": "Key of the customer",
        "segment": "Customer tier, e.g. retail or premium",
    },
    "dim_account": {
        "account_type": "Kind of account, e.g. checking or savings",
        "balance": "Balance in USD at the time of extraction",
    },
    "fact_transaction": {
        "amount": "Signed amount: spending is below zero",
        "category": "Spending category",
        "txn_date": "Day of txn_ts; the table is partitioned by it",
    },
    "dim_loan": {
        "principal": "Amount lent at the start",
        "interest_rate": "Yearly rate in percent",
        "status": "State of the loan, e.g. current or paid_off",
    },
    "fact_deposit": {
        "value_date": "Day from which the deposit counts",
    },
}
