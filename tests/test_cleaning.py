"""Cleaning, dedupe, dimensions: nulls and NaN, bad values, deterministic
survivors, quarantine reasons."""

import datetime as dt
import json
import math
import os

from pyspark.sql import functions as F

from ledgerlake.operators import cleaning, dims, sequence
from ledgerlake.schemas import ACCOUNTS, CUSTOMERS, DEPOSITS, LOANS, TRANSACTIONS
from ledgerlake.sources.raw import load_raw, read_json_lines

TXN_COLS = ["txn_id", "account_id", "amount", "category", "txn_ts"]


def txns(spark, rows):
    return spark.createDataFrame(rows, TRANSACTIONS)


def test_rows_without_a_required_value_go(spark):
    whole = ("p7", "acc-3", "81.4", "books", "2025-11-30T17:45:00")
    holes = [tuple(None if k == i else v for k, v in enumerate(whole)) for i in (0, 1, 2, 4)]
    out = cleaning.clean_transactions(txns(spark, [*holes, whole])).collect()
    assert [(r.txn_id, r.amount, r.txn_date) for r in out] == [
        ("p7", 81.4, dt.date(2025, 11, 30))]


def test_dimension_keeps_the_first_row_of_a_key(spark):
    rows = [("k2", "Noor", "n@x", "premium", "2019-05-06", "NL"),
            ("k2", "Noor", "n@y", "premium", "2018-02-03", "NL"),
            ("k1", "Ivo", None, "student", None, "CZ")]
    dim = dims.build_dim_customer(spark.createDataFrame(rows, CUSTOMERS))
    assert dim.columns == ["customer_id", "full_name", "segment", "onboarded_date", "country"]
    assert {r.customer_id: r.onboarded_date for r in dim.collect()} == {
        "k1": None, "k2": dt.date(2018, 2, 3)}


def test_nan_and_null_amount_dropped(spark):
    df = txns(spark, [("t1", "a", "NaN", "x", "2026-01-01T00:00:00"),
                      ("t2", "a", None, "x", "2026-01-01T00:00:00"),
                      ("t3", "a", "1.0", "x", "2026-01-01T00:00:00")])
    assert [r.amount for r in cleaning.clean_transactions(df).collect()] == [1.0]


# Hand-written dirty batch: 8 rows in, accounts {a1, a2}.
DIRTY = [
    ("t1", "a1", "-10.0", "dining", "2026-01-01T00:00:00"),
    ("t2", "a1", "25.5", "salary", "2026-01-02T08:00:00"),
    ("t2", "a1", "25.5", "salary", "2026-01-02T08:00:00"),
    ("t3", "a1", "-5.0", "rent", "2026-01-02T08:00:00"),
    ("t4", "a2", None, "rent", "2026-01-03T00:00:00"),
    ("t5", "a9", "7.0", "travel", "2026-01-03T00:00:00"),
    ("t6", "a2", "1.0", "travel", "not-a-time"),
    ("t7", "a2", "3.0", "rent", "2026-01-04T23:59:59"),
]


def _accounts(spark):
    return spark.createDataFrame([("a1", "c1", "checking", "1.0", None),
                                  ("a2", "c1", "savings", "2.0", None)], ACCOUNTS)


def test_dirty_split(spark):
    raw = txns(spark, DIRTY)
    kept, quarantine = cleaning.split_transactions(raw, _accounts(spark))
    fact = sequence.build_fact_transaction(kept).collect()
    got = {r.txn_id: (r.txn_date, r.txn_seq_in_account) for r in fact}
    assert got == {"t1": (dt.date(2026, 1, 1), 1), "t2": (dt.date(2026, 1, 2), 2),
                   "t3": (dt.date(2026, 1, 2), 3), "t7": (dt.date(2026, 1, 4), 1)}
    reasons = sorted((r.txn_id, r.reason) for r in quarantine.collect())
    assert reasons == [("t2", "duplicate"), ("t4", "null_key"), ("t5", "orphan"),
                       ("t6", "bad_txn_ts")]
    summary = {r.outcome: r.row_count for r in
               cleaning.clean_summary(raw, _accounts(spark)).collect()}
    assert summary == {"kept": 4, "duplicate": 1, "null_key": 1, "orphan": 1, "bad_txn_ts": 1}
    report = cleaning.removal_report(cleaning.clean_summary(raw, _accounts(spark))).collect()[0]
    assert (report.raw_rows, report.clean_rows, report.removed_rows, report.orphan_rows) == (
        8, 5, 3, 1)


def test_valid_copy_wins_over_bad_copy(spark):
    df = txns(spark, [("t1", "a1", "1.0", "x", "garbage"),
                      ("t1", "a1", "2.0", "x", "2026-01-01T00:00:00")])
    out = cleaning.clean_transactions(df).collect()
    assert [(r.amount, r.txn_ts) for r in out] == [(2.0, dt.datetime(2026, 1, 1))]


def test_survivor_is_deterministic(spark):
    rows = [("t1", "a1", str(float(a)), "x", "2026-01-01T00:00:00") for a in (5, 3, 9)]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        out = cleaning.clean_transactions(txns(spark, order).repartition(3)).collect()
        assert [r.amount for r in out] == [3.0]


def test_text_amount_and_offset_timestamps(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in TXN_COLS])
    df = spark.createDataFrame([("t1", "a", "12.5", "x", "2026-01-01T10:00:00+02:00"),
                                ("t2", "a", "twelve", "x", "2026-01-01T10:00:00")], schema)
    kept, q = cleaning.split_transactions(df)
    k = kept.collect()
    assert [(r.txn_id, r.amount, r.txn_ts) for r in k] == [
        ("t1", 12.5, dt.datetime(2026, 1, 1, 8, 0))]
    assert [(r.txn_id, r.reason, r.amount) for r in q.collect()] == [("t2", "bad_amount", "twelve")]


def _write_lines(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for line in lines:
            f.write(line if isinstance(line, str) else json.dumps(line))
            f.write("\n")


def test_raw_reader_variants(spark, tmp_dir):
    # accounts without opened_date, customers without email, empty
    # deposits / loans, one corrupt transaction line.
    _write_lines(f"{tmp_dir}/customers/customers.jsonl",
                 [{"customer_id": "c1", "full_name": "A", "segment": "retail",
                   "onboarded_date": "2020-01-01", "country": "US"}])
    _write_lines(f"{tmp_dir}/accounts/accounts.jsonl",
                 [{"account_id": "a1", "customer_id": "c1", "account_type": "checking",
                   "balance": 10.5}])
    _write_lines(f"{tmp_dir}/transactions/transactions.jsonl",
                 [{"txn_id": "t1", "account_id": "a1", "amount": -1.0, "category": "rent",
                   "txn_ts": "2026-01-01T00:00:00"}, "{not json"])
    _write_lines(f"{tmp_dir}/deposits/deposits.jsonl", [])
    _write_lines(f"{tmp_dir}/loans/loans.jsonl", [])
    raw = load_raw(spark, tmp_dir)
    assert raw["deposits"].count() == 0 and raw["loans"].count() == 0
    acct = dims.build_dim_account(raw["accounts"]).collect()
    assert acct[0]["opened_date"] is None and acct[0]["balance"] == 10.5
    kept, q = cleaning.split_transactions(raw["transactions"].cache())
    assert kept.count() == 1
    assert [r.reason for r in q.collect()] == ["corrupt_record"]
    assert dims.build_fact_deposit(raw["deposits"]).columns == list(
        ["deposit_id", "account_id", "amount", "value_date"])
    assert dims.build_dim_loan(raw["loans"]).count() == 0


def test_typed_reader_schema(spark, tmp_dir):
    _write_lines(f"{tmp_dir}/x.jsonl", [{"loan_id": "l1", "interest_rate": 3.5}])
    df = read_json_lines(spark, f"{tmp_dir}/x.jsonl", LOANS)
    assert df.schema["interest_rate"].dataType.typeName() == "string"
    r = dims.build_dim_loan(df).collect()[0]
    assert r.loan_id == "l1" and r.principal is None and math.isclose(r.interest_rate, 3.5)
    assert read_json_lines(spark, f"{tmp_dir}/x.jsonl", DEPOSITS, keep_corrupt=False).columns == [
        "deposit_id", "account_id", "amount", "value_date"]


def test_null_dimension_key_survives_as_one_row(spark):
    rows = [(None, "A", None, "retail", "2020-01-01", "US"),
            (None, "B", None, "retail", "2020-01-01", "US")]
    dim = dims.build_dim_customer(spark.createDataFrame(rows, CUSTOMERS))
    assert dim.count() == 1
    assert dim.filter(F.col("customer_id").isNull()).collect()[0]["full_name"] == "A"


def test_quarantine_keeps_rows_as_read(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField(c, T.StringType()) for c in TXN_COLS])
    rows = [("t1", "a1", "5", "x", "2026-01-01T10:00:00+02:00"),   # same instant as next
            ("t1", "a1", "5", "x", "2026-01-01T08:00:00Z"),
            ("t2", "a9", "1.50", "x", "2026-01-02T00:00:00+00:00")]  # orphan
    df = spark.createDataFrame(rows, schema)
    accounts = spark.createDataFrame([("a1",)], "account_id string")
    kept, q = cleaning.split_transactions(df, accounts)
    got = sorted((r.txn_id, r.amount, r.txn_ts, r.reason) for r in q.collect())
    # the survivor of t1 is the copy whose original text sorts first
    assert got == [("t1", "5", "2026-01-01T10:00:00+02:00", "duplicate"),
                   ("t2", "1.50", "2026-01-02T00:00:00+00:00", "orphan")]
    assert [(r.txn_id, r.amount) for r in kept.collect()] == [("t1", 5.0)]


def test_quarantine_numbers_repeated_rows_where_the_join_leaves_them(spark):
    from ledgerlake import storage
    from ledgerlake.operators.cleaning import quarantine_transactions
    from ledgerlake.session import checkpoint_root
    raw = spark.createDataFrame(
        [(i, 1, float(n), "a", f"2024-01-0{n + 1} 00:00:00") for i in ("x", "y") for n in range(3)]
        + [("z", 1, 1.0, "a", "2024-01-01 00:00:00"), (None, 1, 1.0, "a", "2024-01-01 00:00:00")],
        "txn_id string, account_id long, amount double, category string, ts string") \
        .selectExpr("txn_id", "account_id", "amount", "category", "CAST(ts AS timestamp) AS txn_ts")

    def staged_names():
        return [n.rpartition("-")[0] for n in storage.names(
            spark, f"{checkpoint_root(spark)}/ledgerlake")]
    before = staged_names()
    got = sorted((str(r.txn_id), r.amount, r.reason) for r in quarantine_transactions(raw).collect())
    assert got == [("None", 1.0, "null_key")] + [
        (i, n, "duplicate") for i in ("x", "y") for n in (1.0, 2.0)]
    after = staged_names()
    # Neither the repeated rows nor a range-partitioned copy are written.
    for name in ("numbered", "placed"):
        assert after.count(name) == before.count(name)
