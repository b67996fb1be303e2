"""End-to-end ETL: gate before publish, report mode, writers, catalog
registration with comments, date-partition pruning."""

import json
import os

import pytest

from ledgerlake.operators import quality
from ledgerlake.plans.etl import run_etl
from ledgerlake.sinks.writers import CatalogWriter, ParquetWriter, register_location
from ledgerlake.sources.curated import read_date_slice
from ledgerlake.sources.raw import load_raw


def _lines(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def raw_zone(root, *, dirty=False):
    _lines(f"{root}/customers/customers.jsonl", [
        {"customer_id": "c1", "full_name": "Ann", "email": "a@x", "segment": "retail",
         "onboarded_date": "2020-01-01", "country": "US"},
        {"customer_id": "c2", "full_name": "Bo", "email": "b@x", "segment": "premium",
         "onboarded_date": "2021-05-01", "country": "DE"}])
    _lines(f"{root}/accounts/accounts.jsonl", [
        {"account_id": "a1", "customer_id": "c1", "account_type": "checking", "balance": 10.0,
         "opened_date": "2020-02-01"},
        {"account_id": "a2", "customer_id": "c2", "account_type": "savings", "balance": 5.0,
         "opened_date": "2021-06-01"}])
    txns = [
        {"txn_id": "t1", "account_id": "a1", "amount": -10.0, "category": "dining",
         "txn_ts": "2026-01-01T00:00:00"},
        {"txn_id": "t2", "account_id": "a1", "amount": 25.5, "category": "salary",
         "txn_ts": "2026-01-02T08:00:00"},
        {"txn_id": "t3", "account_id": "a2", "amount": -5.0, "category": "rent",
         "txn_ts": "2026-01-02T09:00:00"}]
    if dirty:
        txns += [dict(txns[0]), {"txn_id": "t5", "account_id": "a9", "amount": 7.0,
                                 "category": "travel", "txn_ts": "2026-01-03T00:00:00"}]
    _lines(f"{root}/transactions/transactions.jsonl", txns)
    _lines(f"{root}/deposits/deposits.jsonl", [
        {"deposit_id": "d1", "account_id": "a1", "amount": 100.0, "value_date": "2026-01-01"}])
    loans = [{"loan_id": "l1", "customer_id": "c1", "principal": 1000.0, "interest_rate": 4.5,
              "status": "current", "origination_date": "2024-01-01"}]
    if dirty:
        loans.append({"loan_id": "l2", "customer_id": "c2", "principal": 10.0,
                      "interest_rate": 55.0, "status": "default",
                      "origination_date": "2024-01-01"})
    _lines(f"{root}/loans/loans.jsonl", loans)
    return root


def test_clean_run_publishes(spark, tmp_dir):
    raw = load_raw(spark, raw_zone(f"{tmp_dir}/raw"))
    writer = ParquetWriter(f"{tmp_dir}/curated")
    result = run_etl(spark, raw, writer)
    assert result.passed
    assert set(result.published) >= {"dim_customer", "dim_account", "fact_transaction",
                                      "fact_deposit", "dim_loan", "dq_report"}
    fact = spark.read.parquet(writer.path("fact_transaction"))
    assert fact.count() == 3
    dates = sorted(d for d in os.listdir(writer.path("fact_transaction"))
                   if d.startswith("txn_date="))
    assert dates == ["txn_date=2026-01-01", "txn_date=2026-01-02"]


def test_dirty_run_is_gated(spark, tmp_dir):
    raw = load_raw(spark, raw_zone(f"{tmp_dir}/raw", dirty=True))
    writer = ParquetWriter(f"{tmp_dir}/curated")
    result = run_etl(spark, raw, writer)
    # the orphan stays in the fact and fails its rule, like the loan rate
    assert sorted((r.table_name, r.rule) for r in result.failed) == [
        ("dim_loan", "range"), ("fact_transaction", "referential")]
    assert "fact_transaction" not in result.published
    q = spark.read.parquet(writer.path("quarantine_transaction")).collect()
    assert sorted(r.reason for r in q) == ["duplicate"]
    # on request the orphan is quarantined instead
    result = run_etl(spark, raw, ParquetWriter(f"{tmp_dir}/curated1"), drop_orphans=True)
    assert [(r.table_name, r.rule) for r in result.failed] == [("dim_loan", "range")]
    assert sorted(r.reason for r in result.quarantine.collect()) == ["duplicate", "orphan"]
    # report mode publishes anyway
    result = run_etl(spark, raw, ParquetWriter(f"{tmp_dir}/curated2"), enforce=False)
    assert "fact_transaction" in result.published


def test_cli_exit_code(tmp_dir):
    import subprocess
    import sys
    raw = raw_zone(f"{tmp_dir}/raw", dirty=True)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    proc = subprocess.run(
        [sys.executable, "-m", "ledgerlake.plans.etl", "--input", raw, "--output",
         f"{tmp_dir}/out", "--master", "local[2]"],
        cwd=root, capture_output=True, text=True, timeout=300)
    assert proc.returncode == 1
    assert "FAILED [dim_loan] column 'interest_rate' has 1 values outside [0, 40]" in proc.stdout


def test_catalog_writer_comments_and_pruning(spark, tmp_dir):
    raw = load_raw(spark, raw_zone(f"{tmp_dir}/raw"))
    writer = CatalogWriter("curated_test")
    result = run_etl(spark, raw, writer)
    assert result.passed
    parts = [r[0] for r in spark.sql("SHOW PARTITIONS curated_test.fact_transaction").collect()]
    assert parts == ["txn_date=2026-01-01", "txn_date=2026-01-02"]
    comments = {r.col_name: r.comment for r in
                spark.sql("DESCRIBE TABLE curated_test.fact_transaction").collect()}
    assert comments["amount"].startswith("Signed amount")
    sliced = spark.table("curated_test.fact_transaction").filter("txn_date = DATE'2026-01-02'")
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_date" in plan
    assert sliced.count() == 2


def test_register_existing_files_and_date_slice(spark, tmp_dir):
    raw = load_raw(spark, raw_zone(f"{tmp_dir}/raw"))
    writer = ParquetWriter(f"{tmp_dir}/curated")
    run_etl(spark, raw, writer)
    path = writer.path("fact_transaction")
    register_location(spark, "default.fact_registered", path, partitioned=True)
    assert spark.table("default.fact_registered").count() == 3
    df = read_date_slice(spark, path, "2026-01-02", "2026-01-02")
    assert "PartitionFilters" in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.txn_id for r in df.collect()) == ["t2", "t3"]


def test_report_schema(spark):
    report = quality.run_rules({}, ())
    assert report.schema == quality.REPORT_SCHEMA and report.count() == 0
    # a rule that cannot be checked does not pass
    with pytest.raises(KeyError):
        quality.run_rules({}, quality.STAR_SCHEMA_RULES)


def test_audit_dirty_transactions(spark, tmp_dir):
    from ledgerlake.operators.cleaning import clean_summary
    from ledgerlake.plans.etl import audit_transactions
    raw = load_raw(spark, raw_zone(f"{tmp_dir}/raw", dirty=True))
    report = audit_transactions(raw["transactions"], raw["accounts"])
    summary = clean_summary(raw["transactions"], raw["accounts"])
    assert {r.outcome: r.row_count for r in summary.collect()} == {
        "kept": 3, "duplicate": 1, "orphan": 1}
    failed = [(r.rule, r.column_name, r.violations) for r in report.collect() if not r.passed]
    assert failed == [("referential", "account_id", 1)]


def test_dynamic_overwrite_keeps_other_dates(spark, tmp_dir):
    df = spark.createDataFrame([("t1", "2026-01-01"), ("t2", "2026-01-02")],
                               "txn_id string, txn_date string")
    ParquetWriter(f"{tmp_dir}/c").write(df, "f", "txn_date")
    reload = spark.createDataFrame([("t9", "2026-01-02")], "txn_id string, txn_date string")
    ParquetWriter(f"{tmp_dir}/c", dynamic=True).write(reload, "f", "txn_date")
    got = sorted((r.txn_id, str(r.txn_date)) for r in spark.read.parquet(f"{tmp_dir}/c/f").collect())
    assert got == [("t1", "2026-01-01"), ("t9", "2026-01-02")]
    # static (default) overwrite replaces the whole table
    ParquetWriter(f"{tmp_dir}/c").write(reload, "f", "txn_date")
    assert spark.read.parquet(f"{tmp_dir}/c/f").count() == 1


def test_etl_with_one_large_account(spark, tmp_dir):
    """One account holds most transactions: its numbers have no gap."""
    root = raw_zone(f"{tmp_dir}/raw")
    rows = [{"txn_id": f"h{i:03d}", "account_id": "a1", "amount": float(i), "category": "rent",
             "txn_ts": f"2026-01-{1 + i % 20:02d}T{i % 24:02d}:00:00"} for i in range(300)]
    rows += [{"txn_id": f"c{i:03d}", "account_id": "a2", "amount": 1.0, "category": "food",
              "txn_ts": "2026-01-03T00:00:00"} for i in range(5)]
    _lines(f"{root}/transactions/transactions.jsonl", rows)
    result = run_etl(spark, load_raw(spark, root), ParquetWriter(f"{tmp_dir}/out"))
    assert result.passed
    fact = spark.read.parquet(f"{tmp_dir}/out/fact_transaction").collect()
    want = sorted((r["txn_ts"], r["txn_id"]) for r in rows[:300])
    got = {r.txn_id: r.txn_seq_in_account for r in fact}
    assert [got[i] for _, i in want] == list(range(1, 301))


def test_quoted_amounts_are_numbers(spark, tmp_dir):
    root = raw_zone(f"{tmp_dir}/raw")
    base = {"account_id": "a1", "category": "rent", "txn_ts": "2026-01-03T00:00:00"}
    _lines(f"{root}/transactions/transactions.jsonl", [
        {"txn_id": "q1", "amount": "19.99", **base}, {"txn_id": "q2", "amount": 3, **base},
        {"txn_id": "q3", "amount": "oops", **base}])
    result = run_etl(spark, load_raw(spark, root), None)
    fact = {r.txn_id: r.amount for r in result.tables["fact_transaction"].collect()}
    assert fact == {"q1": 19.99, "q2": 3.0}
    assert [(r.txn_id, r.reason) for r in result.quarantine.collect()] == [("q3", "bad_amount")]
