"""Physical-plan assertions on the driver tables: pushdown, pruning,
shuffle count, map-side limits."""

import re

import pytest

from ledgerlake import storage
from ledgerlake.operators import cleaning, quality
from ledgerlake.plans import catalog, lakehouse
from ledgerlake.sources import tables

SF = "/root/testdata/sf0.001"


def plan_of(df):
    jvm = df.sparkSession._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_clean_path_pushes_filters_and_prunes_columns(spark):
    plan = plan_of(cleaning.clean_transactions(tables.transactions(spark, SF)))
    assert "PushedFilters: [IsNotNull(l_orderkey), IsNotNull(l_extendedprice), IsNotNull(l_shipdate)]" in plan
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert "l_partkey" not in read and "l_tax" not in read


def test_dedupe_limits_before_the_shuffle(spark):
    plan = plan_of(catalog.q_clean_transactions(spark, SF))
    assert re.findall(r"Arguments: hashpartitioning\((\w+)", plan) == ["txn_id"]
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_clean_summary_scans_the_transactions_once(spark):
    plan = plan_of(catalog.q_clean_summary(spark, SF))
    assert len(re.findall(r"Scan parquet.*\nOutput.*l_orderkey", plan)) == 1


def test_fk_check_broadcasts_small_parent(spark):
    orders = tables.table(spark, SF, "orders")
    customer = tables.table(spark, SF, "customer")
    rules = quality.TableRules("orders", foreign_keys=(
        quality.ForeignKey("o_custkey", "customer", "c_custkey"),))
    df = quality.table_checks(orders, rules, {"customer": customer})[0]
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final or "broadcast" in final.lower()


def test_star_query_pre_aggregates_fact(spark):
    plan = plan_of(catalog.q_star_spend_by_segment(spark, SF))
    # the fact reaches the join as partial sums per (account_id, category)
    assert re.search(r"Keys \[2\]: \[account_id#\d+L?, category#\d+\]\n"
                     r"Functions \[2\]: \[partial_sum", plan)


def test_fk_check_joins_one_row_per_key(spark):
    """Counted by key before the join: rows, hot and NULL keys are not shuffled."""
    child = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(40)],
                                  "k int, v int").unionByName(
        spark.createDataFrame([(7, None)], "k int, v int"))
    parent = spark.createDataFrame([(0,), (1,), (1,), (None,)], "k int")
    rules = quality.TableRules("c", not_null=("v",), foreign_keys=(
        quality.ForeignKey("k", "p", "k"),))
    df = quality.table_checks(child, rules, {"p": parent})[0]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter.*\n[\s:|+-]*(Project.*\n[\s:|+-]*)?Aggregate \[k", plan)
    twos = sum(1 for i in range(40) if i % 4 and i % 3 == 2)
    assert {(r.rule, r.violations, r.total) for r in df.collect()} == {
        ("not_null", 1, 41), ("referential", 10 + twos + 1, 41)}
    empty = quality.table_checks(child.where("v > 99"), rules, {"p": parent})[0].collect()
    assert {(r.rule, r.violations, r.total, r.passed) for r in empty} == {
        ("not_null", 0, 0, True), ("referential", 0, 0, True)}


def test_dirty_gate_writes_compressed_lines_in_many_files(spark, monkeypatch):
    seen = []

    def stop(spark, raw):
        seen.append(raw)
        raise InterruptedError
    monkeypatch.setattr(catalog, "JSON_ROWS", 1000)
    monkeypatch.setattr(catalog, "load_raw", stop)
    with pytest.raises(InterruptedError):
        catalog.q_dirty_gate(spark, SF)
    folder = f"{seen[0]}/transactions/transactions.jsonl"
    names = [n for n in storage.names(spark, folder) if not n.startswith("_")]
    n = tables.table(spark, SF, "lineitem").count()
    assert len(names) >= n / 1000 and all(x.endswith(".json.gz") for x in names)
    assert spark.read.text(folder).count() == n


def test_fail_fast_builds_each_variant_once(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(lakehouse.compat, "run_all_checks", lambda **star: seen.append(star))
    lakehouse.q_dq_fail_fast(spark, SF)
    for star in seen:
        for df in star.values():
            assert "Exchange" not in plan_of(df)
