"""Quality rules: the original raise-on-failure tests and the corner cases
(NULL vs NaN, NULLs in unique, NULL foreign keys, self reference, range
bounds)."""

import pytest
from pyspark.sql import types as T

from ledgerlake.operators import quality
from ledgerlake.operators.quality import (
    DataQualityError, ForeignKey, TableRules, ValueRange, assert_no_nulls,
    assert_referential_integrity, assert_unique, assert_value_range,
)


def one_col(spark, values, dtype=T.StringType(), name="customer_id"):
    return spark.createDataFrame([(v,) for v in values],
                                 T.StructType([T.StructField(name, dtype)]))


def rows(report):
    return {(r.table_name, r.rule, r.column_name): (r.violations, r.total, r.passed)
            for r in report.collect()}


def test_null_rule_raises(spark):
    with pytest.raises(DataQualityError, match="has 1 null values"):
        assert_no_nulls(one_col(spark, ["c1", None]), ["customer_id"], "dim_customer")


def test_unique_rule_raises(spark):
    with pytest.raises(DataQualityError, match="2 rows vs 1 distinct"):
        assert_unique(one_col(spark, ["c1", "c1"]), "customer_id", "dim_customer")


def test_unique_with_nulls(spark):
    assert_unique(one_col(spark, [None, "a"]), "customer_id", "t")
    with pytest.raises(DataQualityError, match="3 rows vs 2 distinct"):
        assert_unique(one_col(spark, [None, None, "a"]), "customer_id", "t")


def test_not_null_counts_null_but_not_nan(spark):
    df = one_col(spark, [float("nan"), None, 1.0], T.DoubleType(), "amount")
    r = rows(quality.table_checks(df, TableRules("t", not_null=("amount",)))[0])
    assert r[("t", "not_null", "amount")] == (1, 3, False)


def test_null_foreign_key_is_orphan(spark):
    child = one_col(spark, [None, "a"], name="k")
    parent = one_col(spark, [None, "a"], name="k")
    with pytest.raises(DataQualityError, match="1 rows in 'k'") as e:
        assert_referential_integrity(child, "k", parent, "k", "child")
    assert e.value.rows[0]["violations"] == 1


def test_self_reference(spark):
    df = spark.createDataFrame([("e1", None), ("e2", "e1"), ("e3", "e9")], "id string, boss string")
    rules = TableRules("emp", foreign_keys=(ForeignKey("boss", "emp", "id"),))
    r = quality.table_checks(df, rules, {"emp": df})[0].collect()[0]
    assert (r.violations, r.total) == (2, 3)  # NULL boss and e9


def test_range_bounds(spark):
    df = one_col(spark, [-0.01, 0.0, 40.0, 40.01, None, float("nan")], T.DoubleType(), "rate")
    with pytest.raises(DataQualityError, match="has 3 values outside"):
        assert_value_range(df, "rate", 0, 40, "dim_loan")
    assert_value_range(one_col(spark, [0.0, 40.0, None], T.DoubleType(), "rate"),
                       "rate", 0, 40, "dim_loan")


def test_star_suite_report_and_enforce(spark):
    cust = spark.createDataFrame([("c1", "A"), ("c2", None)], "customer_id string, full_name string")
    acct = spark.createDataFrame([("a1", "c1"), ("a2", "c9"), ("a2", "c1")],
                                 "account_id string, customer_id string")
    fact = spark.createDataFrame([("t1", "a1", 1.0, None)],
                                 "txn_id string, account_id string, amount double, txn_ts timestamp")
    loans = spark.createDataFrame([("c1", 3.0), ("c2", 45.0)],
                                  "customer_id string, interest_rate double")
    tables = {"dim_customer": cust, "dim_account": acct, "fact_transaction": fact,
              "dim_loan": loans}
    suite = quality.STAR_SCHEMA_RULES + quality.STAR_SCHEMA_ADDITIONS
    with pytest.raises(KeyError):  # the suite also has a rule on deposits
        quality.run_rules(tables, suite)
    tables["fact_deposit"] = spark.createDataFrame([("a1",)], "account_id string")
    report = quality.run_rules(tables, suite)
    r = rows(report)
    assert r[("dim_customer", "not_null", "full_name")] == (1, 2, False)
    assert r[("dim_account", "unique", "account_id")] == (1, 3, False)
    assert r[("dim_account", "referential", "customer_id")] == (1, 3, False)
    assert r[("fact_transaction", "not_null", "txn_ts")] == (1, 1, False)
    assert r[("dim_loan", "range", "interest_rate")] == (1, 2, False)
    assert r[("fact_transaction", "referential", "account_id")] == (0, 1, True)
    assert r[("dim_loan", "referential", "customer_id")] == (0, 2, True)
    assert r[("fact_deposit", "referential", "account_id")] == (0, 1, True)
    with pytest.raises(DataQualityError) as e:
        quality.enforce(report)
    assert len(e.value.rows) == 5


def test_aggregates_of_a_table(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None)], "k string, v double")
    rules = TableRules("t", not_null=("k", "v"), unique=("k", "v"),
                       ranges=(ValueRange("v", 0, 1),))
    parts = quality.table_checks(df, rules)
    # one aggregate per unique column, one for all the other rules
    assert [p.count() for p in parts] == [1, 1, 3]
    assert all("Expand" not in p._jdf.queryExecution().executedPlan().toString() for p in parts)


def test_self_reference_in_suite(spark):
    df = spark.createDataFrame([("e1", None), ("e2", "e1"), ("e3", "e9")], "id string, boss string")
    suite = (TableRules("emp", unique=("id",), foreign_keys=(ForeignKey("boss", "emp", "id"),)),)
    r = rows(quality.run_rules({"emp": df}, suite))
    assert r[("emp", "referential", "boss")] == (2, 3, False)
    assert r[("emp", "unique", "id")] == (0, 3, True)
