"""Fail-fast forms."""

import pytest

from ledgerlake import compat
from ledgerlake.compat import DataQualityError


def test_run_all_checks_fail_fast_order(spark):
    cust = spark.createDataFrame([("c1", "A")], "customer_id string, full_name string")
    acct = spark.createDataFrame([("a1", "c9"), ("a1", "c1")], "account_id string, customer_id string")
    fact = spark.createDataFrame([("t1", "a1", 1.0)], "txn_id string, account_id string, amount double")
    loans = spark.createDataFrame([(99.0,)], "interest_rate double")
    # dim_account fails unique and referential; unique comes first in the suite
    with pytest.raises(DataQualityError, match="'account_id' is not unique: 2 rows vs 1"):
        compat.run_all_checks(cust, acct, fact, loans)
    acct_ok = spark.createDataFrame([("a1", "c1")], "account_id string, customer_id string")
    with pytest.raises(DataQualityError, match=r"\[dim_loan\] column 'interest_rate' has 1 values"):
        compat.run_all_checks(cust, acct_ok, fact, loans)
    compat.run_all_checks(cust, acct_ok, fact, spark.createDataFrame([(3.0,)], "interest_rate double"))


def test_aggregate_batch(spark):
    ev = spark.createDataFrame([("rent", 1.0), ("rent", 1.0), ("dining", -2.5)],
                               "category string, amount double")
    got = {r.category: (r.total, r.n, r["count"]) for r in compat.aggregate_batch(ev).collect()}
    assert got == {"rent": (2.0, 2, 1), "dining": (-2.5, 1, 1)}
