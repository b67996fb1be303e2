"""Consumption queries over the star schema (fixtures)."""

from ledgerlake.operators import star
from ledgerlake.streaming import totals


def test_spend_by_segment_and_daily(spark):
    fact = spark.createDataFrame(
        [("t1", "a1", -10.0, "rent", "2026-01-01"), ("t2", "a2", 5.0, "rent", "2026-01-01"),
         ("t3", "a1", 2.5, "food", "2026-01-02"), ("t4", "a3", 1.0, "food", "2026-01-02")],
        "txn_id string, account_id string, amount double, category string, txn_date string")
    acct = spark.createDataFrame([("a1", "c1"), ("a2", "c2"), ("a3", "c9")],
                                 "account_id string, customer_id string")
    cust = spark.createDataFrame([("c1", "retail"), ("c2", "premium")],
                                 "customer_id string, segment string")
    got = {(r.segment, r.category): (r.total_amount, r.txn_count)
           for r in star.spend_by_segment(fact, acct, cust).collect()}
    assert got == {("retail", "rent"): (-10.0, 1), ("premium", "rent"): (5.0, 1),
                   ("retail", "food"): (2.5, 1)}
    daily = {(r.txn_date, r.category): r.txn_count for r in star.daily_spend(fact).collect()}
    assert daily == {("2026-01-01", "rent"): 2, ("2026-01-02", "food"): 2}


def test_deposits_and_loan_book(spark):
    dep = spark.createDataFrame([("d1", "a1", 100.0, None), ("d2", "a1", 50.0, None),
                                 ("d3", "a2", 7.0, None)],
                                "deposit_id string, account_id string, amount double, value_date date")
    acct = spark.createDataFrame([("a1", "c1"), ("a2", "c2")], "account_id string, customer_id string")
    got = {r.customer_id: (r.deposit_count, r.deposit_total)
           for r in star.deposits_per_customer(dep, acct).collect()}
    assert got == {"c1": (2, 150.0), "c2": (1, 7.0)}
    loans = spark.createDataFrame([("current", 1000.0, 4.0), ("current", 500.0, 6.0),
                                   ("default", 10.0, 30.0)],
                                  "status string, principal double, interest_rate double")
    book = {r.status: (r.loan_count, r.principal_total, r.avg_interest_rate)
            for r in star.loan_book_by_status(loans).collect()}
    assert book == {"current": (2, 1500.0, 5.0), "default": (1, 10.0, 30.0)}


def test_observed_batch_metrics(spark, tmp_dir):
    from ledgerlake.schemas import TRANSACTIONS
    spark.createDataFrame([("t1", "a", 1.5, "x", None), ("t2", "a", 2.0, "y", None)],
                          TRANSACTIONS).write.parquet(f"{tmp_dir}/in")
    s = spark.readStream.schema(TRANSACTIONS).parquet(f"{tmp_dir}/in")
    q = totals.start_running_totals(totals.with_batch_metrics(s), f"{tmp_dir}/out",
                                    f"{tmp_dir}/ck")
    q.awaitTermination()
    m = [p["observedMetrics"]["batch"] for p in q.recentProgress if p.get("observedMetrics")]
    assert m and m[0]["records"] == 2 and m[0]["amount_sum"] == 3.5
