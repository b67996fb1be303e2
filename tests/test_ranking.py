"""Row numbering over range partitions, compared with a plain window."""

import random

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.operators import ranking
from ledgerlake.operators.ranking import keep_first, number_within
from ledgerlake.operators.sequence import build_fact_transaction


def skewed(spark, n=2000, seed=3):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        # one key holds about a third of all rows; one NULL key is hot too
        k = "hot" if i % 3 == 0 else (None if i % 11 == 0 else f"k{rnd.randint(0, 60)}")
        data.append((k, rnd.randint(0, 50), f"id{i:05d}", rnd.random()))
    return spark.createDataFrame(data, "k string, ts int, id string, v double").repartition(5)


def brute(df):
    w = Window.partitionBy("k").orderBy("ts", "id")
    return {(r.k, r.id): r.rn for r in df.withColumn("rn", F.row_number().over(w)).collect()}


def test_numbering_equals_plain_window(spark):
    df = skewed(spark)
    got = number_within(df, "k", ["ts", "id"], "rn")
    assert got.count() == df.count()
    assert {(r.k, r.id): r.rn for r in got.collect()} == brute(df)


def test_keep_first_plan_limits_before_shuffle(spark):
    df = skewed(spark)
    first = keep_first(df, "k", ["ts", "id"])
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    want = {k: i for (k, i), rn in brute(df).items() if rn == 1}
    assert {r.k: r.id for r in first.collect()} == want


def test_fact_sequence_on_driver_data(spark):
    from ledgerlake.operators.cleaning import clean_transactions
    from ledgerlake.sources import tables
    clean = clean_transactions(tables.transactions(spark, "/root/testdata/sf0.01"))
    w = Window.partitionBy("account_id").orderBy("txn_ts", "txn_id")
    plain = clean.withColumn("txn_seq_in_account", F.row_number().over(w))
    pick = lambda d: sorted((r.txn_id, r.txn_seq_in_account) for r in d.collect())
    assert pick(build_fact_transaction(clean)) == pick(plain)


def test_rows_are_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(v):
        seen.add(1)
        return v
    df = skewed(spark).withColumn("v", counted("v"))
    got = number_within(df, "k", ["ts", "id"], "rn")
    got.write.format("noop").mode("overwrite").save()
    assert seen.value == 2000


def test_large_keys_are_split_and_the_others_are_not(spark, monkeypatch):
    df = skewed(spark)
    want = brute(df)
    for large in (0, 30, 200, 5000):
        monkeypatch.setattr(ranking, "LARGE", large)
        got = number_within(df, "k", ["ts", "id"], "rn")
        assert got.columns == [*df.columns, "rn"] and got.schema["rn"].dataType.typeName() == "integer"
        assert {(r.k, r.id): r.rn for r in got.collect()} == want
        sizes = df.groupBy("k").agg(F.count("*").alias("_n"))
        given = number_within(df, "k", ["ts", "id"], "rn", sizes.where(F.col("_n") > 20))
        assert {(r.k, r.id): r.rn for r in given.collect()} == want
