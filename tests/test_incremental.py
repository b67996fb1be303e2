"""Any split of the rows into loads gives the fact of one load."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerlake import storage
from ledgerlake.operators import cleaning, sequence
from ledgerlake.plans import incremental
from ledgerlake.plans.incremental import IncrementalFact
from ledgerlake.session import checkpoint_root

SCHEMA = "txn_id string, account_id long, amount double, category string, txn_ts timestamp"


def rows(seed, n=120):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        ts = dt.datetime(2024, 1, 1) + dt.timedelta(hours=rnd.randrange(24 * 150))
        out.append((f"t{rnd.randrange(n * 2 // 3)}", rnd.choice([1, 1, 1, 2, 3, 4, 5]),
                    float(rnd.randrange(5)), rnd.choice(["a", None]), ts))
    # an account whose only row moves away, one that ends earlier, bad rows
    out += [("m", 50, 1.0, "a", dt.datetime(2024, 5, 1)), (None, 1, 1.0, "a", dt.datetime(2024, 5, 1)),
            ("bad", 1, None, "a", dt.datetime(2024, 5, 1)), ("e1", 60, 1.0, "a", dt.datetime(2024, 1, 9)),
            ("e2", 60, 1.0, "a", dt.datetime(2024, 5, 9))]
    return out


# Earlier copies under other accounts: account 50 loses its only row, account
# 60 its last one.
MOVED = [("m", 51, 1.0, "a", dt.datetime(2024, 2, 1)), ("e2", 61, 1.0, "a", dt.datetime(2024, 3, 1))]
AFTER = [("n", 50, 1.0, "a", dt.datetime(2024, 4, 1)), ("e3", 60, 1.0, "a", dt.datetime(2024, 2, 1)),
         ("e4", 60, 1.0, "a", dt.datetime(2024, 6, 1))]


def sorted_rows(df):
    return sorted(map(repr, map(tuple, df.select(*incremental.COLUMNS).collect())))


def test_loads_in_any_split_equal_one(spark, tmp_dir):
    every = rows(1)
    random.Random(2).shuffle(every)
    parts = [every[:70], every[70:], MOVED, AFTER, every[::3]]
    fact = IncrementalFact(f"{tmp_dir}/fact")
    assert fact.read(spark) is None
    seen = []
    for i, part in enumerate(parts):
        seen += part
        written = fact.load(spark, spark.createDataFrame(part, SCHEMA))
        if i == 2:
            fact.tidy(spark)
        want = sequence.build_fact_transaction(
            cleaning.clean_transactions(spark.createDataFrame(seen, SCHEMA)))
        assert sorted_rows(fact.read(spark)) == sorted_rows(want)
    assert written == 0  # copies of what is there change nothing
    march = fact.read(spark, ["2024-03"])
    assert {r.txn_date.month for r in march.collect()} == {3}


def test_a_load_that_dies_is_run_again(spark, tmp_dir, monkeypatch):
    fact = IncrementalFact(f"{tmp_dir}/fact")
    fact.load(spark, spark.createDataFrame(rows(3, 30), SCHEMA))
    before = sorted_rows(fact.read(spark))
    more = spark.createDataFrame(MOVED + AFTER, SCHEMA)
    commit = incremental.Manifests.commit
    monkeypatch.setattr(incremental.Manifests, "commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        fact.load(spark, more)
    monkeypatch.setattr(incremental.Manifests, "commit", commit)
    assert sorted_rows(fact.read(spark)) == before
    fact.load(spark, more)
    fact.tidy(spark)
    want = sequence.build_fact_transaction(cleaning.clean_transactions(
        spark.createDataFrame(rows(3, 30) + MOVED + AFTER, SCHEMA)))
    assert sorted_rows(fact.read(spark)) == sorted_rows(want)


def test_a_load_computes_no_row_twice(spark, tmp_dir):
    """What a load numbers is staged; the accounts' ends are read from it."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(c):
        seen.add(1)
        return c
    fact = IncrementalFact(f"{tmp_dir}/fact")
    part = spark.createDataFrame(rows(5), SCHEMA)
    valid = part.dropna(subset=["txn_id", "account_id", "amount", "txn_ts"]).count()
    fact.load(spark, part.withColumn("category", counted("category")))
    assert seen.value <= valid + 2
    folders = [n.partition("-")[0] for n in storage.names(spark, f"{checkpoint_root(spark)}/ledgerlake")]
    before = folders.count("index")
    empty = IncrementalFact(f"{tmp_dir}/other")
    empty.load(spark, part)
    after = [n.partition("-")[0] for n in storage.names(spark, f"{checkpoint_root(spark)}/ledgerlake")]
    assert after.count("index") == before  # a first load looks for no copies
    assert sorted_rows(empty.read(spark)) == sorted_rows(fact.read(spark))
