"""Publishing sets of tables, small files, catalog loads."""

import re

import pytest
from pyspark.sql import functions as F

from ledgerlake import storage
from ledgerlake.operators.quality import TableRules
from ledgerlake.plans.etl import run_etl
from ledgerlake.sinks import writers
from ledgerlake.sinks.versions import PublishConflict, Snapshot, VersionedWriter
from ledgerlake.sources import curated


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v long")


def values(snapshot, name):
    return sorted(r.v for r in snapshot.read(name).collect())


def test_a_file_is_created_once(spark, tmp_dir):
    path = f"{tmp_dir}/a/b"
    assert storage.names(spark, f"{tmp_dir}/a") == []
    assert storage.create_text(spark, path, "é1")
    assert not storage.create_text(spark, path, "2")
    assert storage.read_text(spark, path) == "é1"
    assert storage.names(spark, f"{tmp_dir}/a") == ["b"]


def test_a_set_switches_whole_or_not_at_all(spark, tmp_dir):
    writer = VersionedWriter(f"{tmp_dir}/set")
    assert Snapshot.latest(spark, writer.root).tables == {}
    with writer.publish(spark) as pub:
        for name, v in (("a", 1), ("b", 2)):
            pub.write(table(spark, v), name)
        assert Snapshot.latest(spark, writer.root).tables == {}
    with pytest.raises(ZeroDivisionError), writer.publish(spark) as pub:
        pub.write(table(spark, 10), "a")
        raise ZeroDivisionError
    now = Snapshot.latest(spark, writer.root)
    assert (now.version, values(now, "a"), values(now, "b")) == (1, [1], [2])
    # b keeps its files when only a is reloaded
    with writer.publish(spark) as pub:
        pub.write(table(spark, 11), "a")
    new = Snapshot.latest(spark, writer.root)
    assert values(new, "a") == [11] and new.tables["b"] == now.tables["b"]
    assert values(now, "a") == [1]  # a reader of the old set is not disturbed
    writer.rollback(spark, 1)
    assert values(Snapshot.latest(spark, writer.root), "a") == [1]
    gone = writer.vacuum(spark, keep=1)
    assert len(gone) == 2  # of the failed and of the second publication
    assert values(Snapshot.latest(spark, writer.root), "b") == [2]


def test_the_second_of_two_publications_fails(spark, tmp_dir):
    writer = VersionedWriter(f"{tmp_dir}/set")
    first, second = writer.publish(spark), writer.publish(spark)
    with first:
        first.write(table(spark, 1), "a")
    with pytest.raises(PublishConflict), second:
        second.write(table(spark, 2), "a")
    assert values(Snapshot.latest(spark, writer.root), "a") == [1]


def test_partitioned_tables_and_views(spark, tmp_dir):
    writer = VersionedWriter(f"{tmp_dir}/set")
    df = spark.createDataFrame([("1998-01-01", 1), ("1998-01-02", 2)], "d string, v long").select(
        F.col("d").cast("date").alias("d"), "v")
    with writer.publish(spark) as pub:
        back = pub.write(df, "t", "d")
        assert back.columns == ["d", "v"] and back.where("d = '1998-01-02'").first().v == 2
    Snapshot.latest(spark, writer.root).as_views("views_of_sets")
    assert spark.table("views_of_sets.t").agg(F.sum("v")).first()[0] == 3
    with writer.publish(spark) as pub:
        pub.write(df.where("v = 1"), "t", "d")
    Snapshot.latest(spark, writer.root).as_views("views_of_sets")
    assert spark.table("views_of_sets.t").agg(F.sum("v")).first()[0] == 1


def test_a_failed_gate_publishes_the_report_alone(spark, tmp_dir):
    raw = {"customers": spark.createDataFrame(
               [(1, "n", "e", "s", "2020-01-01", "c")],
               "customer_id long, full_name string, email string, segment string, "
               "onboarded_date string, country string"),
           "accounts": spark.createDataFrame(
               [(1, 1, "t", 1.0, "2020-01-01")],
               "account_id long, customer_id long, account_type string, balance double, "
               "opened_date string"),
           "transactions": spark.createDataFrame(
               [("a", 1, 1.0, "c", "2020-01-02 00:00:00"), ("b", 9, 1.0, "c", "2020-01-03 00:00:00")],
               "txn_id string, account_id long, amount double, category string, txn_ts string")}
    writer = VersionedWriter(f"{tmp_dir}/etl")
    rules = (TableRules("dim_account", unique=("account_id",)),)
    assert run_etl(spark, raw, writer, rules=rules).passed
    before = Snapshot.latest(spark, writer.root)
    assert before.read("fact_transaction").count() == 2
    more = {**raw, "transactions": raw["transactions"].limit(1)}
    bad = (TableRules("fact_transaction", not_null=("txn_id",), unique=("account_id", "category")),
           TableRules("dim_account", not_null=("opened_date",)),)
    broken = {**more, "accounts": raw["accounts"].withColumn("opened_date", F.lit(None).cast("string"))}
    result = run_etl(spark, broken, writer, rules=bad)
    assert not result.passed and set(result.published) == {"dq_report", "quarantine_transaction"}
    now = Snapshot.latest(spark, writer.root)
    assert now.version == 2 and now.tables["fact_transaction"] == before.tables["fact_transaction"]
    assert now.read("dq_report").where("not passed").count() == 1


def scanned_folders(df):
    """Folders that the scan was given to list files of."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return int(re.search(r"InMemoryFileIndex\((\d+) paths?\)", plan).group(1))


def test_only_the_months_of_a_slice_are_listed(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS monthly")
    days = spark.sql("SELECT explode(sequence(date'2020-01-01', date'2021-12-31')) AS txn_date") \
        .withColumn("m", F.date_format("txn_date", "yyyy-MM"))
    writers.create_partitioned(spark, "monthly.t", days.schema, f"{tmp_dir}/t", "m")
    writers.replace_partitions(days.where("m < '2021-02'"), "monthly.t", "m", "txn_date")
    writers.replace_partitions(days.where("m >= '2021-01'"), "monthly.t", "m", "txn_date")
    assert len(writers.known_partitions(spark, "monthly.t")) == 24
    assert spark.table("monthly.t").count() == 731
    part = curated.month_slice(spark.table("monthly.t"), "2020-11-15", "2021-01-10", "m")
    assert part.count() == 16 + 31 + 10
    assert scanned_folders(part) == 3


def test_new_partitions_are_registered_alone(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS monthly")
    rows = spark.range(6).select("id", F.concat(F.lit("p"), F.col("id") % 3).alias("p"))
    writer = writers.ParquetWriter(tmp_dir, dynamic=True)
    location = writer.write(rows.where("p < 'p2'"), "r", "p")
    writers.create_partitioned(spark, "monthly.r", rows.schema, location, "p")
    assert spark.table("monthly.r").count() == 0
    assert writers.register_new_partitions(spark, "monthly.r", location, "p") == ["p=p0", "p=p1"]
    writer.write(rows.where("p = 'p2'"), "r", "p")
    assert spark.table("monthly.r").count() == 4
    assert writers.register_new_partitions(spark, "monthly.r", location, "p", 1) == ["p=p2"]
    assert writers.register_new_partitions(spark, "monthly.r", location, "p") == []
    assert spark.table("monthly.r").count() == 6
