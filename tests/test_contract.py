"""Driver contract: entry() smoke, every query against its DuckDB oracle
at sf0.001 (the partitioned-write query is covered in test_etl)."""

import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as contract  # noqa: E402
from oracle_check import rows_of  # noqa: E402

from ledgerlake.plans import catalog  # noqa: E402
from ledgerlake.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
SLOW = {"curated_date_slice"}


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert "txn_seq_in_account" in df.columns


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - SLOW))
def test_query_matches_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(contract.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, want)


def test_stream_source_reads_a_folder_of_files(spark, tmp_dir):
    """At scale a table is a folder of part files."""
    spark.read.parquet(f"{SF}/events.parquet").repartition(3).write.parquet(
        f"{tmp_dir}/events.parquet")
    want = rows_of(["category", "running_total", "txn_count"], [
        tuple(r) for r in catalog.q_category_totals_batch(spark, SF).collect()])
    got = [tuple(r) for r in catalog.q_category_totals_stream(spark, tmp_dir).collect()]
    assert rows_of(["category", "running_total", "txn_count"], got) == want
