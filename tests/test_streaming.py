"""Streaming: envelope decode, running totals, the idempotent ledger
(replay of a batch after a crash), bad events, windows, dedupe,
stream-static orphan filter, stream = batch."""

import base64
import datetime as dt
import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators.cleaning import drop_orphans
from ledgerlake.schemas import ENVELOPE, TRANSACTIONS
from ledgerlake.streaming import parse, totals, windows


def envelope(cat, amount, txn_id="t", ts="2026-01-01T00:00:00+00:00"):
    ev = {"txn_id": txn_id, "account_id": "a1", "amount": amount, "category": cat, "txn_ts": ts}
    return base64.b64encode(json.dumps(ev).encode()).decode()


def write_batch_file(spark, folder, datas):
    """One parquet file per call, written in call order (stream order)."""
    spark.createDataFrame([(d,) for d in datas], ENVELOPE).coalesce(1).write.mode(
        "append").parquet(folder)
    time.sleep(0.05)


def fixture_stream(spark, folder):
    write_batch_file(spark, folder, [envelope("rent", 1.0, "t1"), envelope("rent", 1.0, "t2"),
                                     envelope("dining", -2.5, "t3")])
    write_batch_file(spark, folder, [envelope("rent", 4.0, "t4")])


def view(ledger, spark):
    return {r.category: (r.running_total, r.txn_count, r.batch_count)
            for r in ledger.view(spark).collect()}


def test_ledger_fixture_and_replay(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    fixture_stream(spark, src)
    ledger = totals.CategoryLedger(f"{tmp_dir}/ledger")
    ck = f"{tmp_dir}/ck"

    def run():
        stream = parse.decode_events(parse.read_envelopes(spark, src, max_files_per_trigger=1))
        ledger.start(stream, ck).awaitTermination()

    run()
    want = {"rent": (6.0, 3, 2), "dining": (-2.5, 1, 1)}
    assert view(ledger, spark) == want
    # Crash after the sink wrote batch 1 but before the commit was logged:
    # the restarted query runs batch 1 again; the ledger must not change.
    os.remove(f"{ck}/commits/1")
    for crc in glob.glob(f"{ck}/commits/.1.crc"):
        os.remove(crc)
    run()
    assert view(ledger, spark) == want


def test_bad_events_go_to_quarantine(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    fixture_stream(spark, src)
    no_cat = base64.b64encode(json.dumps({"txn_id": "t9", "amount": 3.0}).encode()).decode()
    write_batch_file(spark, src, ["%%%not-base64", no_cat,
                                  base64.b64encode(b"{oops").decode()])
    ledger = totals.CategoryLedger(f"{tmp_dir}/ledger")
    stream = parse.decode_events(parse.read_envelopes(spark, src, max_files_per_trigger=1))
    ledger.start(stream, f"{tmp_dir}/ck").awaitTermination()
    assert view(ledger, spark) == {"rent": (6.0, 3, 2), "dining": (-2.5, 1, 1)}
    reasons = sorted(r.reason for r in ledger.quarantine(spark).collect())
    assert reasons == ["bad_envelope", "bad_envelope", "missing_field"]


def test_state_store_running_totals(spark, tmp_dir):
    src = f"{tmp_dir}/in"
    fixture_stream(spark, src)
    stream = parse.good_events(parse.decode_events(
        parse.read_envelopes(spark, src, max_files_per_trigger=1)))
    totals.start_running_totals(stream, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {r.category: (r.running_total, r.txn_count)
           for r in totals.latest_totals(spark, f"{tmp_dir}/out").collect()}
    assert got == {"rent": (6.0, 3), "dining": (-2.5, 1)}
    # batch 1 only touched rent (update mode emits changed groups only)
    b1 = spark.read.parquet(f"{tmp_dir}/out/batch_id=1").collect()
    assert [(r.category, r.running_total, r.txn_count) for r in b1] == [("rent", 6.0, 3)]


def _typed_stream(spark, folder, rows):
    spark.createDataFrame(rows, TRANSACTIONS).write.mode("append").parquet(folder)
    s = spark.readStream.schema(TRANSACTIONS).parquet(folder)
    return s.withColumn("txn_ts", F.to_timestamp("txn_ts"))


def test_windowed_totals(spark, tmp_dir):
    rows = [("t1", "a", 1.0, "rent", "2026-01-01T01:00:00"),
            ("t2", "a", 2.0, "rent", "2026-01-01T23:00:00"),
            ("t3", "a", 5.0, "rent", "2026-01-02T00:00:00"),
            ("t4", "a", 7.0, "food", "2026-01-02T10:00:00")]
    s = _typed_stream(spark, f"{tmp_dir}/in", rows)
    windows.start_windowed_totals(s, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    got = {(r.window_start.date(), r.category): (r.total, r.txn_count)
           for r in windows.latest_windows(spark, f"{tmp_dir}/out").collect()}
    d1, d2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    assert got == {(d1, "rent"): (3.0, 2), (d2, "rent"): (5.0, 1), (d2, "food"): (7.0, 1)}


def test_dedupe_within_watermark_and_orphans(spark, tmp_dir):
    rows = [("t1", "a1", 1.0, "rent", "2026-01-01T01:00:00"),
            ("t1", "a1", 1.0, "rent", "2026-01-01T01:00:05"),
            ("t2", "a9", 2.0, "rent", "2026-01-01T02:00:00")]
    s = _typed_stream(spark, f"{tmp_dir}/in", rows)
    accounts = spark.createDataFrame([("a1",)], "account_id string")
    out = drop_orphans(windows.dedupe_within_watermark(s), accounts)
    q = (out.writeStream.format("parquet").option("path", f"{tmp_dir}/out")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert [(r.txn_id, r.account_id) for r in got] == [("t1", "a1")]


def test_dedupe_of_copies_in_later_batches(spark, tmp_dir):
    """The copy comes a batch later: only the state between batches knows
    the first."""
    first = [(f"t{i}", "a1", 1.0, "rent", "2026-01-01T01:00:00") for i in range(6)]
    later = first[::2] + [("t9", "a1", 1.0, "rent", "2026-01-01T01:30:00")]
    for rows in (first, later):
        spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(
            f"{tmp_dir}/in")
        time.sleep(0.05)
    s = (spark.readStream.schema(TRANSACTIONS).option("maxFilesPerTrigger", 1)
         .parquet(f"{tmp_dir}/in").withColumn("txn_ts", F.to_timestamp("txn_ts")))
    q = (windows.dedupe_within_watermark(s).writeStream.format("parquet")
         .option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted(r.txn_id for r in spark.read.parquet(f"{tmp_dir}/out").collect())
    assert got == ["t0", "t1", "t2", "t3", "t4", "t5", "t9"]
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [6, 4]


def test_stream_equals_batch(spark, tmp_dir):
    import random
    rnd = random.Random(5)
    rows = [(f"t{i}", f"a{i % 9}", round(rnd.uniform(-50, 50), 2), rnd.choice("abcd"),
             "2026-01-01T00:00:00") for i in range(300)]
    for i in range(0, 300, 100):
        spark.createDataFrame(rows[i:i + 100], TRANSACTIONS).coalesce(1).write.mode(
            "append").parquet(f"{tmp_dir}/in")
    s = spark.readStream.schema(TRANSACTIONS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
    totals.start_running_totals(s, f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    stream = {r.category: (round(r.running_total, 6), r.txn_count)
              for r in totals.latest_totals(spark, f"{tmp_dir}/out").collect()}
    batch = {r.category: (round(r.running_total, 6), r.txn_count)
             for r in totals.category_totals(spark.createDataFrame(rows, TRANSACTIONS)).collect()}
    assert stream == batch


def test_late_event_beyond_watermark_is_dropped(spark, tmp_dir):
    """Watermark 1 day. Batch 0 sees Jan 1 and Jan 5; batch 1 (watermark
    Jan 4) evicts the Jan 1 window; batch 2 brings a Jan 1 event, which is
    dropped. (Spark's guarantee is one-sided: a late row that arrives
    before its window is evicted may still be counted.)"""
    src = f"{tmp_dir}/in"
    batches = [[("t1", "a", 1.0, "rent", "2026-01-01T01:00:00"),
                ("t2", "a", 2.0, "rent", "2026-01-05T01:00:00")],
               [("t4", "a", 8.0, "rent", "2026-01-05T02:00:00")],
               [("t3", "a", 4.0, "rent", "2026-01-01T02:00:00")]]
    for rows in batches:
        spark.createDataFrame(rows, TRANSACTIONS).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.0)
    s = (spark.readStream.schema(TRANSACTIONS).option("maxFilesPerTrigger", 1).parquet(src)
         .withColumn("txn_ts", F.to_timestamp("txn_ts")))
    q = windows.start_windowed_totals(s, f"{tmp_dir}/out", f"{tmp_dir}/ck", delay="1 day")
    q.awaitTermination()
    got = {r.window_start.date(): (r.total, r.txn_count)
           for r in windows.latest_windows(spark, f"{tmp_dir}/out").collect()}
    assert got == {dt.date(2026, 1, 1): (1.0, 1), dt.date(2026, 1, 5): (10.0, 2)}
    dropped = sum(o.get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress for o in p["stateOperators"])
    assert dropped == 1


def test_ledger_compaction(spark, tmp_dir):
    ledger = totals.CategoryLedger(f"{tmp_dir}/ledger", fanout=2)
    want = {}
    for i in range(13):
        batch = spark.createDataFrame(
            [("rent", float(i), None), ("dining", 1.0, None), ("x", None, f"bad {i}")][i % 2:],
            "category string, amount double, reason string")
        sums = batch.where("reason is null")
        ledger.store.write(totals._ledger_rows(
            sums, totals.SUM, category=F.col("category"), total=F.col("amount"),
            n=F.lit(1).cast("long"), batches=F.lit(1).cast("long")).unionByName(
            totals._ledger_rows(batch.where("reason is not null"), totals.BAD,
                                reason=F.col("reason"), data=F.lit("d"))), i)
        for r in sums.collect():
            t, n, b = want.get(r.category, (0.0, 0, 0))
            want[r.category] = (t + r.amount, n + 1, b + 1)
        if i % 5 == 4:
            assert ledger.compact(spark) > 0
            if i == 4:
                ledger.vacuum(spark)
        assert view(ledger, spark) == want
    # batches 0 to 8 are folded: 8 + 1 - or 4 + 4 + ..., and the rest
    assert ledger.store.folders(spark) <= 8
    assert sorted(r.reason for r in ledger.quarantine(spark).collect()) == sorted(
        f"bad {i}" for i in range(13))
    assert sorted(tuple(r) for r in ledger.batch_summary(spark).collect()) == [
        (i, 2 - i % 2, 2 - i % 2) for i in range(13)]
    # a folded batch that is written again is not read again
    ledger.store.write(ledger.entries(spark).where("false").drop("batch_id"), 2)
    assert view(ledger, spark) == want


def test_fold_that_dies_changes_nothing(spark, tmp_dir):
    ledger = totals.CategoryLedger(f"{tmp_dir}/ledger", fanout=2)
    for i in range(4):
        ledger.store.write(totals._ledger_rows(
            spark.range(1), totals.SUM, category=F.lit("rent"), total=F.lit(1.0),
            n=F.lit(1).cast("long"), batches=F.lit(1).cast("long")), i)
    merge, ledger.store.merge = ledger.store.merge, lambda rows: 1 / 0
    with pytest.raises(ZeroDivisionError):
        ledger.compact(spark)
    # dies after writing its run, before the manifest
    ledger.store.merge = merge
    ledger.store._written(ledger.entries(spark), 1, 0, 1)
    assert view(ledger, spark) == {"rent": (4.0, 4, 4)}
    assert ledger.compact(spark) == 1 and view(ledger, spark) == {"rent": (4.0, 4, 4)}
    assert ledger.vacuum(spark) == 3  # two batches and the dead run
    assert view(ledger, spark) == {"rent": (4.0, 4, 4)}


def test_processing_time_trigger(spark, tmp_dir):
    """Live mode: a processing-time trigger, drained with
    processAllAvailable, then stopped; same ledger as availableNow."""
    src = f"{tmp_dir}/in"
    fixture_stream(spark, src)
    ledger = totals.CategoryLedger(f"{tmp_dir}/ledger")
    stream = parse.decode_events(parse.read_envelopes(spark, src, max_files_per_trigger=1))
    q = ledger.start(stream, f"{tmp_dir}/ck", trigger="1 second", name="ledger_live_test")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert view(ledger, spark) == {"rent": (6.0, 3, 2), "dining": (-2.5, 1, 1)}
