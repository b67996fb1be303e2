"""Transaction cleaning as a split: kept rows and quarantined rows.

Order of the checks (first match wins, one reason per row):

1. ``corrupt_record``  the JSON line did not parse
2. ``null_key``        txn_id, account_id, amount or txn_ts is NULL (or NaN)
3. ``bad_amount``      amount is text that is not a number
4. ``bad_txn_ts``      txn_ts is text that is not a timestamp
5. ``duplicate``       another valid row with the same txn_id comes first
6. ``orphan``          account_id has no row in the accounts table

Null and bad rows leave before the dedupe, so a valid copy of a damaged
row always survives. The survivor of a duplicate group is the first under
a total order (txn_ts, amount, category, account_id, then every other
column), so reruns pick the same row.

Cost: the kept path is one shuffle by txn_id whose map side already keeps
only the first row per key (partial ``WindowGroupLimit``), so a hot txn_id
does not pile onto one task. ``clean_summary`` is one scan: per txn_id a
count and the first row's account, combined map-side. The quarantine reads
typed tables as they are, and stages the tagged rows of text input, so that
text is parsed once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions.columns import as_date, as_double, as_timestamp, is_missing
from ledgerlake.operators.ranking import keep_first, number_within
from ledgerlake.schemas import CORRUPT
from ledgerlake.session import staged

REQUIRED = ("txn_id", "account_id", "amount", "txn_ts")
TXN_COLUMNS = ("txn_id", "account_id", "amount", "category", "txn_ts")
REASONS = ("corrupt_record", "null_key", "bad_amount", "bad_txn_ts", "duplicate", "orphan")


def _text_typed(raw: DataFrame) -> list[str]:
    """Columns that arrive as text and are typed by cleaning."""
    return [c for c in ("amount", "txn_ts")
            if isinstance(raw.schema[c].dataType, T.StringType)]


def survivor_order(raw: DataFrame) -> list[str]:
    """Total order for picking the survivor among copies of one txn_id:
    typed txn_ts, amount, then category, account_id, the remaining raw
    columns, and finally the original text of typed columns (two texts of
    one instant, e.g. ``+02:00`` and ``Z``, must not tie)."""
    first = ["txn_ts", "amount", "category", "account_id"]
    rest = [c for c in raw.columns if c not in first and c != "txn_id" and not c.startswith("_")]
    return ([c for c in first if c in raw.columns] + rest
            + [f"_{c}_raw" for c in _text_typed(raw)])


def tag_rows(raw: DataFrame) -> DataFrame:
    """Raw columns unchanged, plus ``_amount``/``_txn_ts`` (typed) and
    ``_reason`` for the row-level checks 1–4 (NULL when the row is valid)."""
    df = raw.withColumns({"_amount": as_double(raw, "amount"),
                          "_txn_ts": as_timestamp(raw, "txn_ts")})
    reason = F.when(F.lit(False), F.lit(None))
    if CORRUPT in raw.columns:
        reason = reason.when(F.col(CORRUPT).isNotNull(), F.lit("corrupt_record"))
    missing = reduce(lambda a, b: a | b, [is_missing(raw, c) for c in REQUIRED])
    reason = (reason.when(missing, F.lit("null_key"))
              .when(F.col("_amount").isNull() | F.isnan(F.col("_amount")), F.lit("bad_amount"))
              .when(F.col("_txn_ts").isNull(), F.lit("bad_txn_ts")))
    return df.withColumn("_reason", reason.cast("string"))


def _valid_typed(raw: DataFrame) -> DataFrame:
    """Rows passing checks 1–4 in the raw layout, with amount/txn_ts typed.
    Columns that arrive as text keep their original value in
    ``_amount_raw``/``_txn_ts_raw`` (for the quarantine and as the last
    survivor tie-breaker); typed input needs no copy. The IS NOT NULL
    conjuncts are applied to the raw columns first, so they reach the
    Parquet scan as PushedFilters."""
    ok = [F.col(c).isNotNull() for c in REQUIRED]
    ok += [~is_missing(raw, c) for c in REQUIRED if isinstance(
        raw.schema[c].dataType, (T.DoubleType, T.FloatType))]
    if CORRUPT in raw.columns:
        ok.append(F.col(CORRUPT).isNull())
    df = raw.filter(reduce(lambda a, b: a & b, ok))
    text = _text_typed(raw)
    if text:
        df = df.withColumns({f"_{c}_raw": F.col(c) for c in text})
    df = df.withColumns({"amount": as_double(raw, "amount"),
                         "txn_ts": as_timestamp(raw, "txn_ts")})
    return df.filter(F.col("amount").isNotNull() & ~F.isnan(F.col("amount"))
                     & F.col("txn_ts").isNotNull())


def _survivors(raw: DataFrame) -> DataFrame:
    """One valid row per txn_id, raw layout (typed amount/txn_ts)."""
    return keep_first(_valid_typed(raw), "txn_id", survivor_order(raw))


def clean_transactions(raw: DataFrame) -> DataFrame:
    """Drop null/bad rows, keep one row per txn_id (deterministic), type
    amount and txn_ts, derive txn_date. Orphans are not removed here."""
    first = _survivors(raw)
    out = first.withColumn("txn_date", as_date(first, "txn_ts"))
    return out.select(*TXN_COLUMNS, "txn_date")


def _parent_keys(parent: DataFrame, key: str) -> DataFrame:
    # distinct(): each key once, combined map-side; the join that follows
    # needs the same hash partitioning, so it costs no extra shuffle.
    return (parent.select(F.col(key).alias("_pk")).filter(F.col("_pk").isNotNull())
            .distinct())


def drop_orphans(df: DataFrame, parent: DataFrame, key: str = "account_id",
                 parent_key: str | None = None) -> DataFrame:
    """Rows whose key exists in ``parent`` (left-semi join)."""
    keys = _parent_keys(parent, parent_key or key)
    return df.join(keys, df[key] == keys["_pk"], "left_semi")


def orphans_of(df: DataFrame, parent: DataFrame, key: str = "account_id",
               parent_key: str | None = None) -> DataFrame:
    """Rows whose key has no parent; a NULL key is an orphan too (as with a
    left-anti join). One pass: left join on the distinct parent keys with a
    match flag. Broadcast when the parent keys are small (Spark's size
    estimate, or AQE at runtime); otherwise a shuffled join whose skewed
    partitions – a hot key, or many NULL keys – AQE splits."""
    keys = _parent_keys(parent, parent_key or key).withColumn("_hit", F.lit(True))
    return (df.join(keys, df[key] == keys["_pk"], "left")
            .filter(F.col("_hit").isNull()).select(*df.columns))


def quarantine_transactions(raw: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Every rejected row once, exactly as read, with its ``reason``."""
    rows = tag_rows(raw)
    if _text_typed(raw):  # text is parsed once; typed tables are cheap to scan
        rows = staged(rows, "tagged")
    rejected = rows.filter(F.col("_reason").isNotNull())
    valid = rows.filter(F.col("_reason").isNull())
    order = _tagged_order(raw)
    # Ids seen more than once: an aggregate of the id column alone, combined
    # map-side. Only rows of those ids are numbered, where the join leaves
    # them.
    repeated = staged(valid.groupBy("txn_id").agg(F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") > 1), "repeated-ids")
    candidates = valid.join(repeated.select("txn_id"), "txn_id", "left_semi")
    dups = number_within(candidates, "txn_id", order, "_rn", repeated).filter(F.col("_rn") > 1)
    out = (rejected.select(*raw.columns, F.col("_reason").alias("reason"))
           .unionByName(dups.select(*raw.columns, F.lit("duplicate").alias("reason"))))
    if accounts is not None:
        orphan = orphans_of(keep_first(valid, "txn_id", order), accounts)
        out = out.unionByName(orphan.select(*raw.columns, F.lit("orphan").alias("reason")))
    return out


def _tagged_order(raw: DataFrame) -> list[str]:
    """``survivor_order`` in terms of ``tag_rows``: typed values first, the
    original text of typed columns last."""
    typed = {"amount": "_amount", "txn_ts": "_txn_ts"}
    text = _text_typed(raw)
    return ([typed.get(c, c) for c in survivor_order(raw) if not c.startswith("_")]
            + [c for c in ("amount", "txn_ts") if c in text])


def split_transactions(raw: DataFrame, accounts: DataFrame | None = None
                       ) -> tuple[DataFrame, DataFrame]:
    """(kept, quarantine). Kept rows are cleaned and, when ``accounts`` is
    given, restricted to known accounts."""
    kept = clean_transactions(raw)
    if accounts is not None:
        kept = drop_orphans(kept, accounts)
    return kept, quarantine_transactions(raw, accounts)


def clean_summary(raw: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Rows per outcome: ``kept`` plus one line per rejection reason seen
    (before/after/removed report). ``raw`` total = sum of the lines."""
    rows = tag_rows(raw)
    # Valid rows by id, rejected rows by reason: a count, and for an id the
    # account of the row that survives.
    by_id = rows.groupBy(
        F.when(F.col("_reason").isNull(), F.col("txn_id")).alias("_id"), "_reason").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min(F.struct(*_tagged_order(raw)))["account_id"].alias("account_id"))
    if accounts is None:
        by_id = by_id.withColumn("_hit", F.lit(True))
    else:
        keys = _parent_keys(accounts, "account_id").withColumn("_hit", F.lit(True))
        by_id = by_id.join(keys, F.col("account_id") == F.col("_pk"), "left")
    line = lambda outcome, n: F.struct(outcome.alias("outcome"),
                                       n.cast("long").alias("row_count"))
    lines = F.when(F.col("_reason").isNotNull(), F.array(line(F.col("_reason"), F.col("_n")))) \
        .otherwise(F.array(
            line(F.when(F.col("_hit"), F.lit("kept")).otherwise(F.lit("orphan")), F.lit(1)),
            line(F.lit("duplicate"), F.col("_n") - 1)))
    return (by_id.select(F.inline(lines)).filter("row_count > 0")
            .groupBy("outcome").agg(F.sum("row_count").alias("row_count")))


def removal_report(summary: DataFrame) -> DataFrame:
    """Before / after / removed, in the shape of the original dirty-data
    run: cleaning (nulls, bad values, duplicates) does not remove orphans,
    so ``clean_rows`` counts them; ``orphan_rows`` shows how many the
    referential step would still reject. Computed from ``clean_summary``
    (one tiny aggregate)."""
    n = lambda o: F.sum(F.when(F.col("outcome") == o, F.col("row_count")).otherwise(0))
    return summary.agg(
        F.sum("row_count").alias("raw_rows"),
        (n("kept") + n("orphan")).alias("clean_rows"),
        (F.sum("row_count") - n("kept") - n("orphan")).alias("removed_rows"),
        n("orphan").alias("orphan_rows"))
