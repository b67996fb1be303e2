"""Row numbering inside a group under a total order, safe for hot groups.

* ``keep_first`` – one survivor per key (``row_number() = 1``). Spark plans
  this with a *partial* ``WindowGroupLimit`` before the shuffle, so each map
  task forwards at most one row per key: a key that holds a third of all
  rows costs no more than any other.

* ``number_within`` – the full ``row_number()`` per key. Rows are staged
  and counted by key; a key of at most LARGE rows is numbered by a plain
  window over its hash partition. The few larger keys are not left to one
  task each:

  1. range-partition their rows on ``(key, order)`` and stage them; Spark's
     range partitioner splits a large key over many partitions in order;
  2. number the rows inside each (key, partition);
  3. only keys that cross a partition border need an offset. A border key
     is the last of one partition and the first of the next, so there are
     fewer of them than partitions; their row counts per partition, summed
     up in partition order, are the offsets.

  Both staged copies serve a purpose: the first is read for the counts, the
  window and the sample that sets the range bounds, so that what leads to
  the rows runs once; the second fixes the placement, as a second evaluation
  could place rows differently. Callers that know the keys' sizes pass them
  and save the first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.session import staged


def _cols(xs) -> list[str]:
    return [xs] if isinstance(xs, str) else list(xs)


def order_columns(order) -> list[Column]:
    """Order spec → ascending columns, nulls first (Spark's default and
    what ``ORDER BY x`` means in the SQL oracles). A ``Column`` is kept as
    given, so callers may pass ``F.col(x).desc()``."""
    return [F.col(o).asc_nulls_first() if isinstance(o, str) else o for o in order]


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first under ``order`` (make it total for a
    deterministic survivor). NULL keys form one group, as in
    ``dropDuplicates``."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order_columns(order))
    return (df.withColumn("_rn", F.row_number().over(w))
            .filter(F.col("_rn") == 1).drop("_rn"))


# Rows of a key that one task sorts and numbers.
LARGE = 1 << 20


def _same(keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys])


def number_within(df: DataFrame, keys, order, out: str, sizes: DataFrame | None = None) -> DataFrame:
    """Add ``out`` = ``row_number()`` within ``keys`` under ``order``.
    ``sizes``: the keys with their rows or more (``_n``), at least of those
    with more than LARGE; taken from the rows if not given."""
    keys = _cols(keys)
    ordering = order_columns(order)
    if sizes is None:
        df = staged(df, "numbered")
        sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    large = staged(sizes.where(F.col("_n") > LARGE)
                   .select(*[F.col(k).alias(f"_b_{k}") for k in keys]), "large-keys")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering)).alias(out)
    if large.isEmpty():
        return df.select(*df.columns, number)
    few, same = F.broadcast(large), _same(keys)
    return df.join(few, same, "left_anti").select(*df.columns, number).unionByName(
        _number_large(df.join(few, same, "left_semi"), keys, ordering, out))


def _number_large(df: DataFrame, keys: list[str], ordering: list[Column], out: str) -> DataFrame:
    """``number_within`` for keys that no single task should hold."""
    by_key = [F.col(k).asc_nulls_first() for k in keys]
    placed = staged(df.repartitionByRange(*by_key, *ordering)
                    .withColumn("_pid", F.spark_partition_id()), "placed")
    within = Window.partitionBy(*keys, "_pid").orderBy(*ordering)
    ranked = placed.withColumn("_rn", F.row_number().over(within))

    key = F.struct(*keys)
    ends = placed.groupBy("_pid").agg(F.min(key).alias("_lo"), F.max(key).alias("_hi"))
    border = (ends.select("_pid", F.explode(F.array("_lo", "_hi")).alias("_k")).distinct()
              .groupBy("_k").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
              .select(*[F.col(f"_k.{k}").alias(f"_b_{k}") for k in keys]))
    same = _same(keys)
    blocks = (placed.select(*keys, "_pid").join(border, same, "left_semi")
              .groupBy(*keys, "_pid").agg(F.count(F.lit(1)).alias("_n")))
    before = (Window.partitionBy(*keys).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = blocks.select(*[F.col(k).alias(f"_b_{k}") for k in keys],
                            F.col("_pid").alias("_b_pid"), F.sum("_n").over(before).alias("_before"))
    return (ranked.join(offsets, same & (F.col("_pid") == F.col("_b_pid")), "left")
            .select(*df.columns, (F.col("_rn") + F.coalesce("_before", F.lit(0)))
                    .cast("int").alias(out)))
