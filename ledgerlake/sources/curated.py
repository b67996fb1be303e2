"""Reads of the curated layer with date-partition pruning.

A filter on the partition column becomes ``PartitionFilters`` in the scan:
only the matching ``txn_date=...`` folders are read. A path read lists all
folders first; a catalog table lists only the partitions the filter leaves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_date_slice(spark: SparkSession, path: str, date_from, date_to, *,
                    partition_col: str = "txn_date", schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    return df.filter(F.col(partition_col).between(F.lit(date_from).cast("date"),
                                                  F.lit(date_to).cast("date")))


def month_slice(table: DataFrame, date_from: str, date_to: str, month_col: str,
                date_col: str = "txn_date") -> DataFrame:
    """Days of a table partitioned by month (``yyyy-MM``). The months follow
    from the days, so the catalog is asked for those alone."""
    day = F.col(date_col).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    return table.where(F.col(month_col).between(date_from[:7], date_to[:7]) & day)
