"""Writers for curated tables: Parquet paths and catalog tables.

Partitioned writes carry a ``rebalance`` hint on the partition column: the
rows of one date come together, AQE sizes the write tasks and splits a date
that is too large for one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import storage
from ledgerlake.schemas import GLOSSARY


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments (kept by ``saveAsTable``)."""
    for name, text in comments.items():
        if name in df.columns:
            meta = dict(df.schema[name].metadata)
            meta["comment"] = text
            df = df.withMetadata(name, meta)
    return df


def _prepare(df: DataFrame, partition_col: str | None) -> DataFrame:
    return df.hint("rebalance", partition_col) if partition_col else df


@dataclass
class ParquetWriter:
    """Overwrite ``<root>/<table>`` as Parquet, optionally partitioned.

    ``dynamic=True`` replaces only the partitions present in the data
    (daily reloads); the default replaces the whole table.
    """

    root: str
    dynamic: bool = False

    def path(self, table_name: str) -> str:
        return f"{self.root.rstrip('/')}/{table_name}"

    def write(self, df: DataFrame, table_name: str, partition_col: str | None = None) -> str:
        w = _prepare(df, partition_col).write.mode("overwrite").format("parquet")
        if self.dynamic:
            w = w.option("partitionOverwriteMode", "dynamic")
        if partition_col:
            w = w.partitionBy(partition_col)
        path = self.path(table_name)
        w.save(path)
        return path

    def read(self, spark: SparkSession, table_name: str, schema=None) -> DataFrame:
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(self.path(table_name))


V2_FORMATS = ("iceberg", "delta")


@dataclass
class CatalogWriter:
    """Create-or-replace tables in a catalog database, with column comments
    from the glossary.

    File formats of the built-in catalog go through ``saveAsTable`` (the
    built-in catalog rejects ``writeTo(...).createOrReplace()``). Table
    formats with their own catalog (``fmt="iceberg"``/``"delta"``, jar
    supplied by the user; ``database`` may name the catalog, e.g.
    ``"lake.curated"``) use the DataFrameWriterV2 ``createOrReplace``,
    an atomic replace. That path needs the format's jar and is not
    exercised by the tests here.
    """

    database: str
    fmt: str = "parquet"
    comments: bool = True

    def ensure_database(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def name(self, table_name: str) -> str:
        return f"{self.database}.{table_name}"

    def write(self, df: DataFrame, table_name: str, partition_col: str | None = None) -> str:
        self.ensure_database(df.sparkSession)
        if self.comments:
            df = with_comments(df, GLOSSARY.get(table_name, {}))
        if self.fmt in V2_FORMATS:
            v2 = _prepare(df, partition_col).writeTo(self.name(table_name)).using(self.fmt)
            if partition_col:
                v2 = v2.partitionedBy(F.col(partition_col))
            v2.createOrReplace()
            return self.name(table_name)
        w = _prepare(df, partition_col).write.mode("overwrite").format(self.fmt)
        if partition_col:
            w = w.partitionBy(partition_col)
        w.saveAsTable(self.name(table_name))
        return self.name(table_name)

    def read(self, spark: SparkSession, table_name: str, schema=None) -> DataFrame:
        return spark.table(self.name(table_name))


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def register_location(spark: SparkSession, table: str, location: str, *,
                      fmt: str = "parquet", partitioned: bool = False) -> None:
    """Register files that already exist as a catalog table (schema read
    from the files) and discover their partitions."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{_quoted(location)}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table}")


def create_partitioned(spark: SparkSession, table: str, schema: T.StructType, location: str,
                       partition_col: str, *, fmt: str = "parquet") -> None:
    """An external table with a given schema (column comments included) and
    its partitions kept in the catalog; none are looked for."""
    columns = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        + (f" COMMENT '{_quoted(f.metadata['comment'])}'" if "comment" in f.metadata else "")
        for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt} "
              f"PARTITIONED BY (`{partition_col}`) LOCATION '{_quoted(location)}'")


def known_partitions(spark: SparkSession, table: str) -> set[str]:
    """``column=value`` of every registered partition."""
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def register_new_partitions(spark: SparkSession, table: str, location: str, partition_col: str,
                            at_once: int = 100) -> list[str]:
    """Add the partition folders that the catalog does not know yet; returns
    their names. One listing of the table's own folder and one call per
    ``at_once`` new partitions; known partitions are not looked at."""
    there = [n for n in storage.names(spark, location) if n.startswith(f"{partition_col}=")]
    new = sorted(set(there) - known_partitions(spark, table))
    for i in range(0, len(new), at_once):
        parts = " ".join(
            f"PARTITION (`{partition_col}`='{_quoted(n.partition('=')[2])}') "
            f"LOCATION '{_quoted(f'{location}/{n}')}'" for n in new[i:i + at_once])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    return new


def replace_partitions(df: DataFrame, table: str, partition_col: str, *sort: str) -> None:
    """Load ``df`` into a table of ``create_partitioned``: the partitions
    present in ``df`` are replaced or added, and registered by the same
    command; the others are neither read nor listed. Files are sorted by
    ``sort`` inside a partition, so filters on it skip row groups."""
    spark = df.sparkSession
    columns = [c for c in spark.table(table).columns]
    ready = _prepare(df, partition_col).sortWithinPartitions(partition_col, *sort).select(*columns)
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        ready.write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set(key, before)
