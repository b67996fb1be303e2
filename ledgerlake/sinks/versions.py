"""Publishing a set of tables at once.

Every table of a publication is written to a folder of its own, once. What
readers see is decided by a *manifest*, a numbered text file that names the
folder of every table: the set switches with the creation of one file, and
a failure before that leaves the old set whole. Tables a publication does
not write keep the folder they had, so one table can be reloaded without
copying the others.

    with VersionedWriter(root).publish(spark) as pub:
        fact = pub.write(fact, "fact_transaction", "txn_date")   # not visible yet
        check(fact)                                              # reads what was written
    Snapshot.latest(spark, root).read("fact_transaction")

A manifest is created, never replaced: of two publications that began on the
same set the second one to finish fails with ``PublishConflict`` and
publishes nothing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake import storage
from ledgerlake.operators import quality
from ledgerlake.sinks.writers import _prepare


class PublishConflict(RuntimeError):
    """Another publication switched the set first."""


class Manifests:
    """Numbered manifests below a folder; the newest one counts."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.folder = spark, f"{root.rstrip('/')}/_manifests"

    def numbers(self) -> list[int]:
        return sorted(int(n) for n in storage.names(self.spark, self.folder) if n.isdigit())

    def load(self, number: int) -> dict:
        return json.loads(storage.read_text(self.spark, f"{self.folder}/{number:010}"))

    def latest(self) -> tuple[int, dict]:
        """(0, {}) before the first one."""
        numbers = self.numbers()
        return (numbers[-1], self.load(numbers[-1])) if numbers else (0, {})

    def commit(self, after: int, content: dict) -> int:
        number = after + 1
        if not storage.create_text(self.spark, f"{self.folder}/{number:010}",
                                   json.dumps(content, indent=1, sort_keys=True)):
            raise PublishConflict(f"manifest {number} of {self.folder} is taken")
        return number


@dataclass(frozen=True)
class Snapshot:
    """One published set: all tables of the same version."""

    spark: SparkSession
    version: int
    tables: dict

    @classmethod
    def latest(cls, spark: SparkSession, root: str) -> Snapshot:
        return cls(spark, *Manifests(spark, root).latest())

    @classmethod
    def at(cls, spark: SparkSession, root: str, version: int) -> Snapshot:
        return cls(spark, version, Manifests(spark, root).load(version))

    def read(self, table: str) -> DataFrame:
        entry = self.tables[table]
        return self.spark.read.schema(T.StructType.fromJson(entry["schema"])).parquet(entry["path"])

    def as_views(self, database: str) -> None:
        """Point views of a catalog database at this set, one change of the
        catalog per table."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        for name, entry in self.tables.items():
            path = entry["path"].replace("`", "``")
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS "
                           f"SELECT * FROM parquet.`{path}`")


@dataclass
class Publication:
    """The tables of a set that is being written; see ``VersionedWriter``."""

    spark: SparkSession
    root: str
    began: int
    before: dict
    written: dict = field(default_factory=dict)
    withheld: dict = field(default_factory=dict)
    observed: dict = field(default_factory=dict)
    version: int | None = None

    def write(self, df: DataFrame, table: str, partition_col: str | None = None,
              rules=()) -> DataFrame:
        """Write a table and read it back; readers see it after the switch.
        Violations of the table's null and range rules are counted on the
        way (``observed``, for ``quality.run_rules``)."""
        path = f"{self.root}/{table}/{uuid.uuid4().hex}"
        seen, self.observed[table] = quality.observe_rules(_prepare(df, partition_col), table, rules)
        w = seen.write.format("parquet")
        if partition_col:
            w = w.partitionBy(partition_col)
        w.save(path)
        # Partition columns come last when read back.
        fields = [f for f in df.schema.fields if f.name != partition_col]
        fields += [f for f in df.schema.fields if f.name == partition_col]
        schema = T.StructType(fields)
        self.written[table] = {"path": path, "partition": partition_col,
                               "schema": json.loads(schema.json()),
                               "rows": self.observed[table].get["_total"]}
        return self.spark.read.schema(schema).parquet(path).select(*df.columns)

    def withhold(self, *tables: str) -> None:
        """Leave written tables out of the switch (a gate said no)."""
        for t in tables:
            self.withheld[t] = self.written.pop(t)

    def __enter__(self) -> Publication:
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None and self.written:
            self.version = Manifests(self.spark, self.root).commit(
                self.began, {**self.before, **self.written})


@dataclass
class VersionedWriter:
    """Tables below ``root``, switched as a set."""

    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    def publish(self, spark: SparkSession) -> Publication:
        return Publication(spark, self.root, *Manifests(spark, self.root).latest())

    def rollback(self, spark: SparkSession, version: int) -> int:
        """Publish an older set again."""
        manifests = Manifests(spark, self.root)
        return manifests.commit(manifests.latest()[0], manifests.load(version))

    def vacuum(self, spark: SparkSession, keep: int = 2) -> list[str]:
        """Delete the folders that none of the newest ``keep`` manifests
        names, and the older manifests. Not while a publication is being
        written: its folders are in no manifest yet."""
        manifests = Manifests(spark, self.root)
        numbers = manifests.numbers()
        kept = {e["path"] for n in numbers[-keep:] for e in manifests.load(n).values()}
        gone = []
        for table in storage.names(spark, self.root):
            if table.startswith("_"):
                continue
            for name in storage.names(spark, f"{self.root}/{table}"):
                path = f"{self.root}/{table}/{name}"
                if path not in kept:
                    storage.delete(spark, path)
                    gone.append(path)
        for n in numbers[:-keep]:
            storage.delete(spark, f"{manifests.folder}/{n:010}")
        return gone
