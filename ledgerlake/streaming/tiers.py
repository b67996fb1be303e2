"""Folders of micro-batches, folded level by level.

Every micro-batch writes ``<path>/batch_id=<id>`` (a replay rewrites its own
folder). ``fold`` merges ``fanout`` consecutive batches into a run of level
1, ``fanout`` runs of level 1 into one of level 2 and so on, so a reader
opens a number of folders that grows with the logarithm of the batches, and
a row is rewritten once per level, never by rescanning everything.

Which runs count is decided by a manifest that is created last: a fold that
dies leaves the batches as they were, and its folder is never read. The
newest batch is never folded, because a restarted stream may replay it; a
replay of an older batch, should one happen, is already in a run and its
folder is not read again. ``vacuum`` deletes what no reader needs any more.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import storage
from ledgerlake.sinks.versions import Manifests

FANOUT = 8


@dataclass
class TieredBatches:
    """``schema``: the columns of a batch, ``batch_id`` among them (it is the
    folder's name while the batch is not folded). ``merge`` turns the rows of
    several batches or runs into those of one; merging merged rows must give
    the same as merging all at once."""

    path: str
    schema: T.StructType
    merge: Callable[[DataFrame], DataFrame]
    fanout: int = FANOUT

    def __post_init__(self):
        self.path = self.path.rstrip("/")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(self._batch(batch_id))

    def _batch(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def _runs(self, spark: SparkSession) -> tuple[int, list[dict]]:
        """The manifest's number and its runs, oldest batches first."""
        number, content = Manifests(spark, self.path).latest()
        return number, sorted(content.get("runs", []), key=lambda r: r["first"])

    def batch_ids(self, spark: SparkSession) -> list[int]:
        """Batches whose folder stands, folded ones included."""
        return sorted(int(n.partition("=")[2]) for n in storage.names(spark, self.path)
                      if n.startswith("batch_id="))

    def _unfolded(self, spark: SparkSession, runs: list[dict]) -> list[int]:
        upto = max((r["last"] for r in runs), default=-1)
        return [i for i in self.batch_ids(spark) if i > upto]

    def _read_batches(self, spark: SparkSession, ids: list[int]) -> DataFrame:
        if not ids:
            return spark.createDataFrame([], self.schema)
        return (spark.read.schema(self.schema).option("basePath", self.path)
                .parquet(*[self._batch(i) for i in ids]).select(*self.schema.names))

    def _read_runs(self, spark: SparkSession, runs: list[dict]) -> DataFrame:
        return spark.read.schema(self.schema).parquet(*[r["path"] for r in runs])

    def folders(self, spark: SparkSession) -> int:
        """How many folders a reader opens."""
        _, runs = self._runs(spark)
        return len(runs) + len(self._unfolded(spark, runs))

    def rows(self, spark: SparkSession) -> DataFrame:
        """Rows of all runs and of the batches after them; ``merge`` them for
        the current state."""
        _, runs = self._runs(spark)
        live = self._read_batches(spark, self._unfolded(spark, runs))
        return live.unionByName(self._read_runs(spark, runs)) if runs else live

    def fold(self, spark: SparkSession) -> int:
        """Fold whatever fills a level; returns the number of merges."""
        number, runs = self._runs(spark)
        ids = self._unfolded(spark, runs)[:-1]
        merges = 0
        while len(ids) >= self.fanout:
            part, ids = ids[:self.fanout], ids[self.fanout:]
            runs.append(self._written(self._read_batches(spark, part), 1, part[0], part[-1]))
            merges += 1
        level = 1
        while any(r["level"] >= level for r in runs):
            same = [r for r in runs if r["level"] == level]
            while len(same) >= self.fanout:
                part, same = same[:self.fanout], same[self.fanout:]
                runs = [r for r in runs if r not in part]
                runs.append(self._written(self._read_runs(spark, part), level + 1,
                                          part[0]["first"], part[-1]["last"]))
                merges += 1
            level += 1
        if merges:
            Manifests(spark, self.path).commit(number, {"runs": runs})
        return merges

    def _written(self, rows: DataFrame, level: int, first: int, last: int) -> dict:
        path = f"{self.path}/_runs/{level}-{first}-{last}-{uuid.uuid4().hex[:8]}"
        self.merge(rows).select(*self.schema.names).write.parquet(path)
        return {"path": path, "level": level, "first": first, "last": last}

    def vacuum(self, spark: SparkSession) -> int:
        """Delete folded batches, replaced runs and older manifests; returns
        the number of folders. Run it when no reader of an older state is at
        work, and not during a fold."""
        manifests = Manifests(spark, self.path)
        number, runs = self._runs(spark)
        kept = {r["path"] for r in runs}
        live = set(self._unfolded(spark, runs))
        gone = [self._batch(i) for i in self.batch_ids(spark) if i not in live]
        gone += [p for n in storage.names(spark, f"{self.path}/_runs")
                 if (p := f"{self.path}/_runs/{n}") not in kept]
        for path in gone:
            storage.delete(spark, path)
        for n in manifests.numbers():
            if n < number:
                storage.delete(spark, f"{manifests.folder}/{n:010}")
        return len(gone)


def newest(keys: list[str], values: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Merge of states: per key the row of the newest batch."""
    def merge(rows: DataFrame) -> DataFrame:
        row = F.max_by(F.struct(*values), F.col("batch_id")).alias("_r")
        return (rows.groupBy(*keys).agg(row, F.max("batch_id").alias("batch_id"))
                .select(*keys, *[f"_r.{v}" for v in values], "batch_id"))
    return merge
