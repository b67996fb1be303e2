"""The transaction fact, loaded in increments.

Any split of the raw rows into loads, in any order, gives the fact that one
load of all rows gives: the survivor of a repeated txn_id is the first under
the order of ``cleaning``, also when its copies came in different loads and
lie in different months, and rows that arrive late are numbered where they
belong. A load reads and rewrites what it touches:

* an index (txn_id → month) tells which months hold copies of its ids;
* per account, the last position and the number of rows let rows that come
  after it be numbered without reading the account's history;
* accounts with rows added or removed before their end are renumbered from
  the month of the first change on;
* only months with a changed row are written again.

The months, the index and the account states belong to one numbered load.
Month folders are named by a manifest that is created last; index and state
are batches of that load (``tiers.TieredBatches``), ignored until it is
committed. A load that dies is simply run again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import storage
from ledgerlake.operators import cleaning, sequence
from ledgerlake.operators.ranking import keep_first, number_within
from ledgerlake.operators.sequence import SEQ
from ledgerlake.session import staged
from ledgerlake.sinks.versions import Manifests
from ledgerlake.streaming.tiers import TieredBatches, newest

MONTH = "txn_month"
COLUMNS = (*cleaning.TXN_COLUMNS, "txn_date", SEQ)
# Survivor order of cleaned rows; of equal copies the one already there.
ORDER = ("txn_ts", "amount", "category", "account_id", "_new")


def _position() -> Column:
    return F.struct("txn_ts", "txn_id")


def _month() -> Column:
    return F.date_format("txn_date", "yyyy-MM")


def _ends(rows: DataFrame) -> DataFrame:
    """(account_id, last, n): the accounts' last positions and numbers."""
    return rows.groupBy("account_id").agg(F.max(_position()).alias("last"),
                                          F.max(SEQ).cast("long").alias("n"))


@dataclass
class IncrementalFact:
    """The fact below ``root``. ``raw`` rows must have the same types in
    every load."""

    root: str

    def __post_init__(self):
        self.root = self.root.rstrip("/")

    # ------------------------------------------------------------ reading

    def state(self, spark: SparkSession) -> tuple[int, dict]:
        number, content = Manifests(spark, self.root).latest()
        return number, content or {"load": 0, "schema": None, "months": {}}

    def read(self, spark: SparkSession, months=None) -> DataFrame | None:
        """The fact, or some months of it: no other folder is listed. None
        before the first load."""
        content = self.state(spark)[1]
        return self._read(spark, content, content["months"] if months is None else months)

    def _read(self, spark: SparkSession, content: dict, months) -> DataFrame | None:
        if content["schema"] is None:
            return None
        schema = T.StructType.fromJson(content["schema"])
        paths = [content["months"][m] for m in months if m in content["months"]]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)

    def _index(self, fact: T.StructType) -> TieredBatches:
        schema = T.StructType([fact["txn_id"], T.StructField(MONTH, T.StringType()),
                               T.StructField("batch_id", T.LongType())])
        return TieredBatches(f"{self.root}/index", schema, newest(["txn_id"], [MONTH]))

    def _accounts(self, fact: T.StructType) -> TieredBatches:
        last = T.StructType([fact["txn_ts"], fact["txn_id"]])
        schema = T.StructType([fact["account_id"], T.StructField("last", last),
                               T.StructField("n", T.LongType()),
                               T.StructField("batch_id", T.LongType())])
        return TieredBatches(f"{self.root}/accounts", schema,
                             newest(["account_id"], ["last", "n"]))

    @staticmethod
    def _committed(spark: SparkSession, store: TieredBatches, load: int, key: str,
                   keys: DataFrame) -> DataFrame:
        """Newest committed rows of a store for some keys. The rows of other
        keys are left before anything is merged."""
        rows = store.rows(spark).where(F.col("batch_id") <= load)
        return store.merge(rows.join(keys.select(key).distinct(), key, "left_semi"))

    # ------------------------------------------------------------ loading

    def load(self, spark: SparkSession, raw: DataFrame) -> int:
        """Add raw rows; returns the number of months written."""
        number, content = self.state(spark)
        if content["schema"] is None:
            return self._first(spark, raw, number, content)
        load = content["load"] + 1
        delta = staged(cleaning.clean_transactions(raw).withColumn("_new", F.lit(1)), "delta")
        fact = T.StructType.fromJson(content["schema"])
        index, accounts = self._index(fact), self._accounts(fact)
        done = content["load"]

        # Copies of the load's ids that are in the fact, wherever they lie.
        hit = staged(self._committed(spark, index, done, "txn_id", delta)
                     .where(F.col(MONTH).isNotNull()), "index-hits")
        months = sorted(r[0] for r in hit.select(MONTH).distinct().collect())
        old = staged(self._read(spark, content, months).join(hit.select("txn_id"), "txn_id",
                                                             "left_semi"), "old-copies")
        winners = staged(keep_first(
            delta.unionByName(old.drop(SEQ).withColumn("_new", F.lit(0))), "txn_id", ORDER)
            .where("_new = 1").drop("_new"), "inserted")
        removed = staged(old.join(winners.select("txn_id"), "txn_id", "left_semi"), "removed")

        # Accounts whose rows change before their end, and from where on.
        known = staged(self._committed(spark, accounts, done, "account_id", winners.select(
            "account_id").unionByName(removed.select("account_id"))), "accounts")
        changes = (winners.withColumn("gone", F.lit(False))
                   .unionByName(removed.drop(SEQ).withColumn("gone", F.lit(True)))
                   .join(known.select("account_id", "last"), "account_id", "left"))
        late = staged(changes.where(F.col("gone") | (_position() <= F.col("last")))
                      .groupBy("account_id").agg(F.min(_month()).alias("since")), "late")
        since = late.agg(F.min("since")).first()[0]

        # Accounts that only grow.
        grown = number_within(
            winners.join(late.select("account_id"), "account_id", "left_anti")
            .join(known.select("account_id", "n"), "account_id", "left"),
            "account_id", ["txn_ts", "txn_id"], "_rn")
        upserts = staged(grown.withColumn(
            SEQ, (F.coalesce("n", F.lit(0)) + F.col("_rn")).cast("int")).select(*COLUMNS), "grown")
        ends, replaced = _ends(upserts), removed.select("txn_id")
        if since is not None:
            changed, late_ends = self._renumbered(spark, content, since, late, winners, removed)
            upserts, ends = upserts.unionByName(changed), ends.unionByName(late_ends)
            replaced = replaced.unionByName(changed.select("txn_id"))
        upserts = upserts.withColumn(MONTH, _month())

        # Months with a changed row are written again. A row that an account
        # grew by replaces none but those removed.
        touched = sorted({r[0] for r in upserts.select(MONTH).unionByName(
            removed.select(_month().alias(MONTH))).distinct().collect()})
        kept = self._read(spark, content, touched).join(replaced, "txn_id", "left_anti")
        there = self._write_months(spark, kept.withColumn(MONTH, _month()).unionByName(upserts))

        # Ids that moved or came; the accounts' new ends.
        index.write(winners.select("txn_id", _month().alias(MONTH)), load)
        accounts.write(ends, load)
        Manifests(spark, self.root).commit(number, {
            **content, "load": load,
            "months": {**{m: p for m, p in content["months"].items() if m not in touched}, **there}})
        return len(touched)

    def _first(self, spark: SparkSession, raw: DataFrame, number: int, content: dict) -> int:
        """The first load: there is nothing to compare its rows with. The
        index and the accounts' ends are read off the months written."""
        fact = sequence.build_fact_transaction(cleaning.clean_transactions(raw)).select(*COLUMNS)
        schema = T.StructType([*fact.schema.fields[:-1], T.StructField(SEQ, T.IntegerType())])
        content = {**content, "load": 1, "schema": schema.jsonValue(),
                   "months": self._write_months(spark, fact.withColumn(MONTH, _month()))}
        rows = self._read(spark, content, content["months"])
        self._index(schema).write(rows.select("txn_id", _month().alias(MONTH)), 1)
        self._accounts(schema).write(_ends(rows), 1)
        Manifests(spark, self.root).commit(number, content)
        return len(content["months"])

    def _write_months(self, spark: SparkSession, rows: DataFrame) -> dict[str, str]:
        """Write rows, MONTH among them, by month; returns the folders."""
        folder = f"{self.root}/months/{uuid.uuid4().hex}"
        (rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, "txn_date", "account_id")
         .write.partitionBy(MONTH).parquet(folder))
        return {n.partition("=")[2]: f"{folder}/{n}" for n in storage.names(spark, folder)
                if n.startswith(f"{MONTH}=")}

    def _renumbered(self, spark: SparkSession, content: dict, since: str, late: DataFrame,
                    winners: DataFrame, removed: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Rows of the late accounts whose number changes, with their new
        rows, and the accounts' new ends. The rows of the months since the
        first change are the end of an account's order, so the first old
        number there tells how many rows lie before."""
        accounts = late.select("account_id")
        old = self._read(spark, content, [m for m in content["months"] if m >= since]).join(
            accounts, "account_id", "left_semi")
        base = staged(old.groupBy("account_id").agg((F.min(SEQ) - 1).alias("_base")), "bases")
        rows = (old.join(removed.select("txn_id"), "txn_id", "left_anti")
                .withColumnRenamed(SEQ, "_was")
                .unionByName(winners.join(accounts, "account_id", "left_semi"),
                             allowMissingColumns=True))
        numbered = number_within(rows, "account_id", ["txn_ts", "txn_id"], "_rn").join(
            base, "account_id", "left")
        numbered = staged(numbered.withColumn(
            SEQ, (F.coalesce("_base", F.lit(0)) + F.col("_rn")).cast("int")), "renumbered")
        ends = _ends(numbered)
        # Accounts that lost all their rows since then end before it.
        emptied = staged(base.join(ends, "account_id", "left_anti"), "emptied")
        if not emptied.isEmpty():
            before = self._read(spark, content, [m for m in content["months"] if m < since])
            before = _ends(before.join(emptied, "account_id", "left_semi"))
            ends = ends.unionByName(emptied.select("account_id").join(
                before, "account_id", "left").select(
                "account_id", "last", F.coalesce("n", F.lit(0)).cast("long").alias("n")))
        return numbered.where(~F.col(SEQ).eqNullSafe(F.col("_was"))).select(*COLUMNS), ends

    def tidy(self, spark: SparkSession) -> None:
        """Fold the index and the states, delete what no manifest but the
        newest names. Not while a load runs."""
        _, content = self.state(spark)
        if content["schema"] is None:
            return
        fact = T.StructType.fromJson(content["schema"])
        for store in (self._index(fact), self._accounts(fact)):
            store.fold(spark)
            store.vacuum(spark)
        used = {p.rpartition("/")[0].rpartition("/")[2] for p in content["months"].values()}
        for name in storage.names(spark, f"{self.root}/months"):
            if name not in used:
                storage.delete(spark, f"{self.root}/months/{name}")
