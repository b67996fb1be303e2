"""Batch ETL: raw entities → curated star schema, gated by quality rules.

Stages: read (text) → clean + quarantine → dimensions → sequenced fact →
quality report → publish. Only a passing run (or report mode) publishes the
curated tables. Transactions of unknown accounts stay in the fact, so that
the referential rule sees them; ``drop_orphans`` moves them to the
quarantine instead.

With a ``VersionedWriter`` every table is written once, to its place in the
new set; the gate reads those files, and one manifest switches the whole
set. Null and range rules are counted while the tables are written. With
the other writers the tables are staged on the shared folder and
copied to their places one after another when the gate has passed.

CLI::

    python -m ledgerlake.plans.etl --input RAW --output CURATED [--report-only]

exits 1 when a rule fails (unless ``--report-only``). ``--drop-orphans``
quarantines transactions of unknown accounts, ``--more-rules`` adds the
library's own rules to the original suite, ``--versioned`` publishes all
tables as one set.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.operators import cleaning, dims, quality, sequence
from ledgerlake.session import build_session, staged
from ledgerlake.sinks.versions import VersionedWriter
from ledgerlake.sinks.writers import ParquetWriter
from ledgerlake.sources.raw import load_raw

PARTITIONS = {"fact_transaction": "txn_date"}


@dataclass
class EtlResult:
    tables: dict[str, DataFrame]
    quarantine: DataFrame
    report: DataFrame
    failed: list = field(default_factory=list)
    published: dict[str, str] = field(default_factory=dict)

    @property
    def passed(self) -> bool:
        return not self.failed


def build_star(raw: dict[str, DataFrame], *, drop_orphans: bool = False, write=staged
               ) -> tuple[dict[str, DataFrame], DataFrame]:
    """Curated tables, written with ``write(df, name)``, and the transaction
    quarantine."""
    star = {"dim_customer": write(dims.build_dim_customer(raw["customers"]), "dim_customer"),
            "dim_account": write(dims.build_dim_account(raw["accounts"]), "dim_account")}
    parent = star["dim_account"] if drop_orphans else None
    kept, quarantine = cleaning.split_transactions(raw["transactions"], parent)
    star["fact_transaction"] = write(sequence.build_fact_transaction(kept), "fact_transaction")
    if "deposits" in raw:
        star["fact_deposit"] = write(dims.build_fact_deposit(raw["deposits"]), "fact_deposit")
    if "loans" in raw:
        star["dim_loan"] = write(dims.build_dim_loan(raw["loans"]), "dim_loan")
    return star, quarantine


# Checks the dirty-data demonstration runs on cleaned (not yet orphan-
# filtered) transactions.
AUDIT_RULES = (
    quality.TableRules("fact_transaction", not_null=("txn_id", "account_id", "amount", "txn_ts"),
                       unique=("txn_id",),
                       foreign_keys=(quality.ForeignKey("account_id", "dim_account",
                                                        "account_id"),)),
)


def audit_transactions(raw_transactions: DataFrame, raw_accounts: DataFrame) -> DataFrame:
    """Rule report over the cleaned rows. Orphans survive cleaning, so the
    referential rule reports them; nothing raises."""
    return quality.run_rules({"fact_transaction": cleaning.clean_transactions(raw_transactions),
                              "dim_account": dims.build_dim_account(raw_accounts)}, AUDIT_RULES)


def rules_for(tables, suite) -> tuple:
    """The rules of ``suite`` on tables that a run builds: deposits and
    loans are optional inputs, and rules on a table that is not built would
    stop the gate."""
    return tuple(r for r in suite if r.table in tables)


def run_etl(spark: SparkSession, raw: dict[str, DataFrame], writer, *,
            enforce: bool = True, rules=quality.STAR_SCHEMA_RULES,
            drop_orphans: bool = False) -> EtlResult:
    """Build, gate, publish. With ``enforce`` a failed rule stops the
    publish of the curated tables; report and quarantine are always
    written (``writer=None`` writes nothing)."""
    if isinstance(writer, VersionedWriter):
        return _run_versioned(spark, raw, writer, enforce, rules, drop_orphans)
    star, quarantine = build_star(raw, drop_orphans=drop_orphans)
    report = staged(quality.run_rules(star, rules), "dq_report")
    failed = quality.failures(report)
    result = EtlResult(star, quarantine, report, failed)
    if writer is None:
        return result
    result.published["dq_report"] = writer.write(report, "dq_report")
    result.published["quarantine_transaction"] = writer.write(quarantine, "quarantine_transaction")
    if failed and enforce:
        return result
    for name, df in star.items():
        result.published[name] = writer.write(df, name, PARTITIONS.get(name))
    return result


def _run_versioned(spark: SparkSession, raw: dict[str, DataFrame], writer: VersionedWriter,
                   enforce: bool, rules, drop_orphans: bool) -> EtlResult:
    """Write, audit, publish: the set switches at the end or not at all."""
    with writer.publish(spark) as pub:
        star, quarantine = build_star(
            raw, drop_orphans=drop_orphans,
            write=lambda df, name: pub.write(df, name, PARTITIONS.get(name), rules))
        report = pub.write(quality.run_rules(star, rules, pub.observed), "dq_report")
        result = EtlResult(star, pub.write(quarantine, "quarantine_transaction"), report,
                           quality.failures(report))
        if result.failed and enforce:
            pub.withhold(*star)
        result.published.update({name: entry["path"] for name, entry in pub.written.items()})
    return result


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", required=True)
    ap.add_argument("--report-only", action="store_true",
                    help="publish even when rules fail (report mode)")
    ap.add_argument("--drop-orphans", action="store_true",
                    help="quarantine transactions of unknown accounts")
    ap.add_argument("--more-rules", action="store_true",
                    help="also enforce the library's own rules")
    ap.add_argument("--versioned", action="store_true",
                    help="publish all tables as one set (see sinks/versions.py)")
    ap.add_argument("--master", default=None)
    args = ap.parse_args(argv)
    spark = build_session("ledgerlake-etl", args.master)
    try:
        rules = quality.STAR_SCHEMA_RULES + (
            quality.STAR_SCHEMA_ADDITIONS if args.more_rules else ())
        writer = VersionedWriter if args.versioned else ParquetWriter
        result = run_etl(spark, load_raw(spark, args.input), writer(args.output),
                         enforce=not args.report_only, rules=rules,
                         drop_orphans=args.drop_orphans)
        for row in result.failed:
            print(f"FAILED {quality.message(row)}")
        print("all data quality checks passed" if result.passed else
              f"{len(result.failed)} data quality rule(s) failed")
        return 0 if result.passed or args.report_only else 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
