"""Declarative data-quality gate: rules → one report DataFrame.

Rule kinds (semantics follow the checks they replace):

* ``not_null``     violations = rows where the column IS NULL (NaN is a value)
* ``unique``       violations = rows − distinct values, where one NULL counts
                   as a value: two NULLs are a duplicate, one is not
* ``referential``  violations = child rows whose key has no parent row; a
                   NULL child key is an orphan
* ``range``        violations = values below ``lo`` or above ``hi``
                   (inclusive bounds; NULL passes, NaN fails)

Execution: all rules of one table are folded into a single aggregate over
that table, so each table – including a derived one such as the fact – is
evaluated once. ``count(DISTINCT c)`` is planned as a two-level aggregate
keyed by ``c``, so a hot value is combined map-side. Referential rules add
a left join to the distinct keys of each parent, with a match flag
(broadcast when the keys are small by Spark's size estimate or AQE's
runtime size, shuffled otherwise). A table with one foreign key is first
counted by that key, combined map-side, so a key and its counts are
shuffled, never the rows, and a hot or NULL key is one row a task. With
several keys the rows are joined; AQE splits a skewed child partition. The
report is lazy: one action runs every rule.

Null and range rules need no scan at all where the table is being written
anyway: ``observe_rules`` counts their violations while the rows pass, and
``run_rules(..., observed=...)`` takes those counts.

Report columns: table_name, rule, column_name, detail, violations, total,
passed. ``enforce`` raises ``DataQualityError`` on failed rows; the
``assert_*`` helpers are the single-rule, raise-on-failure forms.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REPORT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType(), False),
    T.StructField("rule", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("detail", T.StringType(), True),
    T.StructField("violations", T.LongType(), False),
    T.StructField("total", T.LongType(), False),
    T.StructField("passed", T.BooleanType(), False),
])


class DataQualityError(Exception):
    """A rule failed. ``rows`` holds the failed report rows."""

    def __init__(self, message: str, rows=()):
        super().__init__(message)
        self.rows = list(rows)


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class ValueRange:
    column: str
    lo: float | None
    hi: float | None

    @property
    def detail(self) -> str:
        return f"[{self.lo}, {self.hi}]"


@dataclass(frozen=True)
class TableRules:
    table: str
    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    ranges: tuple[ValueRange, ...] = ()
    extra: dict = field(default_factory=dict, compare=False)


# The star-schema suite, in the order the checks ran originally
# (fact_deposit has no rules).
STAR_SCHEMA_RULES: tuple[TableRules, ...] = (
    TableRules("dim_customer", not_null=("customer_id", "full_name"), unique=("customer_id",)),
    TableRules("dim_account", not_null=("account_id", "customer_id"), unique=("account_id",),
               foreign_keys=(ForeignKey("customer_id", "dim_customer", "customer_id"),)),
    TableRules("fact_transaction", not_null=("txn_id", "account_id", "amount"),
               unique=("txn_id",),
               foreign_keys=(ForeignKey("account_id", "dim_account", "account_id"),)),
    TableRules("dim_loan", ranges=(ValueRange("interest_rate", 0, 40),)),
)

# Rules the original suite leaves out although the data model implies them
# (labelled additions): txn_ts is required, loans and deposits reference
# their parents.
STAR_SCHEMA_ADDITIONS: tuple[TableRules, ...] = (
    TableRules("fact_transaction", not_null=("txn_ts",)),
    TableRules("dim_loan", foreign_keys=(ForeignKey("customer_id", "dim_customer", "customer_id"),)),
    TableRules("fact_deposit", foreign_keys=(ForeignKey("account_id", "dim_account", "account_id"),)),
)


def _flag_parents(df: DataFrame, fks, parents: dict[str, DataFrame]) -> DataFrame:
    """Left-join ``df`` to the distinct keys of each parent, adding a match
    flag ``_hit{i}`` per foreign key. Parent keys are distinct, so the row
    count of ``df`` is unchanged; a NULL child key never matches."""
    for i, fk in enumerate(fks):
        keys = (parents[fk.parent].select(F.col(fk.parent_column).alias(f"_pk{i}"))
                .filter(F.col(f"_pk{i}").isNotNull()).distinct()
                .withColumn(f"_hit{i}", F.lit(True)))
        df = df.join(keys, df[fk.column] == keys[f"_pk{i}"], "left")
    return df


def _q(name: str) -> str:
    """Quote an identifier for a SQL expression."""
    return "`" + name.replace("`", "``") + "`"


def _s(text: str | None) -> str:
    """SQL string literal (or NULL)."""
    if text is None:
        return "CAST(NULL AS STRING)"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row_rules(rules: TableRules) -> list[tuple[str, str, str | None, str]]:
    """(rule, column, detail, violating condition) of the rules that look at
    one row at a time."""
    return ([("not_null", c, None, f"{_q(c)} IS NULL") for c in rules.not_null]
            + [("range", r.column, r.detail, _range_sql(_q(r.column), r.lo, r.hi))
               for r in rules.ranges])


def observe_rules(df: DataFrame, table: str, suite=()) -> tuple[DataFrame, Observation]:
    """``df`` with the violations of the table's null and range rules, and
    its rows (``_total``), counted by the first action that runs it."""
    seen = Observation(f"{table}-{uuid.uuid4().hex}")
    specs = dict.fromkeys(s for r in suite if r.table == table for s in _row_rules(r))
    return df.observe(seen, F.expr("count(1) AS _total"), *[
        F.expr(f"count_if({bad})").alias(f"{rule} {c} {bad}")
        for rule, c, _, bad in specs]), seen


def _observed_checks(spark: SparkSession, rules: TableRules, counts: dict) -> list[DataFrame]:
    """Report rows of the null and range rules from observed counts."""
    rows = [(rules.table, rule, c, detail, v := counts[f"{rule} {c} {bad}"], counts["_total"], v == 0)
            for rule, c, detail, bad in _row_rules(rules)]
    return [spark.createDataFrame(rows, REPORT_SCHEMA)] if rows else []


def table_checks(df: DataFrame, rules: TableRules,
                 parents: dict[str, DataFrame] | None = None,
                 observed: dict | None = None) -> list[DataFrame]:
    """All rules of one table as report rows: one aggregate for null, range
    and referential rules (the child is evaluated once), and one per unique
    column (several distinct counts in one aggregate would multiply the
    rows by an Expand). ``observed`` counts replace the null and range
    rules' part of the aggregate."""
    out = [_distinct_check(df, rules.table, c) for c in rules.unique]
    fks = rules.foreign_keys
    row_rules = _row_rules(rules)
    if observed is not None:
        out += _observed_checks(df.sparkSession, rules, observed)
        row_rules = []
    aggs = ["count(1) AS _total"]
    specs: list[tuple[str, str, str | None, str]] = []
    for i, (rule, c, detail, bad) in enumerate(row_rules):
        aggs.append(f"count_if({bad}) AS _row{i}")
        specs.append((rule, c, detail, f"_row{i}"))
    if len(fks) == 1:
        # One row per key before the join; the counts are added up after it.
        key = fks[0].column
        df = df.groupBy(F.col(_q(key)).alias(key)).agg(*[F.expr(e) for e in aggs])
        aggs = [f"coalesce(sum({n}), 0) AS {n}"
                for n in ("_total", *[name for *_, name in specs])]
    if fks:
        df = _flag_parents(df, fks, parents or {})
    for i, fk in enumerate(fks):
        aggs.append(f"coalesce(sum(if(_hit{i} IS NULL, _total, 0)), 0) AS _fk{i}" if len(fks) == 1
                    else f"count_if(_hit{i} IS NULL) AS _fk{i}")
        specs.append(("referential", fk.column, f"{fk.parent}.{fk.parent_column}", f"_fk{i}"))
    if specs:
        agg = df.agg(*[F.expr(e) for e in aggs])
        out.append(_report(agg, [(rules.table, rule, col, detail, name)
                                 for rule, col, detail, name in specs]))
    return out


def _distinct_check(df: DataFrame, table: str, column: str) -> DataFrame:
    # count(DISTINCT) ignores NULL; one NULL counts as one more value.
    c = _q(column)
    agg = df.agg(F.expr("count(1) AS _total"), F.expr(
        f"count(DISTINCT {c}) + coalesce(max(CAST({c} IS NULL AS INT)), 0) AS _distinct"))
    return _report(agg, [(table, "unique", column, None, "_total - _distinct")])


def _report(agg: DataFrame, specs) -> DataFrame:
    """Report rows (table, rule, column, detail, violations) of one row of
    counts with ``_total``."""
    cells = [f"{_s(t)}, {_s(rule)}, {_s(col)}, {_s(detail)}, CAST({v} AS BIGINT), "
             "CAST(_total AS BIGINT)" for t, rule, col, detail, v in specs]
    rows = agg.selectExpr(
        f"stack({len(specs)}, {', '.join(cells)}) "
        "AS (table_name, rule, column_name, detail, violations, total)")
    return rows.selectExpr("*", "violations = 0 AS passed")


def _range_sql(c: str, lo, hi) -> str:
    """Inclusive bounds; NULL passes (the comparison is NULL, not true),
    NaN fails (it sorts above every number)."""
    parts = []
    if lo is not None:
        parts.append(f"{c} < {float(lo)!r}")
    if hi is not None:
        parts.append(f"{c} > {float(hi)!r}")
    return f"coalesce({' OR '.join(parts) or 'false'}, false)"


def run_rules(tables: dict[str, DataFrame], suite,
              observed: dict[str, Observation] | None = None) -> DataFrame:
    """Report for every rule of ``suite`` over ``tables`` (name → DataFrame).
    A rule whose table or parent is absent cannot be checked: ``KeyError``.
    ``observed``: what ``observe_rules`` counted for tables written already."""
    counts = {t: o.get for t, o in (observed or {}).items()}
    parts: list[DataFrame] = []
    for rules in suite:
        for name in (rules.table, *(fk.parent for fk in rules.foreign_keys)):
            if name not in tables:
                raise KeyError(f"no table {name!r} for the rules of {rules.table!r}")
        parts += table_checks(tables[rules.table], rules, tables, counts.get(rules.table))
    if not parts:
        spark = SparkSession.getActiveSession()
        return spark.createDataFrame([], REPORT_SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def failures(report: DataFrame) -> list:
    return report.filter(~F.col("passed")).collect()


def message(row) -> str:
    """Error text of a failed rule.

    The texts name table, column and count; ``referential`` also names the
    parent's key."""
    if row["rule"] == "not_null":
        return f"[{row['table_name']}] column '{row['column_name']}' has {row['violations']} null values"
    if row["rule"] == "unique":
        distinct = row["total"] - row["violations"]
        return (f"[{row['table_name']}] column '{row['column_name']}' is not unique: "
                f"{row['total']} rows vs {distinct} distinct values")
    if row["rule"] == "referential":
        return (f"[{row['table_name']}] {row['violations']} rows in '{row['column_name']}' "
                f"have no matching '{row['detail']}'")
    return (f"[{row['table_name']}] column '{row['column_name']}' has {row['violations']} "
            f"values outside {row['detail']}")


def enforce(report: DataFrame) -> None:
    """Raise ``DataQualityError`` naming every failed rule."""
    bad = failures(report)
    if bad:
        raise DataQualityError("; ".join(message(r) for r in bad), bad)


# Single-rule forms (raise on failure).

def _enforce_rules(df: DataFrame, rules: TableRules, parents=None) -> None:
    enforce(reduce(DataFrame.unionByName, table_checks(df, rules, parents)))


def assert_no_nulls(df: DataFrame, columns, table_name: str) -> None:
    _enforce_rules(df, TableRules(table_name, not_null=tuple(columns)))


def assert_unique(df: DataFrame, column: str, table_name: str) -> None:
    _enforce_rules(df, TableRules(table_name, unique=(column,)))


def assert_referential_integrity(child_df: DataFrame, child_key: str, parent_df: DataFrame,
                                 parent_key: str, table_name: str) -> None:
    _enforce_rules(child_df, TableRules(table_name, foreign_keys=(
        ForeignKey(child_key, "parent", parent_key),)), {"parent": parent_df})


def assert_value_range(df: DataFrame, column: str, min_value, max_value, table_name: str) -> None:
    _enforce_rules(df, TableRules(table_name, ranges=(ValueRange(column, min_value, max_value),)))
