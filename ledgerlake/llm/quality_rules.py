"""Quality rules with adaptive thresholds.

Each document gets a few integer metrics. A quantile sketch per metric,
language and source holds counts over bins whose width grows with the value
(a fixed relative error, so a bounded number of bins); sketches merge by
adding counts, so a group's sketch also serves its language's and the whole
corpus's. A threshold is an upper fence above the third quartile; that of a
group is blended with its language's, and that with the corpus's, by a weight
that falls smoothly as the group grows. A document is kept if it passes the
base rules and no metric lies above its group's fence. Native column
functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, staged, words_of

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Metrics as whole numbers (a Python // b in both engines) and the least
# room between the third quartile and the fence, so that a group without
# spread does not reject ordinary documents.
METRICS = {
    # symbols per 1000 word characters
    "symbols": (("n_symbols * 1000", "word_chars"), 50),
    # repeated lines per 1000 words
    "dup_lines": (("n_dup_lines * 1000", "n_words"), 30),
    # mean word length in hundredths of a character
    "word_length": (("word_chars * 100", "n_words"), 250),
    # capitals A-Z per 1000 word characters
    "capitals": (("n_capitals * 1000", "word_chars"), 150),
}
# Fence = third quartile + FENCE x interquartile range (at least the room).
FENCE = 3
# The wider group's fence counts as much as so many of a group's documents.
PRIOR = 50
# Values below 2 * STEPS have a bin each; from there on every doubling is cut
# into STEPS bins, so a quartile is off by less than one part in STEPS and a
# sketch has at most 59 * STEPS bins.
STEPS, STEP_BITS = 32, 5
# Parts a group's documents are dealt to in the final join.
SALTS = 32
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _line_count(text: Column) -> Column:
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def base_metrics(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns plus n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_capitals (long). Null text has no words; all counts are 0.

    Windows are compared by a 64-bit hash of their words within one
    document.
    """
    # Each step is a projection of its own: an array that lambdas read has
    # to be a column, not an expression evaluated per element.
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        *keep, words_of(F.col(text)).alias("words"),
        F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.length(t) - F.length(F.translate(t, CAPITALS, ""))).cast("long").alias("n_capitals"),
        _line_count(t).cast("long").alias("n_dup_lines"))
    rows = rows.select(
        *keep, "n_symbols", "n_dup_lines", "n_capitals", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    starts = F.when(F.col("n_words") >= WINDOW,
                    F.sequence(F.lit(1), (F.col("n_words") - (WINDOW - 1)).cast("int")))
    rows = rows.withColumn("windows", F.transform(
        starts, lambda i: F.xxhash64(*[F.get(F.col("h"), i + (k - 1)) for k in range(WINDOW)])))
    # Only documents with some repeated window go on to locate them.
    repeats = F.size(F.array_distinct("windows")) < F.size("windows")
    rows = rows.withColumn("sorted", F.when(repeats, F.array_sort(F.transform(
        "windows", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    rows = rows.withColumn("at", F.array_sort(F.transform(F.filter(
        "sorted", lambda e, i: (e["x"] == F.get(F.col("sorted"), i - 1)["x"])
        | (e["x"] == F.get(F.col("sorted"), i + 1)["x"])), lambda e: e["i"])))
    covered = F.aggregate(
        F.transform("at", lambda p, i: F.least(
            F.lit(WINDOW), F.coalesce(F.get(F.col("at"), i + 1) - p, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda acc, x: acc + x)
    return rows.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines",
                       "n_capitals", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > "
                  f"{MAX_REPEAT_PERCENT} * n_words")


def _metric(parts: tuple[str, str]) -> Column:
    top, bottom = parts
    return F.expr(f"CASE WHEN {bottom} > 0 THEN ({top}) DIV ({bottom}) ELSE 0 END")


def bin_of(value: str) -> str:
    """SQL of the bin of a value that is not negative; ``bin`` gives the
    binary digits, whose number is the value's order of size."""
    size = f"length(bin({value})) - {STEP_BITS + 1}"
    return (f"CASE WHEN {value} < {2 * STEPS} THEN {value} ELSE "
            f"{STEPS} * ({size}) + ({value} >> CAST({size} AS INT)) END")


def least_of(b: str, floor: str = "DIV") -> str:
    """SQL of the least value of a bin."""
    size = f"({b} {floor} {STEPS} - 1)"
    return (f"CASE WHEN {b} < {2 * STEPS} THEN {b} ELSE "
            f"({b} - {STEPS} * {size}) << CAST({size} AS INT) END")


def sketches(rows: DataFrame) -> DataFrame:
    """(metric, lang, source, bin, n): counts per bin; rows of sketches of
    the same group merge by adding n."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value"))
                      for m in METRICS])
    return (rows.select("lang", "source", F.inline(pairs))
            .groupBy("metric", "lang", "source",
                     F.expr(bin_of("value")).cast("bigint").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n")))


def fences(sketch: DataFrame, group: list[str]) -> DataFrame:
    """(metric, *group, size, fence) from the sketches merged to ``group``."""
    by = ["metric", *group]
    merged = sketch.groupBy(*by, "bin").agg(F.sum("n").alias("n"))
    run = Window.partitionBy(*by).orderBy("bin")
    ranked = merged.select(
        *by, "bin", F.sum("n").over(run).alias("upto"),
        F.sum("n").over(Window.partitionBy(*by)).alias("size"))
    # A quartile is the least value of the first bin that reaches it.
    q = ranked.groupBy(*by, "size").agg(
        F.min(F.when(F.col("upto") * 4 >= F.col("size"), F.col("bin"))).alias("q1"),
        F.min(F.when(F.col("upto") * 4 >= F.col("size") * 3, F.col("bin"))).alias("q3"))
    room = reduce(lambda c, m: c.when(F.col("metric") == m, METRICS[m][1]), METRICS,
                  F.when(F.lit(False), 0))
    q = q.withColumns({"q1": F.expr(least_of("q1")), "q3": F.expr(least_of("q3"))})
    return q.select(*by, "size", (F.col("q3") + F.greatest(
        (F.col("q3") - F.col("q1")) * FENCE, room)).cast("long").alias("fence"))


def _wide(f: DataFrame, group: list[str], suffix: str) -> DataFrame:
    """One row per group with a column ``<metric>_<suffix>``."""
    return f.groupBy(*group).agg(
        F.max("size").alias(f"size_{suffix}"),
        *[F.max(F.when(F.col("metric") == m, F.col("fence"))).alias(f"{m}_{suffix}")
          for m in METRICS])


def _blend(size: str, own: str, wider: str, floor: str = "DIV") -> str:
    """SQL of a group's fence: its own by its size, the wider one by PRIOR."""
    return f"({size} * {own} + {PRIOR} * {wider}) {floor} ({size} + {PRIOR})"


def apply_rules(docs: DataFrame, key: str = "doc_id", lang: str = "lang",
                source: str = "source", text: str = "text") -> DataFrame:
    """One row per document: key, base metrics, base_failed, the metrics,
    the fences used, kept.

    Null lang and null source are groups of their own; null text has no
    words and fails the base rules, an empty table gives no rows, repeated
    rows are judged alike, and other columns are not read. Quartiles are
    taken over the documents that pass the base rules.
    """
    source_rows = docs.select(
        F.col(key).alias("key"), F.coalesce(F.col(lang).cast("string"), F.lit("\0")).alias("lang"),
        F.coalesce(F.col(source).cast("string"), F.lit("\0")).alias("source"),
        F.col(text).alias("text"))
    rows = base_metrics(source_rows, ["key", "lang", "source"])
    rows = rows.withColumn("base_failed", base_failed()).withColumns(
        {m: _metric(parts) for m, (parts, _) in METRICS.items()})
    # A few numbers per document, read twice: staged, so that no text is
    # split again.
    rows = staged(rows, "quality-metrics")
    sketch = sketches(rows.where(~F.col("base_failed")))
    own = _wide(fences(sketch, ["lang", "source"]), ["lang", "source"], "own")
    langs = _wide(fences(sketch, ["lang"]), ["lang"], "lang")
    whole = _wide(fences(sketch.withColumn("corpus", F.lit(0)), ["corpus"]), ["corpus"], "all")
    limits = own.join(langs, "lang").withColumn("corpus", F.lit(0)).join(whole, "corpus")
    limits = limits.withColumns({f"{m}_lang": F.expr(_blend("size_lang", f"{m}_lang", f"{m}_all"))
                                 for m in METRICS})
    limits = limits.select("lang", "source", *[
        F.expr(_blend("size_own", f"{m}_own", f"{m}_lang")).alias(f"{m}_fence") for m in METRICS])
    # One group may hold a large part of all rows: its documents are dealt
    # over SALTS parts, each with a copy of the group's limits.
    salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    joined = rows.withColumn("salt", F.pmod(F.xxhash64("key", *METRICS), F.lit(SALTS)).cast("int"))
    joined = joined.join(salted, ["lang", "source", "salt"], "left").drop("salt")
    above = reduce(lambda a, b: a | b, [
        F.coalesce(F.col(m) > F.col(f"{m}_fence"), F.lit(False)) for m in METRICS])
    return joined.withColumn("kept", ~F.col("base_failed") & ~above)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = apply_rules(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols",
                      "n_dup_lines", "n_repeat_words", "base_failed", "kept",
                      *METRICS, *[f"{m}_fence" for m in METRICS])


def _sql_fences(group: tuple[str, ...]) -> str:
    """``fences`` and ``_wide`` of one level."""
    by = "".join(f"{c}, " for c in group)
    on = f"GROUP BY {', '.join(group)}" if group else ""
    room = "CASE metric " + " ".join(f"WHEN '{m}' THEN {METRICS[m][1]}" for m in METRICS) + " END"
    wide = ", ".join(f"max(fence) FILTER (WHERE metric = '{m}') AS {m}" for m in METRICS)
    return f"""
  SELECT {by}max(size) AS size, {wide} FROM (
    SELECT {by}metric, size, q3 + greatest((q3 - q1) * {FENCE}, {room}) AS fence
    FROM (
      SELECT {by}metric, size, {least_of('b1', '//')} AS q1, {least_of('b3', '//')} AS q3
      FROM (SELECT {by}metric, size, min(bin) FILTER (WHERE upto * 4 >= size) AS b1,
                   min(bin) FILTER (WHERE upto * 4 >= size * 3) AS b3
      FROM (
        SELECT {by}metric, bin, sum(n) OVER (PARTITION BY {by}metric ORDER BY bin) AS upto,
               sum(n) OVER (PARTITION BY {by}metric) AS size
        FROM (SELECT {by}metric, bin, count(*) AS n FROM sketch GROUP BY {by}metric, bin) a) b
      GROUP BY {by}metric, size) e) c) d {on}"""


_VALUES = ", ".join(f"CASE WHEN {b} > 0 THEN ({a}) // {b} ELSE 0 END AS {m}"
                    for m, ((a, b), _) in METRICS.items())
_PAIRS = ", ".join(f"{{'metric': '{m}', 'value': {m}}}" for m in METRICS)
_LIMITS = ", ".join(
    _blend("o.size", f"o.{m}", f"({_blend('l.size', f'l.{m}', f'w.{m}', '//')})", "//")
    + f" AS {m}_fence" for m in METRICS)
_ABOVE = " OR ".join(f"coalesce({m} > {m}_fence, false)" for m in METRICS)
_CAST = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *METRICS,
    *(f"{m}_fence" for m in METRICS)))
OP10_SQL = f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(lang, chr(0)) AS lang,
         coalesce(source, chr(0)) AS source, coalesce(text, '') AS text FROM documents),
split AS (
  SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')
              AS words,
         list_filter(string_split(text, chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM rows),
windows AS (
  SELECT r, i, array_to_string(words[i:i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT r, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM split) s),
repeated AS (
  SELECT r, sum(least({WINDOW}, coalesce(after - i, {WINDOW}))) AS n_repeat_words
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS after
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS k FROM windows) x
        WHERE k > 1) y GROUP BY r),
base AS (
  SELECT s.r, doc_id, lang, source, len(words) AS n_words,
         length(array_to_string(words, '')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         length(text) - length(translate(text, '{CAPITALS}', '')) AS n_capitals,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM split s LEFT JOIN repeated p ON s.r = p.r),
metrics AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
              AS base_failed, {_VALUES}
  FROM base),
sketch AS (
  SELECT lang, source, p.metric AS metric, {bin_of('p.value')} AS bin
  FROM (SELECT lang, source, unnest([{_PAIRS}]) AS p FROM metrics WHERE NOT base_failed) u),
own AS ({_sql_fences(("lang", "source"))}),
langs AS ({_sql_fences(("lang",))}),
corpus AS ({_sql_fences(())}),
limits AS (
  SELECT o.lang, o.source, {_LIMITS}
  FROM own o JOIN langs l ON o.lang = l.lang JOIN corpus w ON true)
SELECT doc_id, base_failed, NOT base_failed AND NOT ({_ABOVE}) AS kept, {_CAST}
FROM metrics m LEFT JOIN limits t ON m.lang = t.lang AND m.source = t.source"""
