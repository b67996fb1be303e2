"""Substring deduplication by level-wise doubling.

A word sequence of ``length`` words that starts in a document is removed
from every document with a larger id. Short windows are looked at first;
only windows repeated at one length are extended to about twice that
length, until the full length is reached or no candidate survives.

Levels 1 and 2 name what repeats in bitmaps of fixed size, so of their runs
only the different values that a task meets are shuffled; a value that passes
by chance is compared in full with the others.

* Level 1, a quarter of the length: of the short windows inside each full
  window only the one with the smallest hash (the leftmost of equals) is
  kept, its *anchor*. The choice depends on the full window's words alone,
  so equal full windows have equal anchors and none is lost; consecutive
  full windows mostly share one anchor (a *run*).
* Level 2, half of the length: the anchor extended to the left or to the
  right. Each full window contains one of the two.
* Level 3, the doubling carried on to whatever length repeats: runs that
  follow each other in a document are joined into *stretches*, as long as
  possible. A stretch that is the same in an earlier document goes at once.
* Level 4: the runs of the stretches that are left, compared in the same
  way. Where one anchor stands in several different runs, the first document
  of each run compares its full windows one by one.

Hashes are 64 bits wide and used in pairs from level 3 on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import broadcast_bitmap, in_bitmap
from ledgerlake.llm.common import (BASES, Ranges, batch, distinct, documents, grouped_words,
                                   merged, mix, signed,
                                   staged, text_words, word_hashes)

WINDOW = 50
# A null id sorts behind all others.
LAST = (1 << 63) - 1
# Windows whose least hash is taken at once.
BLOCK = 1 << 16
# Values a task looks through at a time for different ones.
HELD = 1 << 20


def runs_of(words: np.ndarray, bounds: np.ndarray, length: int):
    """text, start, count, anchor, left, right, run of every run of full
    windows in a group of texts (see ``grouped_words``)."""
    short = -(-length // 4)
    n = len(words)
    if n < length:
        return None
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(text[:n - length + 1] == text[length - 1:])
    if not len(at):
        return None
    h = Ranges(words, BASES[0])
    grams = np.arange(n - short + 1)
    grams = h(grams, grams + short)
    # argmin copies its windows: some of them at a time.
    views = sliding_window_view(grams, length - short + 1)
    smallest = np.concatenate([views[i:i + BLOCK].argmin(axis=1)
                               for i in range(0, len(views), BLOCK)])
    anchors = (smallest + np.arange(n - length + 1))[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchors[1:] != anchors[:-1]) | (text[at[1:]] != text[at[:-1]])
    first = np.flatnonzero(new)
    start, p = at[first], anchors[first]
    count = np.diff(np.append(first, len(at)))
    lo, hi = bounds[text[start]], bounds[text[start] + 1]
    # The run's own hash also stands in for an extension beyond the text.
    run = mix(Ranges(words, BASES[1])(start, start + count + (length - 1))
              + (p - start).astype(np.uint64))
    left = np.where(p - short >= lo, h(np.maximum(p - short, 0), p + short), run)
    right = np.where(p + 2 * short <= hi, h(p, np.minimum(p + 2 * short, n)), run)
    return text[start], start - lo, count, grams[p], left, right, run


_SEEN = pa.schema([("value", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
_SEEN_SQL = "value bigint, a bigint, b bigint"
_WINDOWS = pa.schema([("k", pa.int64()), ("row", pa.int64()), ("start", pa.int32()),
                      ("w1", pa.int64()), ("w2", pa.int64())])
_WINDOWS_SQL = "k bigint, row bigint, start int, w1 bigint, w2 bigint"


_RUN = pa.struct([("start", pa.int32()), ("count", pa.int32()), ("anchor", pa.int64()),
                  ("run", pa.int64())])
_STRETCH = pa.schema([("k", pa.int64()), ("row", pa.int64()), ("start", pa.int32()),
                      ("count", pa.int32()), ("s1", pa.int64()), ("s2", pa.int64()),
                      ("runs", pa.list_(_RUN))])
_STRETCH_SQL = ("k bigint, row bigint, start int, count int, s1 bigint, s2 bigint, "
                "runs array<struct<start:int,count:int,anchor:bigint,run:bigint>>")


def _stretches(keys: np.ndarray, rows: np.ndarray, text: np.ndarray, start: np.ndarray,
               count: np.ndarray, anchor: np.ndarray, run: np.ndarray) -> pa.RecordBatch:
    """Joins the runs that follow each other; a text's key and row are at its
    number. Equal stretches have the same runs in the same order: a run's hash
    covers its words, and each run begins one word after the windows of the
    one before."""
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1] + count[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(start))
    total = start[end - 1] + count[end - 1] - start[at]
    hashes = [signed(Ranges(x, base)(at, end)) for x, base in zip((anchor, run), BASES)]
    runs = pa.StructArray.from_arrays(
        [pa.array(start, pa.int32()), pa.array(count, pa.int32()), pa.array(signed(anchor)),
         pa.array(signed(run))], fields=list(_RUN))
    offsets = pa.array(np.append(at, len(start)), pa.int32())
    return pa.RecordBatch.from_arrays([
        pa.array(keys[text[at]]), pa.array(rows[text[at]]), pa.array(start[at], pa.int32()),
        pa.array(total, pa.int32()), *map(pa.array, hashes),
        pa.ListArray.from_arrays(offsets, runs)], schema=_STRETCH)


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """k orders the documents; row identifies a text under its key (rows
    that repeat both get the same result)."""
    k = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST))
    body = F.col(text).cast("string")
    return docs.select(F.col(key).cast("bigint").alias("key"), k.alias("k"),
                       F.xxhash64(k, body).alias("row"), body.alias("text"))


def _runs(batches: Iterator[pa.RecordBatch], length: int):
    """(keys, rows, runs) of the texts (k, row, text), some texts at a time."""
    for b in batches:
        keys, rows = b.column(0).to_numpy(), b.column(1).to_numpy()
        done = 0
        for words, bounds in grouped_words(b.column(2)):
            got = runs_of(words, bounds, length)
            if got is not None:
                yield keys[done:], rows[done:], got
            done += len(bounds) - 1


def _seen(length: int, anchors: Broadcast | None):
    """(value, a, b): the anchors, or the extensions of the anchors in the
    bitmap, with the smallest and the largest key that a task met them at."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def met() -> pa.RecordBatch:
            value, k = map(np.concatenate, zip(*held))
            order = np.lexsort((k, value))
            value, k = value[order], k[order]
            first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            last = np.append(first[1:], len(value)) - 1
            return batch(_SEEN, signed(value[first]), k[first], k[last])

        for keys, _, (text, _, _, anchor, left, right, _) in _runs(batches, length):
            k = keys[text]
            if anchors is None:
                held.append((anchor, k))
            else:
                hit = in_bitmap(anchors.value, anchor)
                held += [(left[hit], k[hit]), (right[hit], k[hit])]
            size += len(held[-1][0])
            if size >= HELD:
                yield met()
                held, size = [], 0
        if size:
            yield met()
    return run


def _repeated(texts: DataFrame, length: int, anchors: Broadcast | None, name: str) -> Broadcast:
    """Bitmap of the values of ``_seen`` that stand in at least two documents."""
    seen = texts.mapInArrow(_seen(length, anchors), _SEEN_SQL)
    values = staged(seen.groupBy("value").agg(F.min("a").alias("a"), F.max("b").alias("b"))
                    .where("a < b").select("value"), name)
    return broadcast_bitmap(values, F.col("value"))


def repeated_ranges(docs: DataFrame, length: int = WINDOW, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(row, start, end): word ranges to remove, each a union of full
    windows that also start in a document with a smaller key."""
    texts = _texts(docs, key, text)
    runs = texts.select("k", "row", "text")
    # Levels 1 and 2.
    anchors = _repeated(runs, length, None, "substring-short")
    sides = _repeated(runs, length, anchors, "substring-sides")

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, rows, (text, start, count, anchor, left, right, run) in _runs(batches, length):
            hit = in_bitmap(anchors.value, anchor)
            hit &= in_bitmap(sides.value, left) | in_bitmap(sides.value, right)
            if hit.any():
                yield _stretches(keys, rows, *(x[hit] for x in (text, start, count, anchor, run)))

    # Level 3: a document's runs come together; stretches by their first
    # document. Later ones with the same stretch have nothing else in it.
    stretches = staged(runs.mapInArrow(merged(joined, _STRETCH), _STRETCH_SQL),
                       "substring-stretches")
    leader = staged(stretches.groupBy("s1", "s2").agg(F.min("k").alias("first")),
                    "substring-leaders")
    ruled = staged(stretches.join(leader, ["s1", "s2"]), "substring-ruled")
    long = ruled.where("first < k").select(
        "row", "start", (F.col("start") + F.col("count") + (length - 1)).alias("end"))
    level3 = staged(ruled.where("first = k").select("k", "row", F.inline("runs")),
                    "substring-runs4")
    # Level 4: the first document of each run, and anchors with several runs.
    first = staged(level3.groupBy("anchor", "run").agg(F.min("k").alias("first")),
                   "substring-first")
    several = staged(first.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                     .select("anchor", F.lit(True).alias("several")), "substring-several")
    judged = staged(level3.join(first, ["anchor", "run"]).join(several, "anchor", "left")
                    .select("k", "row", "start", "count", "several",
                            (F.col("first") < F.col("k")).alias("covered")), "substring-judged")
    whole = judged.where("covered").select(
        "row", "start", (F.col("start") + F.col("count") + (length - 1)).alias("end"))
    # Documents that were first with their run still compare window by window.
    asked = (judged.where("not covered and several").groupBy("k", "row")
             .agg(F.collect_set(F.struct("start", "count")).alias("runs")))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, row, t, asked_runs in zip(*(c.to_pylist() for c in b.columns)):
                words = word_hashes(t)
                at = distinct(np.concatenate(
                    [np.arange(r["start"], r["start"] + r["count"]) for r in asked_runs]))
                yield batch(_WINDOWS, np.full(len(at), k), np.full(len(at), row),
                            at.astype(np.int32),
                            *(signed(Ranges(words, base)(at, at + length)) for base in BASES))

    full = staged(texts.select("row", "text").join(asked, "row")
                  .select("k", "row", "text", "runs")
                  .mapInArrow(merged(windows, _WINDOWS), _WINDOWS_SQL), "substring-windows")
    earlier = staged(full.groupBy("w1", "w2").agg(F.min("k").alias("first"), F.max("k").alias("z"))
                     .where("first < z").drop("z"), "substring-earlier")
    single = (full.join(earlier, ["w1", "w2"]).where("first < k")
              .select("row", "start", (F.col("start") + length).alias("end")))
    return long.unionByName(whole).unionByName(single)


_OUT = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                  ("kept", pa.string())])
_OUT_SQL = "key bigint, n_words bigint, n_removed bigint, kept string"


def remove_repeats(docs: DataFrame, length: int = WINDOW, key: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """One row per document: key, n_words, n_removed, kept (the words that
    stay, joined by one space).

    Null or empty text has no words. A null key counts as larger than all
    others, so such documents lose what any keyed document has and nothing
    to each other; rows that repeat a key and text get the same result and
    rows of one key lose nothing to each other. Other columns are not read;
    no rows give no rows.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in _OUT]
            for k, t, found in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                words = text_words(t.as_py())
                kept = _kept(words, found.as_py())
                for c, v in zip(columns, (k, len(words), len(words) - len(kept),
                                          b" ".join(kept).decode())):
                    c.append(v)
            yield batch(_OUT, *columns)

    return (_texts(docs, key, text).join(_by_row(docs, length, key, text), "row", "left")
            .select("key", "text", "ranges").mapInArrow(cut, _OUT_SQL))


def _by_row(docs: DataFrame, length: int, key: str, text: str) -> DataFrame:
    return (repeated_ranges(docs, length, key, text).groupBy("row")
            .agg(F.collect_set(F.struct("start", "end")).alias("ranges")))


def _kept(words: list[bytes], ranges: list[dict] | None) -> list[bytes]:
    if not ranges:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, [r["start"] for r in ranges], 1)
    np.add.at(edges, [r["end"] for r in ranges], -1)
    return list(compress(words, np.cumsum(edges[:-1]) == 0))


def without_repeats(docs: DataFrame, length: int = WINDOW, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of ``text``, all columns
    kept. A text that loses nothing stays as it is; others become their
    kept words joined by one space."""
    at = docs.columns.index(text)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = b.column(b.num_columns - 1)
            texts = [t.as_py() if not r.is_valid else
                     b" ".join(_kept(text_words(t.as_py()), r.as_py())).decode()
                     for t, r in zip(b.column(at), found)]
            columns = b.columns[:-1]
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(b.schema)[:-1]))

    ranges = _by_row(docs, length, key, text).select(
        F.col("row").alias("__row"), F.col("ranges").alias("__ranges"))
    k = F.coalesce(F.col(key).cast("bigint"), F.lit(LAST))
    return (docs.withColumn("__row", F.xxhash64(k, F.col(text).cast("string")))
            .join(ranges, "__row", "left").drop("__row").mapInArrow(cut, docs.schema))


OP3_SQL = rf"""
WITH words AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda w: w <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + {WINDOW - 1}), ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, (len(w) - {WINDOW - 2})::BIGINT)) AS i FROM words)),
firsts AS (SELECT h, min(doc_id) AS least FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + {WINDOW})) AS p
  FROM windows JOIN firsts USING (h) WHERE least < doc_id),
places AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (
  SELECT s.doc_id, count(g.p) AS n_removed,
         string_agg(word, ' ' ORDER BY s.p) FILTER (WHERE g.p IS NULL) AS words
  FROM places s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p GROUP BY s.doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        F.col("key").alias("doc_id"), "n_words", "n_removed",
        F.sha2("kept", 256).alias("kept_sha256"))
