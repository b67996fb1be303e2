"""Benchmark decontamination by SimHash windows.

Every benchmark item has a 64-bit SimHash over its words. A document is
compared through windows as long as an item; a text shorter than an item is
one window as a whole. Multi-index Hamming blocks find near fingerprints: 64
bits in 10 blocks, so two fingerprints that differ in at most ``RADIUS`` = 19
bits have a block that differs in at most one bit, and all such blocks of the
items are listed. Every pair that meets in a block is a candidate, also
beyond ``RADIUS``, and is verified by the exact similarity of its word
shingles, weighted by their length in bytes.

The similarity does not bound the bits, so a similar pair may miss all
blocks (the README has the recall measured). With ``exact`` pairs that share
a shingle of both prefixes are candidates as well: the shingles of a set, in
the order of their hashes, up to where the rest alone is below the
similarity. Two sets that reach it have their first common shingle in both
prefixes, so no pair is lost.

Windows are fingerprinted where they can be similar at all: a window that
reaches the similarity has that share of its shingle weight in common with
one item, hence with all items of that size, which a bitmap of fixed size
answers (unrelated shingles that share a bit only add windows). Repeats of an
unknown shingle in a window count once at most, those of a known one each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import broadcast_bitmap, in_bitmap
from ledgerlake.llm.common import (BASES, Ranges, batch, documents, grouped_words, merged, signed,
                                   staged, text_words)

SHINGLE = 5
# Weighted Jaccard similarity in hundredths.
PERCENT = 75
# First bit and width of the blocks of a fingerprint.
BLOCKS = (*((k, 7) for k in range(0, 28, 7)), *((k, 6) for k in range(28, 64, 6)))
# Each block may differ in one bit: all pairs up to 2 x 10 - 1 bits meet.
RADIUS = 2 * len(BLOCKS) - 1
# Distinct window sizes per pass over the documents.
SIZES = 256
# Shingles are in the bitmap as they are, and once more with their item's
# size times this odd number in their bits.
SIZED = 0x9E3779


def byte_lengths(text: str | None) -> np.ndarray:
    return np.array([len(w) for w in text_words(text)], np.int64)


class Fingerprints:
    """SimHashes of windows of one stretch of words: each bit is the sign of
    the summed weights of the words with and without it."""

    def __init__(self, words: np.ndarray, weights: np.ndarray):
        bits = np.unpackbits(words.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        self._sums = np.zeros((len(words) + 1, 64), np.int64)
        np.cumsum((bits.astype(np.int64) * 2 - 1) * weights[:, None], axis=0, out=self._sums[1:])

    def __call__(self, starts: np.ndarray, size: int) -> np.ndarray:
        ones = self._sums[starts + size] - self._sums[starts] > 0
        return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()


def _shingles(words: np.ndarray, weights: np.ndarray, length: int):
    """Hash and weight (bytes) of every shingle of consecutive words."""
    n = max(0, len(words) - length + 1)
    at = np.arange(n)
    sums = np.concatenate([[0], np.cumsum(weights)])
    return Ranges(words, BASES[0])(at, at + length), sums[at + length] - sums[at]


_ITEM = pa.schema([("item_id", pa.int64()), ("size", pa.int32()), ("fingerprint", pa.int64()),
                   ("shingles", pa.list_(pa.int64())), ("weights", pa.list_(pa.int64())),
                   ("prefix", pa.list_(pa.int64()))])
_ITEM_SQL = ("item_id bigint, size int, fingerprint bigint, shingles array<bigint>, "
             "weights array<bigint>, prefix array<bigint>")


def _distinct_shingles(hashes: np.ndarray, weights: np.ndarray):
    values, first = np.unique(hashes, return_index=True)
    return signed(values), weights[first]


def _prefix(values: np.ndarray, weights: np.ndarray, percent: int) -> np.ndarray:
    """The least first part of distinct shingles without which too little
    weight is left to be similar."""
    rest = weights.sum() - np.cumsum(weights)
    return values[:int(np.argmax(rest * 100 < weights.sum() * percent)) + 1]


def _items(percent: int):
    """Fingerprint, distinct shingles and prefix of every item with a word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns: list[list] = [[] for _ in _ITEM]
            texts = b.column(1).to_pylist()
            ids, done = b.column(0).to_pylist(), 0
            for words, bounds in grouped_words(texts, lower=True):
                for a, z in pairwise(bounds.tolist()):
                    w, own = byte_lengths(texts[done]), words[a:z]
                    if len(own):
                        values, weights = _distinct_shingles(
                            *_shingles(own, w, min(SHINGLE, len(own))))
                        mark = Fingerprints(own, w)(np.array([0]), len(own))
                        for c, v in zip(columns, (ids[done], len(own), int(signed(mark)[0]), values,
                                                  weights, _prefix(values, weights, percent))):
                            c.append(v)
                    done += 1
            yield batch(_ITEM, *columns)
    return run


# ``size`` is the items' size, ``words`` the window's own.
_WINDOW = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("size", pa.int32()),
                     ("words", pa.int32()), ("fingerprint", pa.int64()),
                     ("shingles", pa.list_(pa.int64())),
                     ("weights", pa.list_(pa.int64())), ("prefix", pa.list_(pa.int64()))])
_WINDOW_SQL = "doc bigint, start int, size int, words int, fingerprint bigint, " \
              "shingles array<bigint>, weights array<bigint>, prefix array<bigint>"


def _windows(sizes: list[int], bitmap, percent: int):
    """Item-sized windows that have enough of their weight in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, texts, done = b.column(0).to_pylist(), b.column(1), 0
            for words, bounds in grouped_words(texts, lower=True):
                marked = _marked(words, sizes, bitmap.value)
                for a, z in pairwise(bounds.tolist()):
                    if marked[z] > marked[a]:
                        yield from _document(docs[done], words[a:z], byte_lengths(texts[done].as_py()),
                                             sizes, bitmap.value, percent)
                    done += 1
    return run


def _lengths(sizes: list[int]) -> list[int]:
    """Shingle lengths of items of these sizes: short items are one shingle."""
    return sorted({min(SHINGLE, s) for s in sizes})


def _marked(words: np.ndarray, sizes: list[int], bitmap: np.ndarray) -> np.ndarray:
    """Number of words before each at which some shingle is in the bitmap."""
    ranges, hit = Ranges(words, BASES[0]), np.zeros(len(words), bool)
    for length in _lengths(sizes):
        at = np.arange(max(0, len(words) - length + 1))
        hit[:len(at)] |= in_bitmap(bitmap, ranges(at, at + length))
    return np.concatenate([[0], np.cumsum(hit)])


def _gaps(hashes: np.ndarray) -> np.ndarray:
    """How far back each shingle was seen before (beyond the text: never)."""
    gaps = np.full(len(hashes), len(hashes) + 1)
    order = np.argsort(hashes, kind="stable")
    again = hashes[order[1:]] == hashes[order[:-1]]
    gaps[order[1:][again]] = np.diff(order)[again]
    return gaps


def _document(doc: int | None, words: np.ndarray, weights: np.ndarray, sizes: list[int],
              bitmap: np.ndarray, percent: int) -> Iterator[pa.RecordBatch]:
    by_length = {}
    for length in _lengths(sizes):
        hashes, heavy = _shingles(words, weights, length)
        by_length[length] = hashes, heavy, np.flatnonzero(in_bitmap(bitmap, hashes)), _gaps(hashes)
    for size in sizes:
        length = min(SHINGLE, size)
        if length > len(words):
            break
        hashes, heavy, known, gaps = by_length[length]
        known = known[in_bitmap(bitmap, hashes[known] ^ np.uint64(SIZED * size))]
        if not len(known):
            continue
        own_size = min(size, len(words))
        per = own_size - length + 1
        # Only windows with a known shingle.
        first, last = max(0, known[0] - per + 1), min(known[-1], len(words) - own_size)
        at = np.arange(first, last + 1)
        ours = np.zeros(last - first + per, np.int64)
        ours[known - first] = heavy[known]
        others = np.where(gaps[first:last + per] >= per, heavy[first:last + per], 0)
        others[known - first] = 0
        shared, alien = (np.concatenate([[0], np.cumsum(x)]) for x in (ours, others))
        shared, alien = (x[per:] - x[:-per] for x in (shared, alien))
        at = at[(shared > 0) & (shared * (100 - percent) >= alien * percent)]
        # Stretches of the text keep the sums of fingerprints small.
        for some in np.split(at, np.flatnonzero(np.diff(at // 4096)) + 1):
            if len(some):
                a, z = int(some[0]), int(some[-1]) + own_size
                marks = Fingerprints(words[a:z], weights[a:z])(some - a, own_size)
                own = some[:, None] + np.arange(per)
                sets = [_distinct_shingles(hashes[x], heavy[x]) for x in own]
                yield pa.RecordBatch.from_arrays([
                    pa.array([doc] * len(some), pa.int64()), pa.array(some.astype(np.int32)),
                    pa.array(np.full(len(some), size, np.int32)),
                    pa.array(np.full(len(some), own_size, np.int32)), pa.array(signed(marks)),
                    *(pa.array(x, pa.list_(pa.int64())) for x in zip(*sets)),
                    pa.array([_prefix(*x, percent) for x in sets], pa.list_(pa.int64()))], schema=_WINDOW)


def _blocks(mark: str, flips: bool):
    """array<struct<block, value>> of a fingerprint; with ``flips`` also the
    values that differ in one bit."""
    out = []
    for k, (first, width) in enumerate(BLOCKS):
        value = F.shiftrightunsigned(F.col(mark), first).bitwiseAND(F.lit((1 << width) - 1))
        for change in [0, *[1 << i for i in range(width)]] if flips else [0]:
            out.append(F.struct(F.lit(k).alias("block"),
                                value.bitwiseXOR(F.lit(change)).alias("value")))
    return F.array(*out)


def contamination(docs: DataFrame, items: DataFrame, percent: int = PERCENT,
                  key: str = "doc_id", text: str = "text", item: str = "item_id",
                  exact: bool = False) -> DataFrame:
    """One row per contaminated place: doc (row key), item_id, start, size
    (words), similarity; the most similar window of each document and item.
    A document with fewer words than the item is compared as a whole.
    Candidates meet in fingerprint blocks; ``exact`` adds those that share a
    prefix shingle, so that none is lost.

    Words are compared with A-Z lowered. Items without a word match
    nothing, items below five words are one shingle; null text has no
    words; null keys are kept as null; repeated rows are found alike; other
    columns are not read; with no items or no documents there are no rows.
    """
    marked = staged(items.select(F.col(item).cast("bigint"), F.col("text").cast("string"))
                    .mapInArrow(_items(percent), _ITEM_SQL), "decontaminate-items")
    # The shingles, and the shingles of each size of item.
    sized = F.transform("shingles", lambda s: s.bitwiseXOR(F.col("size").cast("bigint") * SIZED))
    bitmap = broadcast_bitmap(marked.select(F.explode(F.concat("shingles", sized)).alias("s")),
                              F.col("s"))
    sizes = sorted(r[0] for r in marked.select("size").distinct().collect())
    texts = docs.select(F.col(key).cast("bigint").alias("doc"),
                        F.col(text).cast("string").alias("text"))
    listed = marked.select("item_id", "size", F.inline(_blocks("fingerprint", True)))
    heads = marked.select("item_id", "size", F.explode("prefix").alias("s"))
    found = None
    for lo in range(0, len(sizes), SIZES):
        windows = staged(texts.mapInArrow(merged(_windows(sizes[lo:lo + SIZES], bitmap, percent),
                                                 _WINDOW), _WINDOW_SQL), "decontaminate-windows")
        at = ["doc", "start", "size"]
        near = (windows.select(*at, F.inline(_blocks("fingerprint", False)))
                .join(listed, ["block", "value", "size"]).select(*at, "item_id"))
        if exact:
            near = near.union(windows.select(*at, F.explode("prefix").alias("s"))
                              .join(heads, ["s", "size"]).select(*at, "item_id"))
        near = near.select(F.col("doc").alias("d"), F.col("start").alias("at"),
                           F.col("size").alias("n"), "item_id").distinct()
        pairs = (windows.join(near, F.col("doc").eqNullSafe(F.col("d"))
                              & (F.col("start") == F.col("at")) & (F.col("size") == F.col("n")))
                 .drop("d", "at", "n", "fingerprint", "prefix"))
        pairs = pairs.join(marked.select("item_id", F.col("shingles").alias("theirs"),
                                         F.col("weights").alias("their_weights")), "item_id")
        found = pairs if found is None else found.unionByName(pairs)
    if found is None:
        return texts.sparkSession.createDataFrame(
            [], "doc bigint, item_id bigint, start int, size int, similarity double")

    def total(weights):
        return F.aggregate(weights, F.lit(0).cast("bigint"), lambda acc, w: acc + w)

    # Pairs of a block without a common shingle go before they are weighed.
    found = found.where(F.arrays_overlap("shingles", "theirs"))
    pairs = F.arrays_zip("shingles", "weights")
    common = total(F.transform(F.filter(pairs, lambda p: F.array_contains(
        F.col("theirs"), p["shingles"])), lambda p: p["weights"]))
    scored = found.withColumns({
        "common": common,
        "whole": total(F.transform(pairs, lambda p: p["weights"]))
        + total(F.col("their_weights")) - common})
    best = F.max_by(F.struct("start", F.col("words").alias("size")), F.struct(
        F.col("common") / F.col("whole"), -F.col("start"))).alias("best")
    return (scored.where(F.col("common") * 100 >= F.col("whole") * percent)
            .groupBy("doc", "item_id")
            .agg(best, F.max(F.col("common") / F.col("whole")).alias("similarity"))
            .select("doc", "item_id", "best.start", "best.size", "similarity"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated (document, item), with its best window."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return contamination(documents(spark, sf_dir), items).select(
        F.col("doc").alias("doc_id"), "item_id", "start", "size",
        F.round("similarity", 6).alias("similarity"))


def clean_documents(docs: DataFrame, items: DataFrame, key: str = "doc_id",
                    exact: bool = False) -> DataFrame:
    """The documents without a contaminated place, all columns kept. A
    document without a key cannot be named and stays."""
    hit = staged(contamination(docs, items, key=key, exact=exact).where("doc is not null")
                 .select(F.col("doc").alias(key)).distinct(), "decontaminate-hit")
    return docs.join(hit, key, "left_anti")
