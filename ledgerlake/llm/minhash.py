"""Near duplicates by fast similarity sketching.

A document is the set of its word shingles; equal sets form one class. A
sketch has a fixed number of coordinates (bins). In round i every shingle is
hashed to one bin and a value; a bin keeps the least value of the first
round that reaches it. A large set fills all bins in a few rounds, where
MinHash would hash every shingle once per coordinate. Should bins stay empty
after as many rounds as there are bins, a second series of rounds aims at
one bin each, so that every coordinate is always filled. Coordinates of two
sets agree with a probability equal to their similarity, and the share that
agrees is concentrated as for independent ones.

Bands of coordinates are the buckets: 30 bands of 5 miss a pair of
similarity 0.8 with a probability of 7e-6. Candidates are verified on their
full sets:

1. a few times, every class against the stars of its buckets, so that groups
   of copies become components without all their pairs;
2. all pairs of classes that share a bucket and are still in different
   components, for buckets of up to ``LISTED`` classes;
3. the classes of larger buckets by an exact join among themselves, which
   finds each of their similar pairs without forming all pairs of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard
from ledgerlake.llm.common import (batch, documents, mix, shingle_sets, signed, staged, sweep,
                                   tidy)

SHINGLE = 4
PERCENT = 80
BANDS, ROWS = 30, 5
# Classes of a bucket that are compared pair by pair.
LISTED = 32
# Rounds of stars; what they leave is found in steps 2 and 3.
ROUNDS = 1
# Shingles sketched at a time.
SKETCHED = 1 << 16
_EMPTY = np.uint64((1 << 64) - 1)


def sketches(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """One row of ``coordinates`` values for each set (none of them empty)."""
    shingles = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    out = np.full(len(sets) * coordinates, _EMPTY)
    for i in range(2 * coordinates):
        h = mix(shingles ^ mix(np.array([i + 1], np.uint64)))
        if i < coordinates:
            place = ((h >> np.uint64(32)) * np.uint64(coordinates) >> np.uint64(32)).astype(np.int64)
        else:
            place = np.int64(i - coordinates)
        # Later rounds have larger values and leave filled bins alone.
        value = (h & np.uint64((1 << 48) - 1)) | np.uint64(i << 48)
        np.minimum.at(out, owner * coordinates + place, value)
        open_ = (out.reshape(len(sets), -1) == _EMPTY).any(axis=1)
        if not open_.any():
            break
        go_on = open_[owner]
        if not go_on.all():
            shingles, owner = shingles[go_on], owner[go_on]
    return out.reshape(len(sets), coordinates)


def band_keys(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of every sketch."""
    keys = np.zeros((len(sketch), bands), np.uint64)
    keys += np.arange(1, bands + 1, dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys) + sketch[:, r:bands * rows:rows]
    return mix(keys)


_PROFILE = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
                      ("c", pa.int64()), ("odd", pa.list_(pa.int64())),
                      ("bands", pa.list_(pa.int64()))])
_PROFILE_SQL = "key bigint, h bigint, n bigint, c bigint, odd array<bigint>, bands array<bigint>"


def _profile(shingle: int, bands: int, rows: int):
    """Per document (key, h, text) its set size, class and odd sketch, and
    the band keys where the task meets the class for the first time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # bounded; bands may be sent again
        for b in batches:
            sizes, classes, odd, keys = [], [], [], [None] * b.num_rows
            held, places, size = [], [], 0

            def sketched() -> None:
                for at, row in zip(places, signed(band_keys(
                        sketches(held, bands * rows), bands, rows))):
                    keys[at] = row
            for at, s in enumerate(shingle_sets(b.column(2), shingle)):
                sizes.append(len(s))
                c = jaccard.set_id(s) if len(s) else None
                classes.append(c)
                odd.append(None if c is None else jaccard.odd_sketch(s))
                if c is None or c in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(c)
                held.append(s)
                places.append(at)
                size += len(s)
                if size >= SKETCHED:
                    sketched()
                    held, places, size = [], [], 0
            if held:
                sketched()
            yield batch(_PROFILE, b.column(0), b.column(1), sizes, classes, odd, keys)
    return run


def _buckets(profile: DataFrame) -> DataFrame:
    """(token, c, n, popular): the buckets of each class that it shares with
    others; popular counts the classes met there."""
    bands = profile.where("bands is not null").select("c", "n", F.explode("bands").alias("token"))
    shared = staged(bands.groupBy("token").agg(F.min("c").alias("a"), F.max("c").alias("z"),
                                               F.count(F.lit(1)).alias("k"))
                    .where("a < z").select("token", "k"), "minhash-buckets")
    kept = staged(bands.join(shared, "token").groupBy("token", "c", "n")
                  .agg(F.max("k").alias("k")), "minhash-postings")
    popular = staged(kept.groupBy("c").agg(F.sum("k").alias("popular")), "minhash-popular")
    return staged(kept.join(popular, "c").drop("k"), "minhash-postings")


def _links(texts: DataFrame, profile: DataFrame, percent: int, shingle: int) -> DataFrame:
    """Links (a, b) of classes that connect every pair of similar sets that
    meet in a bucket."""
    postings = _buckets(profile)
    links = postings.select(F.col("c").alias("a"), F.col("c").alias("b")).where(F.lit(False))
    linked = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    sets = None
    for turn in range(ROUNDS):
        with tidy(texts.sparkSession) as made:
            found = sweep(made, jaccard.stars(jaccard.across(postings, linked), turn, F.lit(True)),
                          "minhash-stars")
        if sets is None:
            sets = jaccard.sets_of(found.select(F.explode(F.array("a", "b")).alias("c")), texts,
                                   shingle)
        new = jaccard.verified(found, sets, percent)
        if new.isEmpty():
            break
        links = links.unionByName(new)
        linked = jaccard.linked_by(links)

    left = jaccard.across(postings, linked)
    size = staged(left.groupBy("token").agg(F.count(F.lit(1)).alias("k")), "minhash-sizes")
    small = staged(left.join(size.where(F.col("k") <= LISTED), "token")
                   .join(jaccard.odd_sketches(profile), "c"), "minhash-small")
    other = small.select(*[F.col(x).alias(f"{x}2") for x in ("token", "c", "n", "comp", "odd")])
    pairs = staged(small.join(other, (F.col("token") == F.col("token2"))
                              & (F.col("c") < F.col("c2")) & (F.col("comp") != F.col("comp2"))
                              & (F.col("n") * 100 >= F.col("n2") * percent)
                              & (F.col("n2") * 100 >= F.col("n") * percent)
                              & jaccard.may_link(percent))
                   .select(F.col("c").alias("a"), F.col("c2").alias("b")).distinct(),
                   "minhash-pairs")
    large = staged(left.join(size.where(F.col("k") > LISTED), "token").select("c").distinct(),
                   "minhash-large")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("c")).unionByName(large)
    rest = jaccard.sets_of(wanted, texts, shingle)
    links = links.unionByName(jaccard.verified(pairs, rest, percent))
    if large.isEmpty():
        return links
    crowded = staged(rest.join(large, "c", "left_semi"), "minhash-crowded")
    return links.unionByName(jaccard.links_among(
        crowded.select("shingles"),
        jaccard.profile_of(crowded.select("c", F.lit(None).cast("bigint"), "shingles"), shingle),
        percent, shingle, crowded, linked, rounds=0))


def _groups(docs: DataFrame, percent: int, shingle: int, key: str, text: str
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = jaccard.keyed_texts(docs, key, text)
    profile = staged(rows.mapInArrow(_profile(shingle, BANDS, ROWS), _PROFILE_SQL),
                     "minhash-profile")
    every = profile.select("key", "h", "n", "c")
    links = _links(rows.select("text"), profile, percent, shingle)
    return (every, *jaccard.grouped(every, links))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                    key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n (set size), class (the smallest key with
    an equal set), component (the smallest key that links reach, itself
    included), kept (whether the key names its component).

    Texts are lower-cased in A-Z and read whole. Null or blank texts have an
    empty set, no class and no links, and are kept. A null key never names a
    component that has another key; rows that repeat a key and text share
    their result. Other columns are not read; no rows give no rows.
    """
    with tidy(docs.sparkSession) as made:
        out = jaccard.named(*_groups(docs, percent, shingle, key, text))
        return sweep(made, out.withColumn("kept", F.col("key").eqNullSafe(F.col("component"))),
                     "minhash-components")


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                            key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less near duplicates, all columns kept: of each
    component the first by key (null keys last, equal keys by text hash,
    equal rows one). Texts without words stay."""
    with tidy(docs.sparkSession) as made:
        _, _, groups = _groups(docs, percent, shingle, key, text)
        groups = sweep(made, groups, "minhash-groups")
    return jaccard.keep_first_of_each(docs, groups, key, text)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"), "kept",
                      F.col("class").alias("class_id"))


OP12_SQL = f"""WITH RECURSIVE {jaccard.components_sql(SHINGLE, PERCENT)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept, class_id FROM named"""
