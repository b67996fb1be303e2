"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its word shingles; equal sets form one class. All
classes order their shingles alike, by frequency and hash, rare ones first;
the frequent ones (a bounded list) that were counted most often are *heavy*,
the others *light*. Two sets of
n <= n' shingles that are similar enough (at least t) share

* at least a' = ceil(t n') shingles, and at least b = ceil(2 t n / (1 + t)).

So for every m the first n - b + m shingles of the smaller and the first
n' - a' + m of the larger set have m in common. A class chooses its own m:
where its prefix would meet many others it is lengthened, and a partner has
to share as many more shingles of the prefix before the pair is verified (a
pair has to meet the smaller m of its two classes). A prefix is lengthened
within its light part only. A set with fewer than a heavy shingles has a
light prefix throughout. Only where nearly the whole set is heavy does the
prefix reach into that part, with m = 1; a pair that meets there alone has
no light shingle in common, so the smaller number of heavy shingles bounds
its overlap. Heavy shingles are thus join keys for few classes, and for
pairs that can still be similar.

Links are found in two steps, because a component needs no more links than
hold it together:

1. a few times, one class of every posting list is its star, and every
   class is verified against the stars that share most of its prefix; the
   links form components, and the next stars are tried across components;
2. all candidate pairs from different components that are left are verified.
   Posting lists with the same members are merged first, and a pair only
   counts where the sketches of both whole sets, as long as the sets are
   large, allow a link.

No pair within a component is lost by that, and a large group of copies is
never expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import broadcast_bitmap, in_bitmap
from ledgerlake.llm.common import (batch, documents, mix, shingle_sets, signed, staged, sweep,
                                   tidy)
from ledgerlake.llm.components import components

SHINGLE = 5
# Similarity in hundredths.
PERCENT = 75
# How many common shingles a class may ask for.
MATCHES = (1, 2, 4, 8)
# A pair costs as much to verify as so many postings cost to merge.
VERIFY_COST = 50
# Shingles in at least this share of all postings (and counted at least so
# often) are ordered by frequency; there can be at most 1 / HOT of them (2
# million, 32 MB). Those counted HEAVY times are the heavy ones.
HOT = 5e-7
LEAST_HOT = 3
HEAVY = 32
# Shingles a task counts at a time when it looks for frequent ones.
COUNTED = 1 << 21
# Rounds of stars, and stars a class is verified against in each. Whatever
# they leave is found in step 2.
ROUNDS = 1
STARS = 3
# Stars share at least this part of the set in the prefix; weaker pairs wait
# for step 2.
STAR_PERCENT = 10
# A null key sorts behind all others.
LAST = (1 << 63) - 1


def set_id(shingles: np.ndarray) -> int:
    """64-bit id of a set (signed): equal sets have equal ids."""
    size = np.array([len(shingles)], np.uint64)
    total, other = np.add.reduce(shingles), np.bitwise_xor.reduce(shingles)
    return int(signed(mix(mix(size + total) + other))[0])


def _sets_in(b: pa.RecordBatch, column: int, shingle: int) -> Iterator[np.ndarray]:
    """The shingle sets of a column of texts, or of a column of sets."""
    c = b.column(column)
    if not pa.types.is_list(c.type):
        yield from shingle_sets(c, shingle)
        return
    values = c.values.to_numpy().view(np.uint64)
    ends = c.offsets.to_numpy()
    for i in range(len(c)):
        yield values[ends[i]:ends[i + 1]]


# Longs of the odd sketch of a set: a bit is the parity of the shingles that
# fall on it, so two sets differ in no fewer shingles than their sketches in
# bits. With 1,024 bits sets of some hundred shingles pass little below the
# threshold.
ODD = 16
# Sketches of larger sets have a bit for each shingle, up to so many longs:
# one that is full says nothing. Both halves of a sketch together are the
# sketch of half its length.
WIDE = 128


def odd_sketch(shingles: np.ndarray, longs: int = ODD) -> np.ndarray:
    bits = np.bincount((shingles & np.uint64(64 * longs - 1)).astype(np.int64),
                       minlength=64 * longs) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> np.ndarray:
    """Odd sketch of ODD to WIDE longs, a power of two, by the set's size."""
    longs = 1 << (-(-len(shingles) // 64) - 1).bit_length()
    return odd_sketch(shingles, min(WIDE, max(ODD, longs)))


def may_link(percent: int, wide: bool = False) -> Column:
    """Whether the odd sketches of two sets (n, odd and n2, odd2) allow a
    similarity of ``percent``; ``wide`` ones differ in length."""
    apart = reduce(Column.__add__, [
        F.bit_count(F.col("odd")[i].bitwiseXOR(F.col("odd2")[i])) for i in range(ODD)])
    if wide:
        here, there = F.size("odd"), F.size("odd2")
        longs = F.least(here, there)

        def folded(odd: str, i: Column) -> Column:
            return F.get(odd, i).bitwiseXOR(F.coalesce(F.get(odd, i + longs),
                                                       F.lit(0).cast("bigint")))

        longer = F.aggregate(F.sequence(F.lit(0), longs - 1), F.lit(0), lambda total, i: (
            total + F.bit_count(folded("odd", i).bitwiseXOR(folded("odd2", i)))))
        apart = (F.when((here == ODD) & (there == ODD), apart)
                 .when(F.greatest(here, there) <= 2 * longs, longer).otherwise(0))
    return apart * (100 + percent) <= (F.col("n") + F.col("n2")) * (100 - percent)


_PROFILE = pa.schema([("key", pa.int64()), ("h", pa.int64()), ("n", pa.int64()),
                      ("c", pa.int64()), ("odd", pa.list_(pa.int64())), ("hot", pa.int64()),
                      ("hits", pa.int64())])
_PROFILE_SQL = "key bigint, h bigint, n bigint, c bigint, odd array<bigint>, hot bigint, hits bigint"


class Frequent:
    """Counts shingles and names those that are frequent within a stretch of
    documents."""

    def __init__(self):
        self.held, self.size = [], 0

    def add(self, s: np.ndarray) -> None:
        if len(s):
            self.held.append(s)
            self.size += len(s)

    def full(self) -> bool:
        return self.size >= COUNTED

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.held:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        every = np.sort(np.concatenate(self.held))
        first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        values, counts = every[first], np.diff(np.append(first, len(every)))
        keep = counts >= max(LEAST_HOT, HOT * self.size)
        self.held, self.size = [], 0
        return values[keep], counts[keep]


def _profile(shingle: int):
    """(key, h, text or set): per document its set size, class and odd
    sketch; besides, the frequent shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Frequent()

        def hot() -> pa.RecordBatch:
            values, counts = frequent.take()
            return batch(_PROFILE, *[[None] * len(values)] * 5, signed(values), counts)

        for b in batches:
            sizes, classes, odd = [], [], []
            for s in _sets_in(b, 2, shingle):
                sizes.append(len(s))
                classes.append(set_id(s) if len(s) else None)
                odd.append(wide_sketch(s) if len(s) else None)
                frequent.add(s)
                if frequent.full():
                    yield hot()
            yield batch(_PROFILE, b.column(0), b.column(1), sizes, classes, odd,
                        *[[None] * len(sizes)] * 2)
        yield hot()
    return run


class Ordered:
    """The shared order: by frequency, then by hash."""

    def __init__(self, tokens: np.ndarray, counts: np.ndarray):
        self.tokens, self.counts = tokens, counts

    def frequency(self, s: np.ndarray) -> np.ndarray:
        """0 where it is not known to be large."""
        if not len(self.tokens):
            return np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(self.tokens, s), len(self.tokens) - 1)
        return np.where(self.tokens[at] == s, self.counts[at], 0)

    def prefix(self, s: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
        """The shingles of the longest prefix the class may use, in order,
        and the number of light shingles in the set."""
        frequency = self.frequency(s)
        light = int((frequency < HEAVY).sum())
        least = -(-percent * len(s) // 100)
        longest = len(s) - least + max(1, min(MATCHES[-1], light - (len(s) - least)))
        # Sets come sorted by hash, so a stable sort keeps that among equals.
        return s[np.argsort(frequency, kind="stable")[:longest]], light


_POSTING = pa.schema([("token", pa.int64()), ("c", pa.int64()), ("n", pa.int32()),
                      ("light", pa.int32()), ("place", pa.int32())])
_POSTING_SQL = "token bigint, c bigint, n int, light int, place int"


def _postings(order: Broadcast, shingle: int, percent: int, bitmap: Broadcast | None):
    """Prefix postings of every class; ``place`` counts from 0. With a
    bitmap, only shingles in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ordered = Ordered(*order.value)
        seen: set[int] = set()  # classes this task has sent, bounded
        held, n = [], 0
        for b in batches:
            for s in _sets_in(b, 0, shingle):
                if not len(s):
                    continue
                c = set_id(s)
                if c in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(c)
                tokens, light = ordered.prefix(s, percent)
                place = np.arange(len(tokens), dtype=np.int32)
                if bitmap is not None:
                    keep = in_bitmap(bitmap.value, tokens)
                    tokens, place = tokens[keep], place[keep]
                if not len(tokens):
                    continue
                k = len(tokens)
                held.append((tokens, np.full(k, c), np.full(k, len(s), np.int32),
                             np.full(k, light, np.int32), place))
                n += k
                if n >= 50_000:
                    yield _joined(held)
                    held, n = [], 0
        if held:
            yield _joined(held)
    return run


def _joined(held) -> pa.RecordBatch:
    tokens, *rest = map(np.concatenate, zip(*held))
    return batch(_POSTING, signed(tokens), *rest)


_SETS = pa.schema([("c", pa.int64()), ("shingles", pa.list_(pa.int64()))])


def _sets(wanted: Broadcast, shingle: int):
    """Whole shingle sets of the classes in the bitmap."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in batches:
            cs, sets, size = [], [], 0
            for s in shingle_sets(b.column(0), shingle):
                if not len(s):
                    continue
                c = set_id(s)
                if c in seen or not in_bitmap(wanted.value, np.array([c]).view(np.uint64))[0]:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(c)
                cs.append(c)
                sets.append(signed(s))
                size += len(s)
                if size > 1 << 20:
                    yield batch(_SETS, cs, sets)
                    cs, sets, size = [], [], 0
            if cs:
                yield batch(_SETS, cs, sets)
    return run


def sets_of(classes: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """(c, shingles) for the classes (c), staged."""
    with tidy(texts.sparkSession) as made:
        wanted = staged(classes.distinct(), "jaccard-wanted")
        bitmap = broadcast_bitmap(wanted, F.col("c"))
        sets = staged(texts.mapInArrow(_sets(bitmap, shingle), "c bigint, shingles array<bigint>"),
                      "jaccard-sets")
        return sweep(made, sets.join(wanted, "c", "left_semi").dropDuplicates(["c"]),
                     "jaccard-sets")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are links, by exact intersection.
    Pairs without both sets drop out."""
    both = (pairs.join(sets.select(F.col("c").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("c").alias("b"), F.col("shingles").alias("y")), "b"))
    shared = F.size(F.array_intersect("x", "y"))
    return staged(both.where(shared * (100 + percent) >= (F.size("x") + F.size("y")) * percent)
                  .select("a", "b"), "jaccard-links")


def linked_by(links: DataFrame) -> DataFrame:
    """(node, component) of the links (a, b)."""
    return components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))


def across(postings: DataFrame, linked: DataFrame, percent: int | None = None) -> DataFrame:
    """Postings (token, c, ...) with their component, of the lists that hold
    several. With ``percent``, a hash of the list's members (members) and their
    smallest m (least_m), too, less lists of two whose sizes are too far apart."""
    marked = staged(postings.join(linked.withColumnRenamed("node", "c"), "c", "left")
                    .withColumn("comp", F.coalesce("component", "c")).drop("component"),
                    "jaccard-marked")
    lists = marked.groupBy("token")
    ends = [F.min("comp").alias("a"), F.max("comp").alias("z")]
    if percent is None:
        mixed = lists.agg(*ends).where("a < z").select("token")
    else:
        mixed = (lists.agg(*ends, F.count(F.lit(1)).alias("k"), F.min("m").alias("least_m"),
                           F.min("n").alias("least"), F.max("n").alias("most"),
                           *[F.bit_xor(F.xxhash64("c", F.lit(i))).alias(f"x{i}") for i in (0, 1)])
                 .where("a < z").where((F.col("k") > 2)
                                       | (F.col("least") * 100 >= F.col("most") * percent))
                 .select("token", F.xxhash64("k", "x0", "x1").alias("members"), "least_m"))
    return staged(marked.join(staged(mixed, "jaccard-mixed"), "token"), "jaccard-mixed-postings")


def stars(mixed: DataFrame, turn: int, enough: Column) -> DataFrame:
    """Pairs (a, b): b is the star of lists that a is in, from another
    component. The first star of a list is its most popular class (the
    least changed of a group of copies), later ones change by hash.
    ``enough`` judges the number of lists shared (shared) by a class of n."""
    rank = F.struct("popular", "c") if turn == 0 else F.struct(F.xxhash64("c", F.lit(turn)), "c")
    tops = staged(mixed.groupBy("token").agg(
        F.max(F.struct(rank.alias("rank"), "c", "comp")).alias("star"))
        .select("token", F.col("star.c").alias("b"), F.col("star.comp").alias("b_comp")),
        "jaccard-tops")
    best = Window.partitionBy("c").orderBy(F.desc("shared"), "b")
    found = (mixed.join(tops, "token").where("comp <> b_comp").groupBy("c", "b")
             .agg(F.count(F.lit(1)).alias("shared"), F.max("n").alias("n")).where(enough)
             .withColumn("turn", F.row_number().over(best)).where(f"turn <= {STARS}"))
    return found.select(F.col("c").alias("a"), "b")


def _least(n: str, percent: int) -> Column:
    """Shingles that a set of n shares with any partner."""
    return F.ceil(F.col(n) * percent / 100)


def _least_larger(n: str, percent: int) -> Column:
    """Shingles that a set of n shares with any partner of n or more."""
    return F.ceil(F.col(n) * (2 * percent) / (100 + percent))


def _chosen(postings: DataFrame, percent: int) -> DataFrame:
    """The postings (token, c, n, light, place, m, popular) of each class's
    own prefix: the m that costs least to merge and verify. A prefix is as
    long as the document allows, so it fits in a row."""
    by_class = postings.groupBy("c").agg(
        F.first("n").alias("n"), F.first("light").alias("light"),
        F.collect_list(F.struct("k", "token", "place")).alias("prefix"))
    shortest = F.col("n") - _least("n", percent)
    options = []
    for m in MATCHES:
        kept = F.filter("prefix", lambda p, m=m: p["place"] < shortest + m)
        merged = F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, p: acc + p["k"] - 1)
        cost = merged + VERIFY_COST * merged / m
        if m > 1:  # within the light part
            cost = F.when(shortest + m <= F.col("light"), cost)
        options.append(F.struct(F.coalesce(cost, F.lit(float("inf"))).alias("cost"),
                                F.lit(m).alias("m"), kept.alias("kept")))
    popular = F.aggregate("prefix", F.lit(0).cast("bigint"), lambda acc, p: acc + p["k"])
    best = by_class.select("c", "n", "light", (popular / F.col("n")).alias("popular"),
                           F.array_min(F.array(*options)).alias("best"))
    return best.select("c", "n", "light", "popular", F.col("best.m").alias("m"),
                       F.explode("best.kept").alias("p")) \
        .select("p.token", "c", "n", "light", "p.place", "m", "popular")


def odd_sketches(profile: DataFrame) -> DataFrame:
    """(c, odd) of the classes of a profile."""
    return profile.where("c is not null").groupBy("c").agg(F.first("odd").alias("odd"))


def bundles(mixed: DataFrame, percent: int) -> DataFrame:
    """Postings of lists with the same members as one row: members, rare
    (whether light), c, n, light, m, comp, the number of those that the smaller
    set of a pair may use (usable), their first and last place. Two classes
    share all postings of a bundle or none, so no common shingle is lost.
    Classes with fewer postings left than a partner has to share drop out."""
    short = F.col("n") - _least_larger("n", percent) + F.col("m")
    bundled = (mixed.repartition("c").withColumn("rare", F.col("place") < F.col("light"))
               .groupBy("c", "members", "rare").agg(
                   *[F.first(x).alias(x) for x in ("n", "light", "m", "comp", "least_m")],
                   F.count(F.lit(1)).alias("k"), F.count_if(F.col("place") < short).alias("usable"),
                   F.min("place").alias("first"), F.max("place").alias("last")))
    return (bundled.withColumn("left", F.sum("k").over(Window.partitionBy("c")))
            .where("left >= m or least_m < m").drop("k", "left", "least_m"))


def _candidates(bundled: DataFrame, percent: int) -> DataFrame:
    """(a, b): all pairs of classes from different components whose prefixes
    and odd sketches (odd) allow a link."""
    large = bundled.select(*[F.col(x).alias(f"{x}2") for x in bundled.columns if x != "usable"])
    small = bundled.where("usable > 0")

    def enough(overlap: Column) -> Column:
        return overlap * (100 + percent) >= (F.col("n") + F.col("n2")) * percent

    meet = ((F.col("members") == F.col("members2")) & (F.col("comp") != F.col("comp2"))
            & ((F.col("n") < F.col("n2")) | ((F.col("n") == F.col("n2")) & (F.col("c") < F.col("c2"))))
            & (F.col("n") * 100 >= F.col("n2") * percent)
            # Enough left on both sides of the shared shingles.
            & enough(F.least("last", "last2")
                     + F.least(F.col("n") - F.col("first"), F.col("n2") - F.col("first2")))
            & may_link(percent, wide=True))
    short = F.col("n") - _least_larger("n", percent) + F.col("m")
    light = (small.where("rare").join(large.where("rare2"), meet)
             .groupBy("c", "c2").agg(F.sum("usable").alias("shared"),
                                     *[F.first(x).alias(x) for x in
                                       ("n", "n2", "m", "m2", "light", "light2")])
             .where(F.col("shared") >= F.least("m", "m2"))
             # Whatever else they share lies behind one of the prefixes.
             .where(enough(F.col("shared") + F.greatest(
                 F.col("n") - F.least(short, F.col("light")),
                 F.col("n2") - F.least(F.col("n2") - _least("n2", percent) + F.col("m2"),
                                       F.col("light2"))))))
    heavy = (small.where("not rare").join(
        large.where("not rare2"),
        meet & enough(F.least(F.col("n") - F.col("light"), F.col("n2") - F.col("light2"))))
        .select("c", "c2").distinct())
    return (light.select("c", "c2").unionByName(heavy).distinct()
            .select(F.col("c").alias("a"), F.col("c2").alias("b")))


def heavy_shingles(profile: DataFrame) -> Broadcast:
    """(sorted shingles, counts) of a staged profile; at most 1 / HOT."""
    total = profile.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = (profile.where("hot is not null").groupBy("hot").agg(F.sum("hits").alias("hits"))
           .where(F.col("hits") >= max(LEAST_HOT, HOT * total)).toArrow())
    tokens = hot.column("hot").to_numpy().view(np.uint64)
    by_token = np.argsort(tokens)
    return profile.sparkSession.sparkContext.broadcast(
        (tokens[by_token], hot.column("hits").to_numpy()[by_token]))


def profile_of(rows: DataFrame, shingle: int) -> DataFrame:
    """Profile of rows (key, h, text or set), staged."""
    return staged(rows.mapInArrow(_profile(shingle), _PROFILE_SQL), "jaccard-profile")


def _shared(source: DataFrame, order: Broadcast, shingle: int, percent: int) -> DataFrame:
    """Postings (token, c, n, light, place, k) of the shingles that stand in
    the prefixes of two classes at least; k counts their postings."""
    met = (source.mapInArrow(_postings(order, shingle, percent, None), _POSTING_SQL)
           .groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1"))
    bitmap = broadcast_bitmap(met, F.col("token"))
    postings = staged(source.mapInArrow(_postings(order, shingle, percent, bitmap), _POSTING_SQL),
                      "jaccard-postings")
    # A window, so that postings are dealt by token once.
    every = Window.partitionBy("token")
    lists = postings.withColumns({"a": F.min("c").over(every), "z": F.max("c").over(every),
                                  "k": F.count(F.lit(1)).over(every)}).where("a < z")
    return staged(lists.groupBy("token", "c", "n", "light", "place").agg(F.max("k").alias("k")),
                  "jaccard-postings")


def links_among(source: DataFrame, profile: DataFrame, percent: int, shingle: int,
                sets: DataFrame | None = None, linked: DataFrame | None = None,
                rounds: int = ROUNDS) -> DataFrame:
    """Links (a, b) of classes that together with ``linked`` (node,
    component) connect every pair of similar sets. ``source`` has one column,
    texts or sets; given whole ``sets`` (c, shingles) serve to verify."""
    order = heavy_shingles(profile)
    with tidy(source.sparkSession) as made:
        postings = sweep(made, _chosen(_shared(source, order, shingle, percent), percent),
                         "jaccard-postings")

    # Step 1: stars. Their sets are fetched once: the classes that share
    # much with a star of the first turn.
    links = postings.select(F.col("c").alias("a"), F.col("c").alias("b")).where(F.lit(False))
    nothing = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    linked = nothing if linked is None else linked
    known = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
    of_stars = sets
    for turn in range(rounds):
        with tidy(source.sparkSession) as made:
            found = sweep(made, stars(across(postings, linked), turn,
                                      F.col("shared") * 100 >= F.col("n") * STAR_PERCENT),
                          "jaccard-stars")
        if of_stars is None:
            of_stars = sets_of(found.select(F.explode(F.array("a", "b")).alias("c")), source,
                               shingle)
        new = verified(found, of_stars, percent)
        if new.isEmpty():
            break
        links = links.unionByName(new)
        linked = linked_by(known.unionByName(links))

    # Step 2: every pair left.
    with tidy(source.sparkSession) as made:
        left = sweep(made, bundles(across(postings, linked, percent), percent)
                     .join(odd_sketches(profile), "c"), "jaccard-left")
        pairs = sweep(made, _candidates(left, percent), "jaccard-pairs")
    rest = sets if sets is not None else sets_of(
        pairs.select(F.explode(F.array("a", "b")).alias("c")), source, shingle)
    return links.unionByName(verified(pairs, rest, percent))


def grouped(every: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From documents (key, h, n, c) and links of classes: (c, class, group),
    class being the smallest key of equal sets, and (group, component, k, h):
    the smallest key of a group, and the first of its documents by key and
    text hash, null keys last."""
    final = linked_by(links)
    first = F.min(F.struct(F.coalesce("key", F.lit(LAST)).alias("k"), "h")).alias("first")
    classes = staged(every.where("n > 0").groupBy("c").agg(F.min("key").alias("key"), first),
                     "jaccard-classes")
    classes = staged(classes.join(final.withColumnRenamed("node", "c"), "c", "left").select(
        "c", "key", "first", F.coalesce("component", "c").alias("group")), "jaccard-classes")
    groups = staged(classes.groupBy("group").agg(F.min("key").alias("component"),
                                                 F.min("first").alias("first"))
                    .select("group", "component", "first.k", "first.h"), "jaccard-groups")
    return classes.select("c", F.col("key").alias("class"), "group"), groups


def keyed_texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    body = F.col(text).cast("string")
    return docs.select(F.col(key).cast("bigint").alias("key"), F.xxhash64(body).alias("h"),
                       body.alias("text"))


def named(every: DataFrame, classes: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per document: key, n, class, component."""
    of_class = classes.join(groups, "group").select("c", "class", "component")
    return (every.where("n > 0").join(of_class, "c").select("key", "n", "class", "component")
            .unionByName(every.where("n = 0").select(
                "key", "n", F.lit(None).cast("bigint").alias("class"),
                F.col("key").alias("component"))))


def _groups(docs: DataFrame, percent: int, shingle: int, key: str, text: str
            ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: key, h (text hash), n, c), (classes: c, class, group) and
    (groups: group, component, k, h)."""
    rows = keyed_texts(docs, key, text)
    profile = profile_of(rows, shingle)
    every = profile.where("n is not null").select("key", "h", "n", "c")
    links = links_among(rows.select("text"), profile, percent, shingle)
    return (every, *grouped(every, links))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                       key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n (set size), class (the smallest key with
    an equal set), component (the smallest key that links reach, itself
    included).

    Texts are lower-cased in A-Z. Null or blank texts have an empty set, no
    class and no links. A null key never names a component that has another
    key; rows that repeat a key stand for texts of their own. Other columns
    are not read; no rows give no rows.
    """
    with tidy(docs.sparkSession) as made:
        return sweep(made, named(*_groups(docs, percent, shingle, key, text)), "jaccard-components")


def keep_first_of_each(docs: DataFrame, groups: DataFrame, key: str, text: str) -> DataFrame:
    """The rows of ``docs`` that are the first of their group (k, h), and
    those without words."""
    body = F.col(text).cast("string")
    has_words = F.coalesce(body.rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    marked = docs.withColumns({
        "__k": F.coalesce(F.col(key).cast("bigint"), F.lit(LAST)), "__h": F.xxhash64(body)})
    stays = groups.select(F.col("k").alias("__k"), F.col("h").alias("__h"))
    kept = (marked.where(has_words).join(stays, ["__k", "__h"], "left_semi")
            .dropDuplicates(["__k", "__h"]).select(*docs.columns))
    return kept.unionByName(docs.where(~has_words))


def one_of_each(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE,
                key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` less near duplicates, all columns kept: of each
    component the document with the smallest key stays (null keys last,
    equal keys by text hash, equal rows one). Texts without words have no
    duplicates and stay."""
    with tidy(docs.sparkSession) as made:
        _, _, groups = _groups(docs, percent, shingle, key, text)
        groups = sweep(made, groups, "jaccard-groups")
    return keep_first_of_each(docs, groups, key, text)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_components(documents(spark, sf_dir))
    return out.select(F.col("key").alias("doc_id"), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"), F.col("class").alias("class_id"))


def components_sql(shingle: int, percent: int) -> str:
    """CTEs of DuckDB SQL (to follow WITH RECURSIVE): ``named`` (doc_id,
    n_shingles, component_id, class_id) of ``documents``, ids taken as unique."""
    return rf"""
words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[]
    WHEN len(w) < {shingle} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, (len(w) - {shingle - 2})::BIGINT),
         lambda i: array_to_string(list_slice(w, i, i + {shingle - 1}), ' '))) END AS s
  FROM words),
classes AS (SELECT min(doc_id) AS c, len(s) AS n, list_sort(s) AS s FROM sets GROUP BY ALL),
member AS (SELECT doc_id, c FROM sets JOIN classes ON list_sort(sets.s) = classes.s WHERE n > 0),
tokens AS (SELECT c, n, unnest(s) AS token FROM classes),
links AS (
  SELECT a.c AS u, b.c AS v FROM tokens a JOIN tokens b ON a.token = b.token AND a.c < b.c
  GROUP BY a.c, b.c, a.n, b.n
  HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
both_ways AS (SELECT u, v FROM links UNION ALL SELECT v, u FROM links),
reach(u, v) AS (
  SELECT c, c FROM classes WHERE n > 0
  UNION SELECT r.u, b.v FROM reach r JOIN both_ways b ON r.v = b.u),
least AS (SELECT u, min(v) AS component FROM reach GROUP BY u),
named AS (
  SELECT s.doc_id, len(s)::BIGINT AS n_shingles, coalesce(component, s.doc_id) AS component_id,
         m.c AS class_id
  FROM sets s LEFT JOIN member m ON m.doc_id = s.doc_id LEFT JOIN least ON least.u = m.c)"""


OP5_SQL = f"""WITH RECURSIVE {components_sql(SHINGLE, PERCENT)}
SELECT doc_id, n_shingles, component_id, class_id FROM named"""
