"""Substring dedup and Jaccard join against brute force."""

import collections
import hashlib
import pathlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import jaccard, minhash, substring
from ledgerlake.llm.common import shingle_sets, text_words, word_hashes
from ledgerlake.llm.components import components
from ledgerlake.session import checkpoint_root

LAST = 1 << 62


def rows_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def brute_cut(rows, length):
    first = {}
    for d, t in rows:
        w = text_words(t)
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, LAST), LAST if d is None else d)
    out = []
    for d, t in rows:
        w, gone = text_words(t), set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < (LAST if d is None else d):
                gone.update(range(i, i + length))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone).decode()
        out.append((d, len(w), len(gone), kept))
    return out


@pytest.mark.parametrize("length", [50, 7, 3])
def test_substring_equals_brute_force(docs, length):
    got = [tuple(r) for r in substring.remove_repeats(docs, length).collect()]
    want = brute_cut(rows_of(docs), length)
    order = lambda rows: sorted(rows, key=repr)
    assert order(got) == order(want)
    assert sum(r[2] for r in want) > 0


def test_substring_keeps_columns_and_untouched_texts(docs):
    out = substring.without_repeats(docs)
    assert out.schema == docs.schema
    want = {}
    for (d, t), (_, _, n, kept) in zip(rows_of(docs), brute_cut(rows_of(docs), 50)):
        want.setdefault(d, []).append(t if n == 0 else kept)
    got = {}
    for d, t in rows_of(out):
        got.setdefault(d, []).append(t)
    assert {d: sorted(map(repr, v)) for d, v in got.items()} == {
        d: sorted(map(repr, v)) for d, v in want.items()}


def test_runs_of_a_long_text_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    words = rng.integers(0, 1 << 63, 600_000).astype(np.uint64)
    bounds = np.array([0, len(words)])
    substring.runs_of(words[:200], np.array([0, 200]), 50)
    substring.Ranges(words, substring.BASES[0]), substring.Ranges(words, substring.BASES[1])
    tracemalloc.start()
    whole = substring.runs_of(words, bounds, 50)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 * len(words)  # the windows alone were 304 bytes a word
    monkeypatch.setattr(substring, "BLOCK", 1000)
    for a, b in zip(whole, substring.runs_of(words, bounds, 50)):
        assert (a == b).all()


def test_a_common_passage_is_looked_up_once():
    rnd = random.Random(3)
    passage = " ".join(str(rnd.random()) for _ in range(300))
    texts = [(k, 0, f"{k} {passage}") for k in range(500)]
    b = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*texts)], names=["k", "row", "text"])
    got = pa.Table.from_batches(substring._seen(50, None)(iter([b]))).to_pylist()
    assert 5 < len(got) < 500 + 300
    assert sum((r["a"], r["b"]) == (0, 499) for r in got) > 5


def test_substring_empty_table(none):
    assert substring.remove_repeats(none).collect() == []
    assert substring.without_repeats(none).collect() == []


def sets_of(rows, k=5):
    out = []
    for _, t in rows:
        w = [x.lower() for x in text_words(t)]
        out.append(frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))) if w
                   else frozenset())
    return out


def brute_components(rows, k=5, percent=75):
    sets = sets_of(rows, k)
    label = list(range(len(rows)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(
                    sets[i] | sets[j]):
                label[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), LAST), d)
    return [(d, len(s), least.get(find(i)), find(i)) for i, ((d, _), s)
            in enumerate(zip(rows, sets))]


def test_jaccard_equals_brute_force(docs):
    rows = rows_of(docs)
    got = sorted(((r.key, r.n, r.component) for r in
                  jaccard.jaccard_components(docs).collect()), key=repr)
    assert got == sorted((x[:3] for x in brute_components(rows)), key=repr)
    assert len({c for _, _, c in got}) < len(got) - 14  # the near copies are one


def overlapping_cuts(n=700, seed=3):
    """Texts cut from a few passages with up to 40 % extra words, so that
    many pairs lie around the threshold."""
    rnd = random.Random(seed)
    bases = [[f"b{b}w{i}" for i in range(120)] for b in range(6)]
    rows = []
    for i in range(n):
        base = rnd.choice(bases)
        size = rnd.randint(60, 120)
        at = rnd.randint(0, 120 - size)
        extra = [f"x{rnd.randrange(40)}" for _ in range(int(size * rnd.random() * 0.4))]
        cut = base[at:at + size]
        place = rnd.randint(0, len(cut))
        rows.append((i, " ".join(cut[:place] + extra + cut[place:])))
    return rows


@pytest.mark.parametrize("heavy", [3, 32])
def test_jaccard_of_overlapping_cuts(spark, monkeypatch, heavy):
    monkeypatch.setattr(jaccard, "HEAVY", heavy)
    rows = overlapping_cuts()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = sorted((r.key, r.n, r.component) for r in jaccard.jaccard_components(df).collect())
    assert got == sorted(x[:3] for x in brute_components(rows))
    assert 20 < len({c for _, _, c in got}) < 690


def test_jaccard_join_drops_what_it_has_read(spark, monkeypatch):
    """When pairs are verified, of the staged postings and sets only those
    still needed are left."""
    root, verified, left = pathlib.Path(checkpoint_root(spark), "ledgerlake"), jaccard.verified, []
    before = set(root.glob("jaccard-*"))

    def counted(*args):
        new = set(root.glob("jaccard-*")) - before
        left.append(collections.Counter(p.name.rsplit("-", 1)[0] for p in new))
        return verified(*args)

    monkeypatch.setattr(jaccard, "verified", counted)
    df = spark.createDataFrame(overlapping_cuts(200), "doc_id bigint, text string").repartition(4)
    jaccard.jaccard_components(df).collect()
    assert [x["jaccard-postings"] for x in left] == [1, 1]
    assert [x["jaccard-sets"] for x in left] == [1, 2]
    assert not any(x[f"jaccard-{y}"] for x in left for y in ("marked", "mixed", "mixed-postings",
                                                             "tops", "lists", "wanted", "left"))


@pytest.mark.parametrize("listed", [3, 32])
def test_near_duplicates_equal_brute_force(spark, docs, monkeypatch, listed):
    # with few listed classes the larger buckets are joined exactly
    monkeypatch.setattr(minhash, "LISTED", listed)
    cuts = overlapping_cuts(500, seed=4)
    df = docs.select("doc_id", "text").unionByName(
        spark.createDataFrame([(1000 + i, t) for i, t in cuts], "doc_id bigint, text string"))
    rows = rows_of(df)
    out = minhash.near_duplicates(df).collect()
    got = sorted(((r.key, r.n, r.component) for r in out), key=repr)
    assert got == sorted((x[:3] for x in brute_components(rows, 4, 80)), key=repr)
    assert all(r.kept == (r.key == r.component) for r in out)
    groups = {g: c for _, n, c, g in brute_components(rows, 4, 80) if n}
    kept = minhash.without_near_duplicates(df)
    assert sorted((d for d, t in rows_of(kept) if text_words(t)), key=repr) == sorted(
        groups.values(), key=repr)


def test_sketches_are_full_and_agree_by_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    sets = [pool[:1], pool[:2], pool[:400], pool[100:500], pool[400:], pool[:400][::-1]]
    sketch = minhash.sketches(sets, 150)
    assert not (sketch == minhash._EMPTY).any()
    # each alone gives the same
    for s, row in zip(sets, sketch):
        assert (minhash.sketches([s], 150)[0] == row).all()
    assert (sketch[2] == sketch[5]).all() and not (sketch[2] == sketch[4]).any()
    # similarity 300 / 500: five standard deviations of 150 coordinates
    assert abs((sketch[2] == sketch[3]).mean() - 0.6) < 0.2
    wide = minhash.sketches([pool[:400], pool[100:500]], 4000)
    assert abs((wide[0] == wide[1]).mean() - 0.6) < 0.04
    keys = minhash.band_keys(sketch, 30, 5)
    assert (keys[2] == keys[5]).all() and len(set(keys[2].tolist())) == 30


def test_odd_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, 60).astype(np.uint64)
        a, b = pool[rng.random(60) < 0.8], pool[rng.random(60) < 0.8]
        apart = sum(int(x ^ y).bit_count() for x, y in zip(
            jaccard.odd_sketch(a).view(np.uint64), jaccard.odd_sketch(b).view(np.uint64)))
        assert apart <= len(set(a.tolist()) ^ set(b.tolist()))


def test_sketches_of_large_sets_tell_them_apart(spark):
    rnd = np.random.default_rng(8)
    one = rnd.integers(0, 1 << 63, 4500).astype(np.uint64)
    other = rnd.integers(0, 1 << 63, 4500).astype(np.uint64)
    # Half of the shingles in common, six in seven, and one sketch twice as long.
    pairs = [(one, np.concatenate([one[:2250], other[:2250]]), False),
             (one, np.concatenate([one[:4000], other[:500]]), True),
             (one[:4000], one, True), (one[:4000], other, False), (one[:900], one[:1100], True)]
    assert {len(jaccard.wide_sketch(x)) for a, b, _ in pairs for x in (a, b)} == {16, 32, 64, 128}
    rows = [(i, len(a), jaccard.wide_sketch(a).tolist(), len(b), jaccard.wide_sketch(b).tolist())
            for i, (a, b, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, n int, odd array<bigint>, n2 int, odd2 array<bigint>")
    got = df.select("i", jaccard.may_link(75, wide=True).alias("may")).orderBy("i").collect()
    assert [r.may for r in got] == [may for *_, may in pairs]


def test_posting_lists_of_the_same_members_are_merged(spark):
    # Classes 1 and 2 share tokens 1 to 9; 3 shares token 9 with both, and
    # token 20 with 4; 5 and 6 share one token, but differ too much in size.
    rows = [(t, c, c) for t in range(1, 10) for c in (1, 2)] + [(9, 3, 3), (20, 3, 3), (20, 4, 4)]
    rows = [(t, c, 40, 30, t - 1, 1, 1.0) for t, c, _ in rows]
    rows += [(21, 5, 40, 30, 0, 1, 1.0), (21, 6, 90, 80, 0, 1, 1.0)]
    postings = spark.createDataFrame(rows, "token bigint, c bigint, n int, light int, place int, "
                                           "m int, popular double")
    linked = spark.createDataFrame([], "node bigint, component bigint")
    got = jaccard.bundles(jaccard.across(postings, linked, 75), 75).collect()
    # b = ceil(150 * 40 / 175) = 35: the smaller set may use places 0 to 5.
    assert sorted((r.c, r["first"], r["last"], r.usable) for r in got) == [
        (1, 0, 7, 6), (1, 8, 8, 0), (2, 0, 7, 6), (2, 8, 8, 0), (3, 8, 8, 0), (3, 19, 19, 0),
        (4, 19, 19, 0)]


def test_near_duplicates_of_nothing(none):
    assert minhash.near_duplicates(none).collect() == []
    assert minhash.without_near_duplicates(none).collect() == []


def test_one_of_each_keeps_one(docs):
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    kept = rows_of(out)
    groups = {group: c for _, n, c, group in brute_components(rows_of(docs)) if n}
    assert sorted((d for d, t in kept if text_words(t)), key=repr) == sorted(
        groups.values(), key=repr)
    assert sorted(repr(t) for d, t in kept if not text_words(t)) == sorted(
        repr(t) for d, t in rows_of(docs) if not text_words(t))


def test_jaccard_empty_table(none):
    assert jaccard.jaccard_components(none).collect() == []
    assert jaccard.one_of_each(none).collect() == []


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, x) for x in range(101, 140)] + [(7, 7)]
    out = components(spark.createDataFrame(links, "u long, v long")
                     .unionByName(spark.createDataFrame([(139, 200), (200, 300)], "u long, v long")))
    got = {r.node: r.component for r in out.collect()}
    assert got == {**{i: 0 for i in range(61)},
                   **{i: 100 for i in [*range(100, 140), 200, 300]}}


def test_hashes_follow_the_words():
    text = "Ab  cd\tAb\x0bé x y " + "w" * 300_000 + " tail " * 60_000
    hashes = word_hashes(text)
    words = text_words(text)
    assert len(hashes) == len(words)
    assert len(set(hashes.tolist())) == len(set(words))
    assert hashlib.md5(word_hashes("ab " + text).tobytes()[8:]).digest() == hashlib.md5(
        hashes.tobytes()).digest()
    assert [len(s) for s in shingle_sets([None, "", "a b", "A B", "a b c d e f"])] == [0, 0, 1, 1, 2]


def test_op5_digest(spark, docs):
    out = jaccard.jaccard_components(docs).agg(F.sum("n")).first()[0]
    assert out == sum(len(s) for s in sets_of(rows_of(docs)))
