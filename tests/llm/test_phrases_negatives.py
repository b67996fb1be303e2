"""Phrase mining and hard negatives against brute force."""

import collections
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import bitmaps, negatives, phrases


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute_phrases(rows, least, longest, top):
    counts, totals = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            totals[lang] += len(w)
            for k in range(1, longest + 1):
                counts.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    frequent = {g: n for g, n in counts.items() if n >= least and len(g[1]) > 1}

    def inside(p, g):
        return len(p) < len(g) and any(g[i:i + len(p)] == p for i in range(len(g) - len(p) + 1))
    out = collections.defaultdict(list)
    for (lang, p), a in frequent.items():
        if any(x == lang and n >= a and inside(p, g) for (x, g), n in frequent.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k,
                 counts[lang, p[:k]], counts[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, totals[lang], -score)
                  for lang, found in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top]))


def text_rows():
    rnd = random.Random(12)
    words = ["Ab", "ab", "cd", "é", "of", "the", "x1", "zz", "q"]
    rows = [(rnd.choice(["en", "de", None, "und"]), " ".join(
        rnd.choice(words) + rnd.choice(["", "", "", ".", ",", "\n", "\t", "  ", "\x0b"])
        for _ in range(rnd.randint(0, 60)))) for _ in range(300)]
    rows += [("en", "one rare phrase of five words here")] * 9
    rows += [("de", None), ("de", ""), ("en", " \t "), ("en", ".,;:!?"), ("fr", "a b")]
    rows += [("en", "ab cd " * 40_000), ("de", "w" * 300_000 + " ab cd. " + "the of " * 50_000)]
    return rows


@pytest.mark.parametrize("least, sample", [(8, 0.3), (30, 1 / 16), (8, 1.0)])
def test_collocations_equal_brute_force(spark, monkeypatch, least, sample):
    monkeypatch.setattr(phrases, "BLOCK", 1000)
    rows = text_rows()
    df = spark.createDataFrame([(t, x, 1, 2, "y") for x, t in rows],
                               "text string, lang string, n int, k int, gram string").repartition(3)
    got = phrases.collocations(df, least=least, top=25, sample=sample).collect()
    want = brute_phrases(rows, least, 5, 25)
    assert sorted(tuple(r) for r in got) == want
    assert {"en", "de", "und"} <= {r[0] for r in want}


def test_collocations_with_crowded_bitmaps(spark, monkeypatch):
    """Phrases that lie in a bitmap by chance are not taken for counted."""
    monkeypatch.setattr(bitmaps, "BITS", 15)
    rnd = random.Random(3)
    lines = [" ".join(f"w{rnd.randrange(400)}" for _ in range(5)) for _ in range(1200)]
    rows = [("en", "\n".join(rnd.sample(lines, 8))) for _ in range(900)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    got = phrases.collocations(df, least=4, sample=0.1).collect()
    assert sorted(tuple(r) for r in got) == brute_phrases(rows, 4, 5, 2000)


@pytest.mark.parametrize("most", [1 << 19, 20])
def test_a_task_adds_up_the_counts_of_its_stretches(monkeypatch, most):
    monkeypatch.setattr(phrases, "STRETCH", 200)
    monkeypatch.setattr(phrases, "COUNTED", 100)
    monkeypatch.setattr(phrases, "KEPT", most)
    texts = [" ".join(f"w{(i + j) % 30}" for j in range(40)) for i in range(50)]
    b = pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(texts)], names=["lang", "text"])
    rows = pa.Table.from_batches(phrases._counted((1,), None, [])(iter([b]))).to_pylist()
    hits = collections.Counter()
    for r in rows:
        hits[r["gram"]] += r["hits"]
    want = collections.Counter(w for t in texts for w in t.split())
    assert sorted(hits.values()) == sorted(want.values())
    assert len(rows) == 30 if most > 30 else len(rows) > 30


def test_collocations_of_nothing(spark, none):
    assert phrases.collocations(none).collect() == []
    few = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    assert phrases.collocations(few).collect() == []


def test_scores_beyond_64_bits(spark):
    a = n = 10 ** 12
    row = spark.range(1).selectExpr(
        f"1000BD * cast({a} as decimal(15, 0)) * cast({n} as decimal(15, 0)) "
        f"div (cast({a} as decimal(15, 0)) * cast({a} as decimal(15, 0))) AS s").first()
    assert row.s == 1000


def brute_negatives(rows, positives=5, many=10):
    best = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(
                v is None or not np.isfinite(v) for v in vec):
            continue
        x = [int(np.floor(256 * float(np.float32(v)))) for v in vec]
        label = (label + 1) % 10 if i % 7 == 0 else label
        best[i] = min(best.get(i, (label, x)), (label, x))

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))
    out = []
    for i, (label, x) in best.items():
        if i % 100:
            continue
        scored = sorted((-score(x, y), j, other) for j, (other, y) in best.items() if j != i)
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            s = -s
            hard = [(j, -t) for t, j, other in scored
                    if other != label and 30 * s <= -100 * t <= 90 * s][:many]
            out += [(i, p, k + 1, j, s, t) for k, (j, t) in enumerate(hard)]
    return sorted(out)


def vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12))
    rows = []
    for i in range(1200):
        v = centres[i % 4] + rng.normal(size=12) * 0.7
        rows.append((i, i % 4 if i % 5 else (i + 1) % 4, [float(np.float32(a)) for a in v]))
    rows += [(2000 + 100 * k, 3, [0.5] * 12) for k in range(3)]     # equal anchors
    rows += [(2400 + k, k % 2, [0.25] * 12) for k in range(150)]    # many equal rows
    rows += [(3000, 1, [0.0] * 12), (3100, 1, []), (3200, 1, [1.0, -2.0]), (3300, 77, [1.0] * 12),
             (100, 0, [0.1] * 12), (100, 0, [0.1] * 12), (None, 1, [1.0] * 12),
             (3400, None, [1.0] * 12), (3500, 1, None), (3600, 1, [None] + [1.0] * 11),
             (3700, 1, [float("nan")] * 12), (3800, 1, [float("inf")] * 12),
             (3900, 2, [-3.0] * 12), (-100, 2, [2.0] * 12)]
    return rows


@pytest.mark.parametrize("block, anchors", [(4096, 256), (64, 5)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(negatives, "ROWS_A_BLOCK", block)
    monkeypatch.setattr(negatives, "ANCHORS_A_BLOCK", anchors)
    monkeypatch.setattr(negatives, "ROWS_A_STRETCH", 8)
    rows = vectors()
    df = spark.createDataFrame([(v, i, label, "b", 1) for i, label, v in rows],
                               "embedding array<float>, vec_id long, label int, block string, n int")
    got = sorted(tuple(r) for r in negatives.hard_negatives(df).collect())
    want = brute_negatives(rows)
    assert got == want and len(want) > 300


def test_hard_negatives_of_nothing(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert negatives.hard_negatives(spark.createDataFrame([], schema)).collect() == []
    lone = spark.createDataFrame([(100, [1.0, 2.0], 1), (101, [1.0, 2.0], 2)], schema)
    assert negatives.hard_negatives(lone).collect() == []


def test_bounds_hold_for_extreme_vectors():
    rng = np.random.default_rng(8)
    refs = rng.normal(size=(8, 16))
    refs /= np.linalg.norm(refs, axis=1)[:, None]
    x = (rng.normal(size=(300, 16)) * 10.0 ** rng.integers(0, 8, (300, 1))).astype(np.int64)
    x[::7] = x[1]        # equal rows
    x[5::11] = -x[2]     # opposite rows
    x[9] = 0
    norms = np.linalg.norm(x.astype(float), axis=1)
    angles = np.arccos(np.clip(x.astype(float) @ refs.T / np.maximum(norms, 1e-300)[:, None], -1, 1))
    side = negatives.Side(np.arange(300), np.zeros(300, int), x, norms, angles)
    side.stretches()
    every = np.arange(300)
    for i in range(300):
        exact = np.array([int(sum(int(a) * int(b) for a, b in zip(x[i], y))) for y in x], object)
        low, high = negatives._row_bounds(side, i, side, every)
        assert all(a <= e <= b for a, e, b in zip(low, exact, high))
        low, high = negatives._stretch_bounds(side, i, side)
        assert all(low[s] <= e <= high[s] for s, e in zip(side.stretch, exact))
