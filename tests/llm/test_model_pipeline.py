"""Quality classifier, decontamination and the pipeline's stages."""

import random

import numpy as np
import pytest

import corpus_pipeline
from ledgerlake.llm import decontaminate, quality_model
from ledgerlake.llm.common import text_words

SMALL = "/root/testdata/sf0.01"


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    w = {"encode": rng.normal(size=(5, 4)), "encode0": rng.normal(size=4),
         "tanh": rng.normal(size=(4, 3)), "gate": rng.normal(size=(4, 3)),
         "attend": rng.normal(size=3), "out": rng.normal(size=4), "out0": rng.normal(size=1)}
    x, first = rng.normal(size=(9, 5)), np.array([0, 4, 5])
    y, cost = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = quality_model._forward(w, x, first)[-1]
        return -(cost * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / cost.sum()
    grads = quality_model._gradients(w, x, first, y, cost)
    for k, g in grads.items():
        it = np.ndindex(w[k].shape)
        for i in list(it)[:6]:
            keep = w[k][i]
            w[k][i] = keep + 1e-6
            up = loss()
            w[k][i] = keep - 1e-6
            down = loss()
            w[k][i] = keep
            assert abs((up - down) / 2e-6 - g[i]) < 1e-5


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rows = quality_model.op1_quality_scores(spark, SMALL).collect()
    assert len(rows) == docs.count()
    label = {r.doc_id: r.quality for r in labels.collect()}
    held = [(label[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in label]
    assert sum(a == b for a, b in held) / len(held) > 0.95


def test_scores_of_odd_texts(docs):
    model = quality_model.train([np.ones((2, quality_model.FEATURES), np.float32)] * 4,
                                np.array([0.0, 1, 0, 1]), np.ones(4))
    rows = quality_model.scores(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.score == 0 for r in rows if r.key in (90, 91, 92))
    assert quality_model.accepted(docs, model, 0.0).schema == docs.schema
    assert quality_model.scores(docs.where("doc_id = -1"), model).collect() == []


def test_passages_cover_the_whole_text():
    text = " ".join(f"w{i}" for i in range(64 * 5 + 3))
    rows = quality_model.passages(text)
    assert len(rows) == 5 and len(quality_model.passages(text + " x" * 40)) == 6
    assert len(quality_model.passages(None)) == 0


def brute_contamination(docs, items):
    """Weighted shingle Jaccard of every item-sized window."""
    def bag(words):
        n = min(5, len(words))
        return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)}

    def weight(shingles):
        return sum(len(w) for s in shingles for w in s)
    found = set()
    for d, t in docs:
        w = [x.lower() for x in text_words(t)]
        for item, text in items:
            v = [x.lower() for x in text_words(text)]
            b = bag(v) if v else set()
            # a shorter text is one window
            for i in range(max(1, len(w) - len(v) + 1)) if v and w else ():
                a = bag(w[i:i + len(v)])
                if 100 * weight(a & b) >= 75 * weight(a | b):
                    found.add((d, item))
                    break
    return found


def test_decontamination_equals_brute_force(spark, docs):
    rnd = random.Random(3)
    items = [(k, " ".join("".join(rnd.choice("abcdefgh") for _ in range(5))
                          for _ in range(n))) for k, n in enumerate((3, 9, 15, 30, 45))]
    items += [(10, None), (11, ""), (12, "two words")]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for k, (item, text) in enumerate(items[:5]):
        rows.append((1000 + k, f"before it {text.upper()} and after"))
        edited = text.split()
        edited[len(edited) // 2] = "zzz"
        rows.append((1100 + k, f"some {' '.join(edited)} words"))
        rows.append((1200 + k, f"only {' '.join(text.split()[: len(text.split()) // 2])} half"))
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS size")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc, r.item_id)
           for r in decontaminate.contamination(df, bench, exact=True).collect()}
    want = brute_contamination(rows, items)
    assert got == want and len(want) >= 7
    met = {(r.doc, r.item_id) for r in decontaminate.contamination(df, bench).collect()}
    assert met <= want and len(met) >= 0.9 * len(want)
    clean = [r.doc_id for r in decontaminate.clean_documents(df, bench, exact=True).collect()]
    assert set(clean) == {d for d, _ in rows} - {d for d, _ in want if d is not None}
    assert decontaminate.contamination(df, bench.where("item_id < 0")).collect() == []
    assert decontaminate.contamination(df.where("doc_id = -1"), bench).collect() == []


def test_documents_shorter_than_the_item(spark):
    rnd = random.Random(4)
    item = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(36)]
    other = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    texts = [item[:-1], item[3:], item[:20], item[:4], item[:-2] + ["zzz"], [], item]
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(other))],
                                  "item_id long, text string")
    got = {r.doc: (r.item_id, r.start, r.size, round(r.similarity, 4))
           for r in decontaminate.contamination(docs, bench).collect()}
    # words of five bytes: similarities are shares of the 32 shingles
    assert got == {0: (0, 0, 35, round(31 / 32, 4)), 1: (0, 0, 33, round(29 / 32, 4)),
                   4: (0, 0, 35, round(30 * 25 / (32 * 25 + 23), 4)), 6: (0, 0, 36, 1.0)}
    kept = {r.doc_id for r in decontaminate.clean_documents(docs, bench).collect()}
    assert kept == {2, 3, 5}


def test_long_words_do_not_hide_an_item(spark):
    """Windows of the similarity whose fingerprints are far apart."""
    rnd = random.Random(8)
    bench, rows, far = [], [], 0
    for k in range(60):
        item = ["".join(rnd.choice("abcdefgh") for _ in range(4)) for _ in range(30)]
        item[-1], other = "x" * 60 + str(k), item[:-1] + ["y" * 60 + str(k)]
        bench.append((k, " ".join(item)))
        rows.append((k, " ".join(other)))
        marks = []
        for t in (item, other):
            text = " ".join(t)
            (hashes, _), = decontaminate.grouped_words([text], lower=True)
            own = decontaminate.Fingerprints(hashes, decontaminate.byte_lengths(text))
            marks.append(int(own(np.array([0]), 30)[0]))
        far += (marks[0] ^ marks[1]).bit_count() > decontaminate.RADIUS
    got = {(r.doc, r.item_id) for r in decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string"), exact=True).collect()}
    assert got == {(k, k) for k in range(60)} and far


def test_fillers_that_repeat_do_not_hide_an_item(spark):
    rnd = random.Random(6)
    long = ["".join(rnd.choice("abcdefgh") for _ in range(12)) for _ in range(30)]
    bench = [(0, " ".join(long + ["so"] * 60))]
    rows = [(0, " ".join(long + ["um"] * 60)), (1, " ".join(["um"] * 90)),
            (2, " ".join(["um"] * 40 + long + ["um"] * 70 + ["end"]))]
    found = decontaminate.contamination(
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame(bench, "item_id long, text string"), exact=True).collect()
    assert {(r.doc, r.item_id) for r in found} == brute_contamination(rows, bench) >= {(0, 0)}


def test_multi_index_finds_all_within_the_radius():
    rnd = random.Random(9)
    for _ in range(300):
        mark = rnd.getrandbits(64)
        other = mark
        for bit in rnd.sample(range(64), rnd.randint(0, decontaminate.RADIUS)):
            other ^= 1 << bit
        near = [(((mark ^ other) >> first) & ((1 << width) - 1)).bit_count()
                for first, width in decontaminate.BLOCKS]
        assert min(near) <= 1
    assert sum(width for _, width in decontaminate.BLOCKS) == 64


@pytest.fixture(scope="module")
def stages(spark):
    from ledgerlake.llm.common import documents, staged
    out, docs = [], documents(spark, SMALL)
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SMALL), name)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns_and_act(stages):
    assert [s[0] for s in stages] == ["quality", "near_duplicates", "substrings",
                                      "decontamination", "packing"]
    for name, before, after in stages[:-1]:
        assert after.columns == before.columns
        ids = {r.doc_id for r in before.select("doc_id").collect()}
        assert {r.doc_id for r in after.select("doc_id").collect()} <= ids
        if name != "substrings":
            assert 0 < after.count() < before.count()
    final, pieces = stages[3][2], stages[4][2]
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {
        r.doc_id for r in final.select("doc_id").collect()}


def test_quality_stage_keeps_good_documents(spark, stages):
    kept = {r.doc_id for r in stages[0][2].select("doc_id").collect()}
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").collect()
    good = [r.doc_id in kept for r in labels if r.quality == 1]
    bad = [r.doc_id in kept for r in labels if r.quality == 0]
    assert sum(good) / len(good) > 0.97 and sum(bad) / len(bad) < 0.1


def test_decontamination_stage_leaves_no_verbatim_item(spark, stages):
    items = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    before = [r.text for r in stages[3][1].select("text").collect()]
    after = [r.text for r in stages[3][2].select("text").collect()]
    def hit(t):
        return any(i in " ".join(t.split()) for i in (" ".join(x.split()) for x in items))
    assert any(map(hit, before)) and not any(map(hit, after))
