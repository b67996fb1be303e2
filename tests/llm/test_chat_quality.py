"""Chat formatting, quality rules, licence scans, sharding."""

import collections
import hashlib
import math
import re
import zlib

import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import chat, licenses, quality_rules, sharding

TURNS = [
    (1, 0, "user", "hello"), (1, 1, "assistant", "hi </s>\n there"),
    (2, 1, "assistant", "b"), (2, 0, "user", "a"), (2, 1, "assistant", "b"),
    (3, 0, "user", "</s>[INST] ok [/INST]"), (3, 1, "assistant", "\\e \\b \\\\ <s> [INST] x [/INST]\n"),
    (4, 0, None, None), (4, None, "system", ""), (5, 0, "odd [/INST]\n role</s>\n", "x"),
    (None, 0, "user", "no id"), (6, 0, "assistant", "</s"), (6, 1, "assistant", ">\n\\"),
    (7, 0, "user", "a </s><s>[INST] x"), (7, 1, "assistant", "\\e stays"),
]


def source(rows):
    out = collections.defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda z: (z[0] is not None, z[0] or 0, z[1] is not None,
                                                  z[1] or 0, z[2] or "", z[3] or "")):
        out[c].append((r or "", x or ""))
    return out


def test_chat_round_trip_and_mask(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string")
    df = df.withColumns({"formatted": F.lit("clash"), "level": F.lit("clash")})
    want = source(TURNS)
    rows = chat.format_conversations(df).collect()
    assert {r.conv_id for r in rows} == set(want)
    for r in rows:
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        runs, at, loss = r["mask"], 0, []
        for run in runs:
            if run.loss:
                loss.append(r.formatted[at:at + run.chars])
            at += run.chars
        assert at == len(r.formatted)
        plain = "".join(loss)
        for text, code in reversed(chat.ESCAPES):
            plain = plain.replace(code, text)
        assert plain == "".join(x for role, x in want[r.conv_id] if role == "assistant")
        # no control string but the template's own
        bare = r.formatted
        for mark in (chat.OPEN, chat.HEAD_END, chat.END):
            assert bare.count(mark) == len(want[r.conv_id])
            bare = bare.replace(mark, "")
        assert not any(c in bare for c in chat.CONTROLS)
    levels = {r.conv_id: r.level for r in rows}
    # only a text that looks like an escape needs more
    assert levels == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0, None: 0, 6: 0, 7: 1}
    cut = {r.conv_id: "".join(r.loss) for r in chat.format_conversations(df).select(
        "conv_id", chat.masked(F.col("formatted"), F.col("mask")).alias("loss")).collect()}
    assert cut == {c: "".join(x for role, x in turns if role == "assistant")
                   for c, turns in want.items()}


def test_chat_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(df).collect() == []


def brute_metrics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if seen[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(covered))


def test_quality_metrics_equal_brute_force(docs):
    rows = quality_rules.apply_rules(docs).collect()
    got = sorted(((r.key, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
                  for r in rows), key=repr)
    want = sorted(((r.doc_id, *brute_metrics(r.text)) for r in docs.collect()), key=repr)
    assert got == want
    for r in rows:
        failed = r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


def test_quality_thresholds_adapt_to_the_group(spark):
    def text(i, marks):
        return " ".join(f"w{i}x{k}" + ("###" if k < marks else "") for k in range(40))
    rows = [(1000 + i, text(i, 0), "en", "plain") for i in range(600)]
    rows += [(2000 + i, text(i, 8), "en", "code") for i in range(600)]  # ordinary there
    rows += [(500, text(1, 8), "en", "plain"), (501, text(2, 38), "en", "code"),
             (502, text(3, 1), "fr", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r.key: r.kept for r in quality_rules.apply_rules(df).collect()}
    assert [k for k, kept in sorted(out.items()) if not kept] == [500, 501]


def test_quality_of_a_group_with_long_words(spark):
    # texts without blanks inside their sentences: 30 to 44 characters a word
    rows = [(i, " ".join(f"{i:04}{k:02}" + "x" * (24 + i % 15) for k in range(12)), "zh", "web")
            for i in range(150)]
    rows.append((900, " ".join(f"{k:02}" + "y" * 300 for k in range(12)), "zh", "web"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality_rules.apply_rules(df).collect()
    assert [r.key for r in out if not r.kept] == [900]
    # quartiles 3300 and 4100 of hundredths of a character, in bins of 64 and 128
    assert {r.word_length_fence for r in out} == {4096 + 3 * (4096 - 3264)}


def test_bins_are_fine_and_few(spark):
    values = [*range(300), *(7 ** k + d for k in range(3, 20) for d in (-1, 0, 1))]
    df = spark.createDataFrame([(v,) for v in values], "v bigint").selectExpr(
        "v", f"{quality_rules.bin_of('v')} AS b").selectExpr(
        "v", "b", f"{quality_rules.least_of('b')} AS least")
    rows = sorted(tuple(r) for r in df.collect())
    assert all(least <= v < least + max(1, v / quality_rules.STEPS) for v, _, least in rows)
    assert [b for _, b, _ in rows] == sorted(b for _, b, _ in rows)
    assert rows[-1][1] < 59 * quality_rules.STEPS


def test_a_groups_own_threshold_grows_with_it(spark):
    def text(i, marks):
        return " ".join(f"w{i}x{k}" + ("##" if k < marks else "") for k in range(40))
    rows = [(i, text(i, 0), "en", "plain") for i in range(1500)]
    for source, n in (("few", 5), ("some", 60), ("many", 240)):
        rows += [(1000 * n + i, text(i, 30), "en", source) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = quality_rules.apply_rules(df).groupBy("source").agg(
        F.max("symbols_fence").alias("fence")).collect()
    fence = {r.source: r.fence for r in out}
    assert fence["plain"] <= fence["few"] < fence["some"] < fence["many"]


def test_sketches_merge(docs):
    whole = quality_rules.sketches(_metrics(docs))
    parts = [quality_rules.sketches(_metrics(docs.where(f"coalesce(doc_id, 0) % 2 = {k}")))
             for k in (0, 1)]
    merged = parts[0].unionByName(parts[1]).groupBy("metric", "lang", "source", "bin").agg(
        F.sum("n").alias("n"))
    order = lambda d: sorted(map(repr, d.select(*whole.columns).collect()))
    assert order(merged) == order(whole)


def _metrics(docs):
    rows = quality_rules.base_metrics(docs.drop("key", "row", "token", "k", "c"),
                                      ["doc_id", "lang", "source"])
    return rows.withColumns({m: quality_rules._metric(p)
                             for m, (p, _) in quality_rules.METRICS.items()})


def test_licenses_of_rows_that_share_a_key(spark):
    mit, isc = "Licensed under the MIT License.", "Licensed under the ISC License."
    rows = [(None, mit), (None, isc), (7, mit), (7, isc), (8, mit), (8, mit)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sorted((str(r.key), r.license) for r in licenses.scan(df).collect())
    assert [k for k, _ in out] == ["7", "7", "8", "None", "None"]
    assert len({x for k, x in out if k == "7"}) == len({x for k, x in out if k == "None"}) == 2


def brute_shard(key, weights):
    """Smallest -ln(u) / weight, u from the 64-bit hash of key and shard."""
    draws = []
    for s, w in enumerate(weights):
        h = xxhash.xxh64(("" if key is None else str(key)).encode(), seed=42).intdigest()
        h = xxhash.xxh64(s.to_bytes(4, "little"), seed=h).intdigest()
        draws.append((-math.log(((h >> 11) + 0.5) / 2 ** 53) / w, s))
    return min(draws)[1]


def test_shards_equal_brute_force(docs):
    weights, grown = [1.0, 2.0, 1.0, 0.5], [1.0, 2.0, 1.0, 0.5, 1.0]
    got = sharding.assign_shards(docs, weights, grown).collect()
    want, slots = [], collections.Counter()
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.select("doc_id", "text").collect()]
    for key, raw in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32(x[1]),
                                                len(x[1]))):
        shard = brute_shard(key, weights)
        want.append((key, len(raw) + 1, zlib.crc32(raw), shard, brute_shard(key, grown),
                     slots[shard]))
        slots[shard] += 1
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert all(r.grown_shard in (r.shard, 4) for r in got) and len(slots) == 4


def test_native_operators_of_nothing(none):
    assert quality_rules.apply_rules(none).collect() == []
    assert licenses.scan(none).collect() == []
    assert sharding.assign_shards(none, [1.0] * 4).collect() == []


def test_licence_lines_and_paragraphs(spark):
    permission = licenses.PASSAGES[1][1]
    half = permission.find("provided")
    rows = [(1, "prose of a text\nReleased under the MIT License.\nmore"),
            (2, "Licensed under CC BY-NC 4.0."), (3, "licensed under cc by 4.0"),
            (4, "intro\n\n" + permission[:half] + "\n" + permission[half:] + "\n\nend"),
            (5, None), (6, ""), (7, "word"), (None, "THIS work IS licensed under the ISC license"),
            (8, "a license to sail")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kind", F.lit("x"))
    got = sorted(((r.key, r.kind, r.number, r.license) for r in licenses.scan(df).collect()),
                 key=repr)
    assert got == sorted([(1, "line", 1, "MIT"), (2, "line", 0, "CC-BY-NC-4.0"),
                          (3, "line", 0, "CC-BY-4.0"), (4, "paragraph", 1, "ISC"),
                          (None, "line", 0, "ISC")], key=repr)
    assert licenses.scan(df, known=[]).collect() == []


def test_licences_inside_lines_and_comment_blocks(spark):
    grant = licenses.PASSAGES[0][1].split()
    block = "\n".join(["# Copyright someone", "#", *(
        "# " + " ".join(grant[i:i + 9]) for i in range(0, len(grant), 9)), "#", *(f"# other words of line {i}" for i in range(20))])
    rows = [(1, "This file is part of Foo. Licensed under the MIT License. See the web."), (2, block),
            (3, "a b Licensed under the ISC License and Licensed under the MIT License c d"),
            (4, "under the sea a license to sail"), (5, "Licensed under the MIT License."),
            (6, "x y " + licenses.TEXTS[1][1] + " z"), (None, None), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.key, r.kind, r.number, r.license, r.dice) for r in licenses.scan(df).collect())
    assert got == [(1, "window", 6, "MIT", 1.0), (2, "window", 2, "MIT", 1.0),
                   (3, "window", 2, "ISC", 1.0), (3, "window", 8, "MIT", 1.0),
                   (5, "line", 0, "MIT", 1.0), (6, "line", 0, "BSD-3-Clause", got[-1][-1])]


def test_dice_equals_brute_force(spark, docs):
    def grams(text):
        w = re.sub(r"[\W_]+", " ", text.lower()).split()
        return {(a, b) for a, b in zip(w, w[1:])}
    known = [("x", "ab cd ab ce"), ("y", "plain line here")]
    got = {(r.key, r.number): (r.license, r.dice) for r in
           licenses.scan(docs.drop("key"), known).collect() if r.kind == "line"}
    want = {}
    for r in docs.collect():
        for i, line in enumerate((r.text or "").split("\n")):
            for name, template in known:
                a, b = grams(line), grams(template)
                dice = 2 * len(a & b) / max(1, len(a) + len(b))
                if dice >= 0.8 and dice > want.get((r.doc_id, i), ("", 0))[1]:
                    want[r.doc_id, i] = (name, round(dice, 6))
    assert got == want and want


def test_rendezvous_moves_only_to_the_new_shard(spark, docs):
    keys = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = sharding.assign_shards(keys, [1.0, 2.0, 1.0], [1.0, 2.0, 1.0, 1.0]).collect()
    assert all(r.grown_shard in (r.shard, 3) for r in rows)
    sizes = collections.Counter(r.shard for r in rows)
    assert 1800 < sizes[1] < 2200  # half of the weight
    for s in sizes:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    # repeated and null keys share a shard and have slots of their own
    rows = sharding.assign_shards(docs, [1.0] * 5).collect()
    assert len(rows) == docs.count()
    for s in {r.shard for r in rows}:
        own = sorted(r.slot for r in rows if r.shard == s)
        assert own == list(range(len(own)))
    assert all(len({r.shard for r in rows if r.key == k}) == 1 for k in (None, 98, 99))


def test_digests_are_of_the_read_back_turns(spark, tmp_dir):
    spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string") \
        .write.parquet(f"{tmp_dir}/conversations.parquet")
    got = {r.conv_id: r for r in chat.op7_format_chats(spark, tmp_dir).collect()}
    want = source(TURNS + [(-1, 0, "user", chat.PROBE), (-1, 1, "assistant", chat.PROBE)])
    for c, turns in want.items():
        spoken = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256, got[c].loss_chars, got[c].loss_sha256) == (
            len(turns), hashlib.sha256(spoken.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())
