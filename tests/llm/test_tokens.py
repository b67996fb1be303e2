"""Exact tokenisation, wavelet shards and packing."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlake.llm import packing, wavelet
from ledgerlake.llm.tokens import encoder, public_tokenizer
from ledgerlake.session import scratch_path

NAMES = ("word_bpe_49k.json", "byte_bpe_50k.json")
HARD = ["", " ", "a  b", " a\n b \n\nc", "Don't I'M we'LL 3.5 <|endoftext|> <|ENDOFTEXT|>x",
        "é ́a ΑΣ ΣΑΣ. İx ﬁ \x1c y\x85z w 　 中文字 a  b", "a \nb", "a  \nb",
        "a\tb \tc", "²³ ½ µg ª ñ,ñ ...!!", "it's o'clock 'tis 's", "tail ", "tail  "]


@pytest.mark.parametrize("name", NAMES)
def test_pieces_equal_whole_texts(docs, name):
    enc = encoder(public_tokenizer(name))
    texts = HARD + [r.text or "" for r in docs.select("text").collect()]
    for t in texts:
        want = np.array(enc._tokenizer.encode(t, add_special_tokens=False).ids, enc.dtype)
        assert enc.encode(t) == want.tobytes(), t[:80]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab Zé'\n\t,.1<|>́ Σ", max_size=40))
def test_pieces_equal_whole_texts_property(text):
    for name in NAMES:
        enc = encoder(public_tokenizer(name))
        want = enc._tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.encode(text), enc.dtype).tolist() == want


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1500))
def test_wavelet_round_trip(ids):
    w = wavelet.WaveletMatrix(wavelet.build_image(np.array(ids, np.uint32)))
    assert w.decode().tolist() == ids
    for i in range(0, len(ids), 97):
        assert w.access(i) == ids[i]
        assert w.rank(ids[i], i) == ids[:i].count(ids[i])
        assert w.select(ids[i], ids[:i].count(ids[i])) == i
    assert w.rank(69_999, len(ids)) == ids.count(69_999)


def test_shards_read_back(spark, docs):
    path = scratch_path(spark, "test-shards")
    tokenizer = public_tokenizer(NAMES[0])
    wavelet.write_token_shards(docs, path, tokenizer)
    rows = (wavelet.read_token_shards(spark, path)
            .join(wavelet.shard_starts(spark, path), ["part", "shard"]).collect())
    enc = encoder(tokenizer)
    want = sorted((-1 if d is None else d, (np.append(np.frombuffer(enc.encode(t), enc.dtype), 1))
                   .astype("<u4").tobytes()) for d, t in
                  ((r.doc_id, r.text) for r in docs.collect()))
    got = sorted((-1 if r.doc_id is None else r.doc_id, bytes(r.ids)) for r in rows)
    assert got == want
    at = 0
    for r in sorted(rows, key=lambda r: r.first + r.within):
        assert r.first + r.within == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.first + r.within)]
    assert ids == sorted(ids, key=lambda x: -1 if x is None else x)


def test_packing_holds_every_id_once(docs):
    tokenizer = public_tokenizer(NAMES[1])
    rows = packing.pack_documents(docs, tokenizer, tiers=(32, 64, 128)).collect()
    enc = encoder(tokenizer)
    want = sorted((repr(r.doc_id), np.append(np.frombuffer(enc.encode(r.text), enc.dtype), 1)
                   .astype("<u4").tobytes()) for r in docs.collect())
    pieces = {}
    for r in rows:
        pieces.setdefault(repr(r.doc_id), []).append((r.start, r.length, r.doc_tokens, bytes(r.ids)))
    assert all(len(x[3]) == 4 * x[1] for v in pieces.values() for x in v)
    assert sum(len(x[3]) for v in pieces.values() for x in v) == sum(len(x) for _, x in want)
    for d, ids in want:  # ids that repeat have several documents
        if sum(k == d for k, _ in want) == 1:
            own = sorted(pieces[d])
            assert b"".join(x[3] for x in own) == ids
            assert [x[0] for x in own] == np.cumsum([0, *[x[1] for x in own]])[:-1].tolist()
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    padded = 0
    for s in sequences.values():
        s.sort()
        assert [x[0] for x in s] == np.cumsum([0, *[x[1] for x in s]])[:-1].tolist()
        total = sum(x[1] for x in s)
        assert total <= s[0][2]
        padded += total < s[0][2]
    assert padded <= docs.rdd.getNumPartitions()


def test_packing_and_shards_of_nothing(spark, none):
    assert packing.pack_documents(none, public_tokenizer(NAMES[1])).collect() == []
    path = scratch_path(spark, "test-shards")
    wavelet.write_token_shards(none, path, public_tokenizer(NAMES[0]))
    assert wavelet.read_token_shards(spark, path).collect() == []
