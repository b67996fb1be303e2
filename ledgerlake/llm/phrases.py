"""Phrase mining by sampling with a negative border (Toivonen).

Texts are split into pieces at punctuation and line ends, pieces into words;
a phrase is 2 to ``longest`` consecutive words of a piece. Everything is
counted per language.

1. A sample of the documents, mined level by level at a lowered threshold,
   proposes the phrases S.
2. One pass over all texts counts S and its negative border exactly: every
   word, and every longer phrase whose first and last words less one are
   both in S.
3. A border phrase that turns out frequent is a failure: its extensions were
   not counted. Another pass counts just those, and so on until no pass
   finds a frequent phrase that can be extended (``longest`` passes at most).

These passes count hashes of whole phrases, one number each, which keeps what
they shuffle small; phrases that share a hash can only make it too frequent.
A last pass counts what they found by the hashes of both parts.

The sample decides how many passes are needed, never the result. S travels
to the tasks as bitmaps of fixed size; a phrase that passes by chance is
counted too, which costs time and changes nothing. What an earlier pass has
counted is told by following that pass through its levels: a phrase that
merely lies in its bitmap by chance may never have been reached.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.bitmaps import broadcast_bitmap, in_bitmap
from ledgerlake.llm.common import (STRETCH, batch, documents, mix, signed, spare_memory, staged,
                                   stretch_words, sweep, tidy)
from ledgerlake.operators.ranking import number_within

LEAST = 100
LONGEST = 5
TOP = 2000
# Share of the documents in the sample, and how far the threshold is lowered
# there so that few frequent phrases are missed.
SAMPLE = 1 / 16
LOWERED = 0.75
SEED = 11
# A phrase is dropped for a longer one with at least this share of its count.
CONTAINED_PERCENT = 100
UNKNOWN = "und"

# Fixed bytes of the definition of pieces and words.
_BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BLANKS = b"\x20\x09"
_IS_BREAK = bytes(b in _BREAKS for b in range(256))
_IN_WORD = bytes(b not in _BREAKS + _BLANKS for b in range(256))
_IN_WORDS = re.compile(rb"[^.,;:!?\x09-\x0d\x20]+")
_AS_SPACE = bytes(0x20 if b in _BREAKS + _BLANKS else b for b in range(256))
_FIRST = np.uint64(0x9E3779B97F4A7C15)
# Words whose phrases are hashed at a time.
BLOCK = 1 << 17
# Phrase occurrences a task counts at a time before it hands them on.
COUNTED = 1 << 21
# Different phrases whose counts a task keeps to add the next ones to.
KEPT = 1 << 19


class Words:
    """Word hashes of some documents in a row: ``piece`` numbers the pieces,
    ``text`` the documents, ``lang`` holds a hash of each word's language."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        raw = b"\n".join(texts)
        hashes, starts, breaks, at, seen = [], [], [], 0, 0
        spaced = raw.translate(_AS_SPACE) if len(raw) > STRETCH else raw
        while at < len(raw):
            end = len(raw)
            if end - at > STRETCH:
                # Cut at a separator; a word may fill the stretch.
                end = spaced.rfind(b" ", at, at + STRETCH) + 1 or (
                    spaced.find(b" ", at) + 1 or len(raw))
            part = raw[at:end]
            h, s = stretch_words(part, _IN_WORD)
            n = np.cumsum(np.frombuffer(part.translate(_IS_BREAK), np.uint8), dtype=np.int64)
            hashes.append(h)
            starts.append(s + at)
            breaks.append(n[s] + seen)
            at, seen = end, seen + (int(n[-1]) if len(n) else 0)
        self.hash = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.start = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.piece = np.concatenate(breaks) if breaks else np.empty(0, np.int64)
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.text = np.searchsorted(ends, self.start, side="right")
        self.lang = np.array([_lang_hash(x) for x in langs], np.uint64)[self.text] \
            if len(self.start) else np.empty(0, np.uint64)

    def blocks(self, longest: int) -> Iterator[tuple[slice, int]]:
        """(words, how many of them start phrases of the block)."""
        for at in range(0, len(self.hash), BLOCK):
            yield slice(at, at + BLOCK + longest - 1), min(BLOCK, len(self.hash) - at)


_LANGS: dict[str, int] = {}


def _lang_hash(lang: str) -> int:
    if lang not in _LANGS:
        if len(_LANGS) > 100_000:
            _LANGS.clear()
        _LANGS[lang] = int.from_bytes(blake2b(lang.encode(), digest_size=8).digest(), "little")
    return _LANGS[lang]


def _groups(b: pa.RecordBatch) -> Iterator[tuple[list[bytes], list[str]]]:
    """Texts (columns lang, text) some at a time, lower-cased in A-Z."""
    texts, langs, size = [], [], 0
    for lang, text in zip(b.column(0), b.column(1)):
        raw = (text.as_py() or "").encode().lower()
        if texts and size + len(raw) > STRETCH:
            yield texts, langs
            texts, langs, size = [], [], 0
        texts.append(raw)
        langs.append(lang.as_py())
        size += len(raw)
    if texts:
        yield texts, langs


def _named(first: np.ndarray, rest: np.ndarray, k: int) -> np.ndarray:
    """Hash of a phrase of k words from those of its first and last k - 1
    words (a word: from its own and 0); the low bits hold k."""
    h = mix(first * _FIRST ^ rest)
    return (h & ~np.uint64(7)) | np.uint64(k)


def _has(bitmap: np.ndarray, grams: np.ndarray) -> np.ndarray:
    return in_bitmap(bitmap, grams >> np.uint64(3))


def _bitmap(rows: DataFrame) -> Broadcast:
    return broadcast_bitmap(rows, F.shiftrightunsigned("gram", 3))


def _levels(w: Words, part: slice, first: int, lengths, known: np.ndarray | None,
            done: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, firsts, rests): the parts of the phrases of k words whose two
    parts of k - 1 words are both reached and in ``known``, but for those
    that an earlier pass counted: both parts reached and in the pass's bitmap
    in ``done``. Words (k = 1) all count, as themselves and 0. Starts from
    ``first`` on belong to the next block."""
    piece = w.piece[part]
    at = np.arange(len(piece))
    before = [np.ones(len(piece), bool) for _ in done]
    left, right = w.hash[part] ^ w.lang[part], np.zeros(len(piece), np.uint64)
    for k in range(1, max(lengths) + 1):
        if k > 1:
            pair = inside[:-1] & inside[1:]
            pair &= piece[:len(pair)] == piece[k - 1:k - 1 + len(pair)]
            at = np.flatnonzero(pair)
            left, right = below[at], below[at + 1]
            before = [was[at] & was[at + 1] for was in old]
        h = _named(left, right, k)
        if k in lengths:
            counted = at < first
            if k > 1:
                for reached in before:
                    counted &= ~reached
                yield k, left[counted], right[counted]
            else:
                yield k, h[counted], right[counted]
        size = len(piece) - k + 1
        if k == max(lengths) or size <= 1:
            return
        below, inside, old = np.zeros(size, np.uint64), np.zeros(size, bool), []
        below[at], inside[at] = h, _has(known, h)
        for bitmap, reached in zip(done, before):
            was = np.zeros(size, bool)
            was[at] = reached & _has(bitmap, h)
            old.append(was)


_REACHED = pa.schema([("gram", pa.int64()), ("hits", pa.int64())])
_REACHED_SQL = "gram bigint, hits bigint"
_COUNTS = pa.schema([("gram", pa.int64()), ("first", pa.int64()), ("rest", pa.int64()),
                     ("hits", pa.int64())])
_COUNTS_SQL = "gram bigint, first bigint, rest bigint, hits bigint"


def _counted(lengths, known: Broadcast | None, done: list[Broadcast],
             wanted: Broadcast | None = None):
    """Counts of the phrases of ``_levels`` by task, or by stretch of documents
    where a task meets many: (gram, hits); with ``wanted``, of those in it and told apart by both their
    parts, too: (gram, first, rest, hits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_memory()
        held, size = [], 0
        kept = None  # keys and hits of the stretches before, bounded

        def summed() -> list[np.ndarray]:
            """Keys and hits of what is held and kept."""
            keys = list(map(np.concatenate, zip(*held)))
            hits = np.ones(len(keys[0]), np.int64)
            if kept is not None:
                keys = [np.concatenate(both) for both in zip(kept, keys)]
                hits = np.concatenate([kept[-1], hits])
            order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0])
            keys = [key[order] for key in keys]
            new = np.ones(len(order), bool)
            new[1:] = np.any([key[1:] != key[:-1] for key in keys], axis=0)
            at = np.flatnonzero(new)
            return [*(key[at] for key in keys), np.add.reduceat(hits[order], at)]

        def found(counts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            *keys, hits = counts
            for i in range(0, len(hits), 100_000):
                part = slice(i, i + 100_000)
                yield batch(_REACHED if wanted is None else _COUNTS,
                            *(signed(key[part]) for key in keys), hits[part])

        for b in batches:
            for texts, langs in _groups(b):
                w = Words(texts, langs)
                for part, first in w.blocks(max(lengths)):
                    for k, left, right in _levels(w, part, first, lengths,
                                                  None if known is None else known.value,
                                                  [d.value for d in done]):
                        gram = left if k == 1 else _named(left, right, k)
                        if wanted is None:
                            held.append((gram,))
                        else:
                            hit = _has(wanted.value, gram)
                            gram = gram[hit]
                            held.append((gram, left[hit], right[hit]))
                        size += len(gram)
                if size >= COUNTED:
                    kept, held, size = summed(), [], 0
                    if len(kept[0]) > KEPT:
                        yield from found(kept)
                        kept = None
        if size:
            kept = summed()
        if kept is not None:
            yield from found(kept)
    return run


def _reached(rows: DataFrame, least: float, lengths, known, done, name: str) -> DataFrame:
    """(gram) of the phrases counted that reach ``least``, staged. Phrases
    that share a gram are counted as one, so none is lost; at most one too
    many is kept."""
    counts = rows.mapInArrow(_counted(tuple(lengths), known, done), _REACHED_SQL)
    return staged(counts.groupBy("gram").agg(F.sum("hits").alias("hits"))
                  .where(F.col("hits") >= least).select("gram"), name)


def _length() -> Column:
    return F.col("gram").bitwiseAND(F.lit(7))


_WORDS = pa.schema([("gram", pa.int64()), ("lang", pa.string()), ("word", pa.string()),
                    ("n", pa.int64())])
_WORDS_SQL = "gram bigint, lang string, word string, n bigint"


def _spelled(wanted: Broadcast):
    """The words in the bitmap, each about once a task; besides, the number
    of words of each language (no gram)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spare_memory()
        seen: set[int] = set()  # bounded; a word may be sent again
        totals: dict[str, int] = {}
        for b in batches:
            out = []
            for texts, langs in _groups(b):
                w = Words(texts, langs)
                for i, n in enumerate(np.bincount(w.text, minlength=len(texts)).tolist()):
                    totals[langs[i]] = totals.get(langs[i], 0) + n
                raw = b"\n".join(texts)
                h, at = np.unique(w.hash ^ w.lang, return_index=True)
                h = _named(h, np.zeros(len(h), np.uint64), 1)
                hit = np.flatnonzero(_has(wanted.value, h))
                for gram, i in zip(signed(h[hit]).tolist(), at[hit].tolist()):
                    if gram in seen:
                        continue
                    if len(seen) < 1_000_000:
                        seen.add(gram)
                    word = _IN_WORDS.match(raw, int(w.start[i])).group()
                    out.append((gram, langs[int(w.text[i])], word.decode(), None))
            if out:
                yield batch(_WORDS, *zip(*out))
        if totals:
            none = [None] * len(totals)
            yield batch(_WORDS, none, list(totals), none, list(totals.values()))
    return run


def frequent_phrases(rows: DataFrame, least: int = LEAST, longest: int = LONGEST,
                     sample: float = SAMPLE) -> DataFrame:
    """(gram, k, first, rest, hits) of every word and phrase of up to
    ``longest`` words of the rows (lang, text) that occurs ``least`` times
    in its language; first and rest are the grams of its parts of k - 1
    words."""
    # The sample's own phrases, level by level.
    picked = staged(rows.sample(False, min(1.0, sample), SEED), "phrases-sample")
    lowered = max(2, int(least * min(1.0, sample) * LOWERED))
    proposed, known = None, None
    for k in range(1, longest):
        level = _reached(picked, lowered, [k], known, [], "phrases-level")
        proposed = level if proposed is None else proposed.unionByName(level)
        known = _bitmap(proposed)

    # The full pass over them and their border, then over what failed.
    grams = _reached(rows, least, range(1, longest + 1), known, [], "phrases-grams")
    new = grams.join(proposed, "gram", "left_anti").where(_length() < longest)
    done = [known]
    while not new.isEmpty():
        known = _bitmap(grams)
        more = _reached(rows, least, range(2, longest + 1), known, done, "phrases-grams")
        done.append(known)
        grams, new = grams.unionByName(more), more.where(_length() < longest)

    # What is left is little: counted by both parts. The parts of a frequent
    # phrase are frequent, so it is found among them.
    known = _bitmap(grams)
    counts = rows.mapInArrow(_counted(tuple(range(1, longest + 1)), known, [], known), _COUNTS_SQL)
    return staged(counts.groupBy("gram", "first", "rest").agg(F.sum("hits").alias("hits"))
                  .where(F.col("hits") >= least)
                  .select("gram", _length().cast("int").alias("k"), "first", "rest", "hits"),
                  "phrases-counts")


def _described(counts: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """(gram, k, lang, phrase, a, heads, tails) of the phrases of two words
    and more: the counts of their first and last 1, 2, ... k words."""
    level = staged(counts.where("k = 1").join(words, "gram").select(
        "gram", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"),
        F.array("hits").alias("heads"), F.array("hits").alias("tails")), "phrases-spelled")
    out = []
    for k in range(2, longest + 1):
        level = staged(
            counts.where(F.col("k") == k)
            .join(level.select(F.col("gram").alias("first"), "lang",
                               F.col("phrase").alias("head"), "heads"), "first")
            .join(level.select(F.col("gram").alias("rest"), "last", "tails"), "rest")
            .select("gram", "lang", F.concat_ws(" ", "head", "last").alias("phrase"), "last",
                    F.array_append("heads", F.col("hits")).alias("heads"),
                    F.array_append("tails", F.col("hits")).alias("tails"),
                    F.col("hits").alias("a")), "phrases-spelled")
        out.append(level.select("gram", F.lit(k).alias("k"), "lang", "phrase", "a", "heads",
                                "tails"))
    return reduce(DataFrame.unionByName, out)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 percent: int = CONTAINED_PERCENT, sample: float = SAMPLE,
                 text: str = "text", lang: str = "lang") -> DataFrame:
    """Per language (null: ``und``) the ``top`` phrases by score: lang, rank,
    phrase, a, l, r, n, score.

    A phrase that occurs a times and is cut into parts of l and r
    occurrences scores floor(1000 a n / (l r)), n being the language's
    words; the lowest cut counts (ties: the first). A phrase inside a longer
    frequent one with at least ``percent`` hundredths of its count is
    dropped. Ties in score go to the larger a, then by the phrase's bytes.

    Null and blank texts have no words; repeated rows count as often as they
    stand; texts of any length are read whole; no rows give no rows; other
    columns are not read. Words are told apart by 61-bit hashes, phrases by
    pairs of them.
    """
    with tidy(docs.sparkSession) as made:
        rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                           F.col(text).cast("string").alias("text"))
        counts = frequent_phrases(rows, least, longest, sample)
        phrases = counts.where("k > 1")
        # The words of a phrase are those of its pairs, and these are frequent.
        needed = counts.where("k = 2").select(F.explode(F.array("first", "rest")).alias("gram"))
        found = staged(rows.mapInArrow(_spelled(_bitmap(needed)), _WORDS_SQL), "phrases-words")
        words = found.where("gram is not null").groupBy("gram").agg(
            F.min("lang").alias("lang"), F.min("word").alias("word"))
        totals = found.where("gram is null").groupBy("lang").agg(F.sum("n").alias("n"))

        # A longer phrase covers its parts one word shorter; theirs cover theirs.
        dropped = (phrases.where("k > 2")
                   .select("hits", F.explode(F.array("first", "rest")).alias("gram"))
                   .groupBy("gram").agg(F.max("hits").alias("most")).join(phrases, "gram")
                   .where(F.col("most") * 100 >= F.col("hits") * percent).select("gram"))
        left = (_described(counts, words, longest).join(dropped, "gram", "left_anti")
                .join(totals, "lang"))
        # Products of up to 36 digits, exact.
        wide = "decimal(15, 0)"
        cuts = F.expr(f"""transform(sequence(1, k - 1), place -> struct(
            1000BD * cast(a as {wide}) * cast(n as {wide})
                div (cast(heads[place - 1] as {wide}) * cast(tails[k - place - 1] as {wide}))
                as score,
            place as place, heads[place - 1] as l, tails[k - place - 1] as r))""")
        best = left.withColumn("cut", F.array_min(cuts)).select(
            "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
        order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
        ranked = number_within(best, "lang", order, "rank").where(F.col("rank") <= top)
        return sweep(made, ranked.select(
            "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n",
            "score"), "phrases-ranked")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP11_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda w: w <> '') AS w
  FROM pieces),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS hits
  FROM (SELECT lang, w, k, unnest(range(1, (len(w) - k + 2)::BIGINT)) AS i
        FROM split, range(1, {LONGEST + 1}) t(k) WHERE len(w) >= k)
  GROUP BY ALL HAVING count(*) >= {LEAST}),
phrases AS (SELECT lang, k, phrase, hits AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1),
covered AS (
  SELECT lang, phrase, max(a) AS most FROM (
    SELECT lang, a, array_to_string(list_slice(w, i, j), ' ') AS phrase
    FROM (SELECT *, unnest(range(1, k)) AS i FROM phrases),
         range(2, {LONGEST + 1}) t(j) WHERE j > i AND j <= k AND j - i + 1 < k)
  GROUP BY ALL),
cuts AS (
  SELECT p.*, c AS place, array_to_string(list_slice(w, 1, c), ' ') AS first,
         array_to_string(list_slice(w, c + 1, k), ' ') AS rest
  FROM phrases p, range(1, {LONGEST}) t(c) WHERE c < k),
scored AS (
  SELECT c.lang, c.phrase, c.a, f.hits AS l, s.hits AS r, t.n, place,
         ((1000::HUGEINT * c.a * t.n) // (f.hits::HUGEINT * s.hits))::BIGINT AS score
  FROM cuts c JOIN totals t USING (lang)
  JOIN grams f ON f.lang = c.lang AND f.phrase = c.first
  JOIN grams s ON s.lang = c.lang AND s.phrase = c.rest
  LEFT JOIN covered o ON o.lang = c.lang AND o.phrase = c.phrase
  WHERE o.most IS NULL OR 100 * o.most < {CONTAINED_PERCENT} * c.a),
best AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, place) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best
QUALIFY rank <= {TOP}
"""
