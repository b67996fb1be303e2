"""Shared pieces of the corpus operators: word splitting, word hashes,
tables on shared storage.

A *word* is a maximal run of bytes other than the ASCII blanks 0x20 and
0x09-0x0D; ``bytes.split()`` cuts exactly there.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_path

# A Java regular expression for one or more separators between words.
BLANKS = r"[\x20\x09-\x0D]+"
# Upper-case to lower-case ASCII only; other letters stay.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# Rows handed to Python at a time while a staged table is written: texts can
# be long, and both the executor and its worker hold a whole batch.
BATCH_ROWS = 1000
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def staged(df: DataFrame, name: str, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Write ``df`` as Parquet on the shared checkpoint folder and read it
    back: cuts the lineage and survives lost executors. Python gets at most
    ``batch_rows`` rows at a time."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(int(before), batch_rows)))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_ROWS, before)
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


# Folders staged within each open ``tidy``.
_made: list[list[str]] = []


@contextmanager
def tidy(spark: SparkSession) -> Iterator[list[str]]:
    """Notes the folders staged inside, for ``sweep``; what fails leaves
    them."""
    _made.append([])
    try:
        yield _made[-1]
    finally:
        left = _made.pop()
        if _made:  # a surrounding operator may sweep them
            _made[-1].extend(left)


def sweep(made: list[str], result: DataFrame, name: str) -> DataFrame:
    """Stage ``result`` and delete the operator's other staged folders."""
    spark = result.sparkSession
    before = list(made)
    kept = staged(result, name)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in before:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        made.remove(folder)
    return kept


def ascii_lower(col: Column) -> Column:
    return F.translate(col, _UPPER, _LOWER)


def words_of(text: Column) -> Column:
    """Array of the words of ``text`` (null text: empty array)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS), lambda w: w != "")


def text_words(text: str | None, lower: bool = False) -> list[bytes]:
    if not text:
        return []
    raw = text.encode()
    # bytes.lower() changes A-Z only.
    return (raw.lower() if lower else raw).split()


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


class Ranges:
    """Hashes of ranges of a sequence in constant time each: prefix sums of
    the elements' hashes times a power of an odd base, modulo 2^64."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, elements: np.ndarray, base: int):
        self._up, self._down = self._table(base, len(elements) + 1)
        self._sums = np.zeros(len(elements) + 1, np.uint64)
        np.cumsum(elements * self._up[:len(elements)], out=self._sums[1:])

    @classmethod
    def _table(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(4096, 1 << (n - 1).bit_length())
            have = tuple(
                np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(
                    np.full(size - 1, b, np.uint64))])
                for b in (base, pow(base, -1, 1 << 64)))
            cls._powers[base] = have
        return have

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = self._sums[end] - self._sums[start]
        raw *= self._down[start]
        raw += (end - start).astype(np.uint64)
        return mix(raw)


BASES = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)
_LETTER_BASE = 0xA0761D6478BD642F
_LETTER_TERM = np.uint64(BASES[1])
_BLANK_BYTES = (0x20, *range(0x09, 0x0E))
_TO_SPACE = bytes(0x20 if b in _BLANK_BYTES else b for b in range(256))
_IN_WORD = bytes(b not in _BLANK_BYTES for b in range(256))
# Texts are hashed in stretches of about so many bytes, cut at blanks.
STRETCH = 1 << 18


def word_hashes(text: str | None, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word, in order; ``lower`` folds A-Z first."""
    raw = (text or "").encode()
    return hashed_words(raw.lower() if lower else raw)[0]


def hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of an encoded text."""
    if len(raw) <= STRETCH:
        return stretch_words(raw)
    raw, parts, at = raw.translate(_TO_SPACE), [], 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= STRETCH else raw.rfind(b" ", at, at + STRETCH) + 1
        if end <= 0:  # one word fills the stretch
            end = raw.find(b" ", at) + 1 or len(raw)
        words, starts = stretch_words(raw[at:end])
        parts.append((words, starts + at))
        at = end
    return tuple(map(np.concatenate, zip(*parts)))


def hand_back() -> None:
    """Return what earlier operators left unused in this Python worker."""
    pa.default_memory_pool().release_unused()


def spare_memory() -> None:
    """A Python worker serves many operators; one that hashes words needs
    none of the pieces that tokenising has remembered."""
    tokens = sys.modules.get("ledgerlake.llm.tokens")
    if tokens is not None:
        tokens.forget()
    hand_back()


def grouped_words(texts: Iterable, lower: bool = False
                  ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The word hashes of all texts (strings or an Arrow column), some texts
    at a time: (words, bounds) with text i of the group in
    words[bounds[i]:bounds[i + 1]]."""
    spare_memory()
    held, size = [], 0
    for t in texts:
        if isinstance(t, pa.Scalar):
            t = t.as_py()
        raw = (t or "").encode()
        if lower:
            raw = raw.lower()
        if held and size + len(raw) > STRETCH:
            yield _group(held)
            held, size = [], 0
        held.append(raw)
        size += len(raw) + 1
    if held:
        yield _group(held)


def _group(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    if len(raws) == 1:
        words = hashed_words(raws[0])[0]
        return words, np.array([0, len(words)])
    words, starts = stretch_words(b" ".join(raws))
    first = np.zeros(len(raws) + 1, np.int64)
    np.cumsum([len(r) + 1 for r in raws], out=first[1:])
    return words, np.searchsorted(starts, first)


def stretch_words(raw: bytes, in_word: bytes = _IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words, runs of the bytes that ``in_word``
    marks."""
    inside = np.frombuffer(b"\0" + raw.translate(in_word) + b"\0", np.bool_)
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    if not len(turns):
        return np.empty(0, np.uint64), turns
    letters = np.frombuffer(raw, np.uint8).astype(np.uint64)
    letters *= letters + _LETTER_TERM
    return Ranges(letters, _LETTER_BASE)(turns[::2], turns[1::2]), turns[::2]


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def shingle_sets(texts: Iterable, length: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its lower-cased word
    shingles. A text with fewer words is one shingle; without words, none."""
    for words, bounds in grouped_words(texts, lower=True):
        ranges = Ranges(words, BASES[0])
        at = np.arange(max(0, len(words) - length + 1))
        shingles = ranges(at, at + length)
        for a, b in pairwise(bounds.tolist()):
            if b - a >= length:
                yield distinct(shingles[a:b - length + 1])
            elif b > a:
                yield ranges(np.array([a]), np.array([b]))
            else:
                yield words[:0]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as a Spark long."""
    return np.ascontiguousarray(x).view(np.int64)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def merged(rows, schema: pa.Schema, least: int = 20_000):
    """Join the small batches of ``rows`` (one a document) into larger ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in rows(batches):
            held.append(b)
            n += b.num_rows
            if n >= least:
                yield pa.Table.from_batches(held, schema).combine_chunks().to_batches()[0]
                held, n = [], 0
        if n:
            yield pa.Table.from_batches(held, schema).combine_chunks().to_batches()[0]
    return run
