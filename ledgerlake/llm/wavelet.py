"""Token-id shards as wavelet matrices.

A shard image holds one bit-plane per id bit, highest bit first. On each
plane the ids stand in the order left by the planes above (zeros first,
then ones, each in order), and counts of ones before every block of 512
bits make rank a lookup, so the image answers ``access``, ``rank``
(counting) and ``select`` (occurrence lookup) without decoding the shard.

Image layout, little-endian: magic ``WVM1``, id bits (u32), ids (u64); per
plane the number of zeros (u64), the packed bits (whole 64-byte blocks) and
one u32 count per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents
from ledgerlake.llm.tokens import encoder, public_tokenizer
from ledgerlake.session import scratch_path

MAGIC = b"WVM1"
BLOCK = 512
END_ID = 1
# A shard is closed once it has this many ids (a document is never cut).
SHARD_IDS = 1 << 20


def build_image(ids: np.ndarray) -> bytes:
    bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
    out = [MAGIC, np.array([bits], "<u4").tobytes(), np.array([len(ids)], "<u8").tobytes()]
    blocks = -(-len(ids) // BLOCK)
    for b in range(bits - 1, -1, -1):
        one = (ids & ids.dtype.type(1 << b)) != 0
        packed = np.zeros(blocks * (BLOCK // 8), np.uint8)
        raw = np.packbits(one, bitorder="little")
        packed[:len(raw)] = raw
        per_block = np.bitwise_count(packed.view("<u8")).reshape(blocks, BLOCK // 64).sum(1)
        before = np.zeros(blocks, "<u4")
        if blocks:
            np.cumsum(per_block[:-1], out=before[1:])
        zeros = np.flatnonzero(~one)
        out += [np.array([len(zeros)], "<u8").tobytes(), packed.tobytes(), before.tobytes()]
        # Taking by place is several times faster than by mask.
        ids = ids.take(np.concatenate([zeros, np.flatnonzero(one)]))
    return b"".join(out)


class WaveletMatrix:
    """Reads a shard image in place."""

    def __init__(self, image: bytes):
        if image[:4] != MAGIC:
            raise ValueError("not a wavelet shard")
        self.bits = int(np.frombuffer(image, "<u4", 1, 4)[0])
        self.n = int(np.frombuffer(image, "<u8", 1, 8)[0])
        blocks, at = -(-self.n // BLOCK), 16
        self._planes = []
        for _ in range(self.bits):
            zeros = int(np.frombuffer(image, "<u8", 1, at)[0])
            packed = np.frombuffer(image, np.uint8, blocks * (BLOCK // 8), at + 8)
            before = np.frombuffer(image, "<u4", blocks, at + 8 + len(packed))
            at += 8 + len(packed) + 4 * blocks
            self._planes.append((zeros, packed, before))

    def _ones(self, plane, i: int) -> int:
        """Ones among the first i bits."""
        if i <= 0:
            return 0
        _, packed, before = plane
        block = (i - 1) // BLOCK
        start, end = block * (BLOCK // 8), i // 8
        n = int(before[block]) + int(np.bitwise_count(packed[start:end]).sum())
        if i % 8:
            n += (int(packed[end]) & ((1 << (i % 8)) - 1)).bit_count()
        return n

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in self._planes:
            bit = (int(plane[1][i // 8]) >> (i % 8)) & 1
            ones = self._ones(plane, i)
            value = value << 1 | bit
            i = plane[0] + ones if bit else i - ones
        return value

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first i ids."""
        if token >> self.bits:
            return 0
        lo, hi = 0, min(i, self.n)
        for k, plane in enumerate(self._planes):
            one_lo, one_hi = self._ones(plane, lo), self._ones(plane, hi)
            if token >> (self.bits - 1 - k) & 1:
                lo, hi = plane[0] + one_lo, plane[0] + one_hi
            else:
                lo, hi = lo - one_lo, hi - one_hi
        return hi - lo

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.rank(token, self.n):
            raise IndexError(k)
        lo, hi = 0, self.n - 1  # the smallest i with rank(i + 1) > k
        while lo < hi:
            mid = (lo + hi) // 2
            if self.rank(token, mid + 1) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo

    def decode(self) -> np.ndarray:
        """All ids in order: undo the planes from the lowest bit up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        values = np.zeros(self.n, kind)
        for k in range(self.bits - 1, -1, -1):
            zeros, packed, _ = self._planes[k]
            one = np.unpackbits(packed, count=self.n, bitorder="little").view(bool)
            values[zeros:] |= kind(1 << (self.bits - 1 - k))
            out = np.empty(self.n, kind)
            out[np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])] = values
            values = out
        return values


_SHARD = pa.schema([("part", pa.int32()), ("shard", pa.int32()),
                    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())),
                    ("n_ids", pa.int64()), ("image", pa.binary())])
_SHARD_SQL = ("part int, shard int, doc_ids array<bigint>, lengths array<bigint>, "
              "n_ids bigint, image binary")


def write_token_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
                       key: str = "doc_id", text: str = "text") -> None:
    """Tokenise whole texts in ascending key order and write the shards.

    Each row of the Parquet table at ``path`` is one shard: its place
    (part, shard), the keys and lengths of its documents, and the image.
    Parquet is the container because Spark commits it safely on any store.
    Null text is empty (the end id alone); null keys come first; rows that
    repeat a key follow each other in text-hash order; other columns are
    not read; an empty table writes no shards.
    """
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        number, ids, keys, lengths, total = 0, [], [], [], 0

        def shard() -> pa.RecordBatch:
            image = build_image(np.frombuffer(b"".join(ids), enc.dtype))
            return pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(
                    ([part], [number], [keys], [lengths], [total], [image]), _SHARD)],
                schema=_SHARD)

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                got = enc.encode(t.as_py()) + end
                ids.append(got)
                keys.append(k)
                lengths.append(len(got) // width)
                total += lengths[-1]
                if total >= SHARD_IDS:
                    yield shard()
                    number, ids, keys, lengths, total = number + 1, [], [], [], 0
        if keys:
            yield shard()

    body = F.col(text).cast("string")
    ordered = (docs.select(F.col(key).cast("bigint").alias("k"), body.alias("t"),
                           F.xxhash64(body).alias("tie"))
               .repartitionByRange("k", "tie").sortWithinPartitions("k", "tie"))
    (ordered.select("k", "t").mapInArrow(shards, _SHARD_SQL)
     .write.option("compression", "zstd").parquet(path))


_DOC_SQL = "doc_id bigint, part int, shard int, within bigint, n_tokens bigint, ids binary"
_DOC = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("shard", pa.int32()),
                  ("within", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def read_token_shards(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, decoded from the shard images: doc_id, part,
    shard, within (its first id's place in the shard), n_tokens, ids
    (little-endian u32)."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, shard, keys, lengths, image in zip(*(c.to_pylist() for c in b.columns)):
                raw = WaveletMatrix(image).decode().astype("<u4").tobytes()
                ends = np.cumsum(np.asarray(lengths, np.int64))
                starts = ends - lengths
                for lo in range(0, len(keys), 512):  # batches of moderate size
                    hi = min(lo + 512, len(keys))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys[lo:hi], pa.int64()),
                        pa.array([part] * (hi - lo), pa.int32()),
                        pa.array([shard] * (hi - lo), pa.int32()),
                        pa.array(starts[lo:hi]), pa.array(lengths[lo:hi], pa.int64()),
                        pa.array([raw[4 * s:4 * e] for s, e in
                                  zip(starts[lo:hi], ends[lo:hi])], pa.binary())], schema=_DOC)

    table = spark.read.parquet(path)
    return table.select("part", "shard", "doc_ids", "lengths", "image").mapInArrow(
        decode, _DOC_SQL)


def shard_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, shard, first): ids before each shard in the whole corpus."""
    shards = spark.read.parquet(path).select("part", "shard", "n_ids")
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before_part = F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before_shard = F.coalesce(F.sum("n_ids").over(
        Window.partitionBy("part").orderBy("shard")
        .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (shards.join(parts.select("part", before_part.alias("base")), "part")
            .select("part", "shard", (F.col("base") + before_shard).alias("first")))


def op6_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenise all documents into shard images, read the images back."""
    path = scratch_path(spark, "token-shards")
    write_token_shards(documents(spark, sf_dir), path, public_tokenizer("word_bpe_49k.json"))
    rows = read_token_shards(spark, path).select(
        "doc_id", "part", "shard", "within", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return (rows.join(shard_starts(spark, path), ["part", "shard"])
            .select("doc_id", (F.col("first") + F.col("within")).alias("start"),
                    "n_tokens", "ids_crc32"))
