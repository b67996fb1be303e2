"""Hierarchical multi-length packing.

A document's whole long windows leave at once; its rest is routed to the
smallest context tier that holds it. From the longest tier down, the
largest rest opens a window and the gap is filled with the largest rests of
that and the shorter tiers that fit; what is still open is closed with a
cut from the shortest rest. Windows of a tier are dealt to step groups of
equal token budget so that attention cost is even.

Every task packs the documents it reads, in groups of bounded size, and
carries what does not fill a window on to the next group: no shuffle, and
at most one padded window a task.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, hand_back
from ledgerlake.llm.tokens import encoder, public_tokenizer

TIERS = (256, 512, 1024, 2048)
END_ID = 1
# Tokens of a step group: 32 long windows or as many shorter ones.
STEP_TOKENS = 32 * 2048
# Ids a task gathers before it packs a group.
GROUP_IDS = 1 << 21

# A piece is (length, document number in the group, start).
Piece = tuple[int, int, int]


class _Pool:
    """Rests by tier, each tier sorted by length."""

    def __init__(self, tiers: Sequence[int]):
        self.tiers = tiers
        self.rests: list[list[Piece]] = [[] for _ in tiers]
        self.total = 0

    def add(self, piece: Piece) -> None:
        tier = next(k for k, t in enumerate(self.tiers) if piece[0] <= t)
        insort(self.rests[tier], piece)
        self.total += piece[0]

    def largest(self, at_most: int) -> Piece | None:
        for rests in reversed(self.rests):
            k = bisect_right(rests, (at_most, 1 << 62, 0))
            if k:
                piece = rests.pop(k - 1)
                self.total -= piece[0]
                return piece
        return None

    def smallest(self) -> Piece:
        piece = next(r for r in self.rests if r).pop(0)
        self.total -= piece[0]
        return piece


def pack_rests(pool: _Pool, last: bool) -> list[tuple[int, list[Piece]]]:
    """(tier, pieces) for every window the pool can fill; with ``last``
    the final ids go to the tiers they fill and one padded window."""
    windows = []
    for tier in reversed(pool.tiers):
        # A tier opens windows for its own rests; only the shortest tier
        # and the last call take whatever is left.
        k = pool.tiers.index(tier)
        while pool.total >= tier and (pool.rests[k] or (last and pool.total >= tier)):
            gap, window = tier, []
            while gap:
                piece = pool.largest(gap)
                if piece is None:  # every rest is longer: cut the shortest
                    n, doc, start = pool.smallest()
                    piece = (gap, doc, start)
                    pool.add((n - gap, doc, start + gap))
                window.append(piece)
                gap -= piece[0]
            windows.append((tier, window))
    if last and pool.total:
        window = []
        while pool.total:
            window.append(pool.smallest())
        windows.append((pool.tiers[-1], window))
    return windows


def step_groups(windows: list[tuple[int, list[Piece]]], step_tokens: int) -> list[int]:
    """Step number of each window: a step holds windows of one tier worth
    ``step_tokens``; windows are dealt to their tier's steps back and forth
    by falling attention cost (sum of squared piece lengths)."""
    out, first = [0] * len(windows), 0
    for tier in sorted({t for t, _ in windows}, reverse=True):
        mine = [k for k, (t, _) in enumerate(windows) if t == tier]
        mine.sort(key=lambda k: -sum(p[0] ** 2 for p in windows[k][1]))
        steps = -(-len(mine) // max(1, step_tokens // tier))
        for rank, k in enumerate(mine):
            turn, place = divmod(rank, steps)
            out[k] = first + (place if turn % 2 == 0 else steps - 1 - place)
        first += steps
    return out


_SQL = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
        "offset bigint, tier int, step_group bigint, ids binary")
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
                    ("offset", pa.int64()), ("tier", pa.int32()), ("step_group", pa.int64()),
                    ("ids", pa.binary())])


def pack_documents(docs: DataFrame, tokenizer: str, tiers: Sequence[int] = TIERS,
                   end_id: int = END_ID, step_tokens: int = STEP_TOKENS,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id,
    offset, tier, step_group, ids (little-endian u32).

    A sequence is filled to its tier exactly; only a task's last one may
    need padding (to the longest tier). sequence_id and step_group carry
    the task's number in their upper bits. Null text has the end id alone;
    null keys, repeated rows and very long texts are packed like all
    others; other columns are not read; no rows give no pieces.
    """
    tiers = tuple(sorted(tiers))
    longest = tiers[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base = TaskContext.get().partitionId() << 40
        hand_back()
        enc = encoder(tokenizer)
        end = np.array([end_id], enc.dtype).tobytes()
        width = enc.dtype.itemsize
        docs_now: dict[int, tuple] = {}  # number -> (key, ids, tokens)
        pool, number, gathered, sequence, step = _Pool(tiers), 0, 0, 0, 0
        full: list[tuple[int, list[Piece]]] = []

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, step, docs_now, gathered, full
            windows = full + pack_rests(pool, last)
            full = []
            groups = step_groups(windows, step_tokens)
            columns: list[list] = [[] for _ in _ARROW]

            def ready() -> pa.RecordBatch:
                out = pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)
                for c in columns:
                    c.clear()
                return out

            for (tier, window), group in zip(windows, groups):
                offset = 0
                for n, doc, start in window:
                    k, ids, tokens = docs_now[doc]
                    part = np.frombuffer(ids, enc.dtype, n, start * width).astype("<u4")
                    for c, v in zip(columns, (k, start, n, tokens, base + sequence, offset,
                                              tier, base + step + group, part.tobytes())):
                        c.append(v)
                    offset += n
                sequence += 1
                if len(columns[0]) >= 1024:
                    yield ready()
            if columns[0]:
                yield ready()
            step += max(groups, default=-1) + 1
            carried = {p[1] for rests in pool.rests for p in rests}
            docs_now = {d: v for d, v in docs_now.items() if d in carried}
            gathered = 0

        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), b.column(1)):
                ids = enc.encode(t.as_py()) + end
                tokens = len(ids) // width
                docs_now[number] = (k, ids, tokens)
                whole = tokens // longest
                full += [(longest, [(longest, number, w * longest)]) for w in range(whole)]
                if tokens % longest:
                    pool.add((tokens % longest, number, whole * longest))
                number += 1
                gathered += tokens
                if gathered >= GROUP_IDS:
                    yield from flush(False)
        yield from flush(True)

    return docs.select(F.col(key).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, _SQL)


def op9_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(documents(spark, sf_dir))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The packed pieces with a checksum of their ids."""
    pieces = pack_documents(docs, public_tokenizer("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "tier", "step_group")
