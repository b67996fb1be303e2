"""Fixed-size bitmaps of a column's hashes.

A bitmap tells which values may be needed before they are shuffled. Its
size is a constant, so it can always be broadcast; the more values there
are, the more others pass with them. It never rejects a value it holds, and
what passes is joined exactly afterwards.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 2^26 bits: 8 MB, in 2048 pieces of 32768 bits.
BITS = 26


def broadcast_bitmap(rows: DataFrame, column: Column) -> Broadcast:
    """Broadcast uint8 array with the bit of every value of a long column."""
    # Spark numbers bitmap positions from 1.
    place = column.bitwiseAND(F.lit((1 << BITS) - 1)) + 1
    pieces = rows.select(place.alias("p")).groupBy(
        F.bitmap_bucket_number("p").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bitmap = np.zeros(1 << (BITS - 3), np.uint8)
    for piece, bits in pieces.collect():  # at most 2048 rows of 4 KB
        raw = np.frombuffer(bits, np.uint8)
        at = (piece - 1) * 4096
        bitmap[at:at + len(raw)] = raw
    return rows.sparkSession.sparkContext.broadcast(bitmap)


def in_bitmap(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which uint64 values have their bit set."""
    p = values & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[(p >> np.uint64(3)).astype(np.int64)]
            >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
