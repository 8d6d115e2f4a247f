"""Bitmaps that tell which hashes may be in a set.

The number of bits follows the size of the set, between two bounds, so a bitmap may be
sent to every task; what passes it is still joined exactly afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the least and the most bits: 8 KB to 32 MB.
LEAST_BITS, MOST_BITS = 16, 28
#: Bits for every member, below the upper bound.
BITS_EACH = 16


@dataclass
class Bitmap:
    """Bits of a set of 64-bit hashes."""

    bits: int
    words: np.ndarray

    @staticmethod
    def gather(hashes: DataFrame, column: str = "h", size: int | None = None) -> Bitmap:
        """Bitmap of the 64-bit integers in ``column``, about ``size`` of them (counted if not given); at most
        2^MOST_BITS / 64 rows reach the driver."""
        if size is None:
            size = int(hashes.agg(F.approx_count_distinct(column).alias("n")).first()[0])
        bits = min(MOST_BITS, max(LEAST_BITS, (BITS_EACH * size).bit_length()))
        at = F.pmod(F.col(column), F.lit(1 << bits))
        words = hashes.groupBy(F.shiftright(at, 6).cast("int").alias("w")).agg(
            F.bit_or(F.expr(f"shiftleft(1L, cast(pmod({column}, 64) as int))")).alias("bits")
        )
        out = np.zeros((1 << bits) // 64, np.int64)
        table = words.toArrow()
        out[np.asarray(table.column("w"))] = np.asarray(table.column("bits"))
        return Bitmap(bits, out.view(np.uint64))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each unsigned 64-bit hash may be in the set."""
        at = hashes & np.uint64((1 << self.bits) - 1)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


@lru_cache(maxsize=1 << 16)
def word_hash(word: str) -> int:
    """Stable unsigned 64-bit hash of a word."""
    import xxhash

    return xxhash.xxh64_intdigest(word)
