"""A set of 64-bit names as a bit table, to drop in a scan what a later join would drop."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS_PER_NAME = 32
LEAST_BITS, MOST_BITS = 1 << 15, 1 << 26
BLOCK = 1 << 15  # bits of one block of Spark's bitmap functions


class BitTable:
    """Bits set for the low part of each name, eight to a byte.

    At most MOST_BITS / BLOCK rows of 4 KB (8 MB) reach the driver, however many names
    there are. A full table lets everything through: more work, the same result.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    @classmethod
    def of(cls, names: DataFrame, column: str) -> BitTable:
        count = names.count()
        size = LEAST_BITS
        while size < min(MOST_BITS, BITS_PER_NAME * count):
            size *= 2
        slot = names.select((F.col(column).bitwiseAND(F.lit(size - 1)) + 1).alias("s"))
        blocks = slot.groupBy(F.bitmap_bucket_number("s").alias("block")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("bits")
        )
        table = np.zeros(size // 8, np.uint8)
        for row in blocks.collect():
            at = (row["block"] - 1) * (BLOCK // 8)
            table[at : at + BLOCK // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
        return cls(table)

    def holds(self, names: np.ndarray) -> np.ndarray:
        """False only for names that are not in the set."""
        slot = names.astype(np.int64, copy=False) & (len(self.bits) * 8 - 1)
        return (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
