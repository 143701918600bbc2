"""A bitmap of bounded size that tells which rows cannot be among the wanted ones.

It lets a job read a table once more without shuffling all of it: rows that are
surely not wanted stop at the scan, and an exact join decides on the others.
Its size doesn't depend on the data; with far more wanted rows than bits it
passes everything, and the join alone decides.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap (2 MB).
BITS = 1 << 24


class Membership:
    """Bits of the wanted 64-bit hashes."""

    def __init__(self, words: np.ndarray):
        self.words = words

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        """False where a hash is surely not a wanted one."""
        spot = hashes.view(np.uint64) & np.uint64(len(self.words) * 64 - 1)
        return (self.words[spot >> np.uint64(6)] >> (spot & np.uint64(63))) & np.uint64(1) == 1


def membership(hashes: DataFrame, bits: int = BITS) -> Membership:
    """The bitmap of a frame with one column of 64-bit hashes; at most ``bits / 64`` rows reach the driver."""
    spot = F.col(hashes.columns[0]).bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), spot.bitwiseAND(F.lit(63)).cast("int"))
    parts = hashes.select(F.shiftright(spot, 6).alias("w"), one.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(bits // 64, np.uint64)
    words[parts.column("w").to_numpy()] = parts.column("b").to_numpy().view(np.uint64)
    return Membership(words)
