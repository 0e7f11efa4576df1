"""Filters of a set of 64-bit hashes: two bits each, in an array of a fixed limit."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

# At most 32 MB, whatever the number of hashes; beyond it more hashes pass that are not in the set.
MOST_BITS = 1 << 28
_LEAST_BITS = 1 << 10


@dataclass(frozen=True)
class HashFilter:
    """Holds every hash of the set, and some others."""

    bits: np.ndarray

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        mask = np.uint64(len(self.bits) * 64 - 1)
        found = np.ones(len(hashes), bool)
        for place in (hashes & mask, (hashes >> np.uint64(32)) & mask):
            found &= (self.bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
        return found


def hash_filter(hashes: DataFrame, column: str) -> HashFilter:
    """The filter of a column of hashes. Spark sets the bits, 16 for each hash up to the limit; the driver gets the array."""
    wanted, size = 16 * hashes.count(), _LEAST_BITS
    while size < wanted and size < MOST_BITS:
        size *= 2
    places = f"explode(array(`{column}` & {size - 1}L, shiftrightunsigned(`{column}`, 32) & {size - 1}L)) AS place"
    slots = hashes.selectExpr(places).groupBy(F.expr("CAST(shiftright(place, 6) AS INT) AS slot"))
    found = slots.agg(F.expr("bit_or(shiftleft(1L, CAST(place & 63 AS INT))) AS bits")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return HashFilter(bits)
