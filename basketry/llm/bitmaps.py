"""Sets of small numbers as bitmaps of fixed size, built by Spark's bitmap aggregates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BYTES = 4096  # of one of Spark's bitmaps


def bitmap_of(places: DataFrame, bits: int) -> np.ndarray:
    """Packed bits of the numbers 0 to 2**bits - 1 that the column ``place`` holds.

    Tasks send partial bitmaps, so what reaches the driver is 2**bits / 8 bytes at most,
    whatever the number of rows.
    """
    one = (F.col("place") + 1).alias("one")
    found = places.select(one).groupBy(F.bitmap_bucket_number("one").alias("bucket"))
    rows = found.agg(F.bitmap_construct_agg(F.bitmap_bit_position("one")).alias("bits")).collect()
    out = np.zeros(-(-(1 << bits) // (8 * _BYTES)) * _BYTES, np.uint8)
    for r in rows:
        start = (r["bucket"] - 1) * _BYTES
        out[start : start + _BYTES] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def holds(bitmap: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Whether each number is in the set."""
    return (bitmap[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
