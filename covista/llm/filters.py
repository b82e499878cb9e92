"""Filters of a fixed size for pruning: what is in the set always passes, a little else may too.

A filter is a bit array whose size is a parameter and not that of the data, so it may be sent to every task.
With many more members than bits it passes more and prunes less; results never depend on it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# bits of one piece, as made by Spark's bitmap functions
PIECE = 32768


def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each 64-bit hash in a filter of 2**bits bits."""
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


def place_columns(hashed: Column, bits: int) -> Column:
    """The same two bits, of a long."""
    mask = F.lit((1 << bits) - 1)
    return F.array(hashed.bitwiseAND(mask), F.shiftrightunsigned(hashed, 32).bitwiseAND(mask))


def built(rows: DataFrame, hashed: str, bits: int = 26) -> np.ndarray:
    """The filter of a column of 64-bit hashes, as bytes. At most 2**bits / 8 bytes reach the driver."""
    if not 15 <= bits <= 31:
        raise ValueError("a filter has 2**15 to 2**31 bits")
    pieces = (rows.select(F.explode(place_columns(F.col(hashed), bits)).alias("at"))
              .groupBy(F.floor(F.col("at") / PIECE).cast("int").alias("piece"))
              .agg(F.bitmap_construct_agg(F.pmod("at", F.lit(PIECE))).alias("bits")))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in pieces.collect():
        at = row["piece"] * (PIECE // 8)
        out[at:at + PIECE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def passes(filter_bytes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes may be in the set."""
    bits = (len(filter_bytes) * 8).bit_length() - 1
    one, two = places(hashes, bits)
    return ((filter_bytes[one >> 3] >> (one & 7).astype(np.uint8)) & (filter_bytes[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)
