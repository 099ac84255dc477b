"""A bitmap of fixed size over hashes: which rows may belong to a set.

Rows let through by mistake are dropped by the exact join that follows, so a bitmap that fills
up costs work and never changes a result. Its size does not grow with the data.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 23  # 1 MB


def bitmap(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The bitmap of a column of 64-bit hashes: 2**bits bits in 64-bit words."""
    place = F.col(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        hashes.select(
            F.shiftright(place, 6).alias("word"),
            F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))").alias("bit"),
        )
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bit"))
        .toArrow()  # at most 2**(bits - 6) rows
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bit"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def held(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes may be in the set."""
    place = hashes.astype(np.int64).view(np.uint64) & np.uint64(64 * len(words) - 1)
    return (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
