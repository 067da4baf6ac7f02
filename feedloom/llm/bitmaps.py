"""Bitmaps of fixed size over 64-bit hashes: a cheap first look before an exact join.

A place that is not set belongs to no hash; one that is set may belong to any, so
what passes goes on to the join. The more hashes, the less a bitmap spares; its size
and the results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 24


def gather(hashes: DataFrame) -> np.ndarray:
    """The places of the column ``hash`` as bytes; at most ``2 ** BITS / 64`` rows are gathered."""
    place = f"shiftrightunsigned(hash, {64 - BITS})"
    found = (
        hashes.selectExpr(f"shiftright({place}, 6) AS word", f"shiftleft(1L, cast({place} & 63 AS int)) AS bit")
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (BITS - 6), np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint8)


def held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes lie on a place that is set."""
    place = hashes >> np.uint64(64 - BITS)
    byte = bitmap[(place >> np.uint64(3)).astype(np.int64)]
    return (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
