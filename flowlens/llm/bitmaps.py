"""Fixed-size bitmaps over 64-bit codes, built in Spark: a bounded broadcast that skips work.

A code is "in" a bitmap when both of its two bits are set.  No code that was put
in is missed; others pass by chance, so a caller must stay right when they do.
The size is ``2 ** bits`` bits whatever the data: with more codes fewer rows are
skipped, and the parameter can be raised.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlens.llm.workspace import by_value, release, small_batches

BITS = 26   # 8 MB


def _places(code: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    code = code.astype(np.uint64, copy=False)
    return code & low, (code >> np.uint64(64 - bits)) & low


def build(df: DataFrame, code: str | Column, bits: int = BITS) -> np.ndarray:
    """Bitmap of a long column, merged per 64-bit word before it is collected."""
    value = F.col(code) if isinstance(code, str) else code
    low = F.lit((1 << bits) - 1)
    place = F.explode(F.array(value.bitwiseAND(low), F.shiftrightunsigned(value, 64 - bits)))
    merged = (df.select(place.alias("place"))
              .groupBy(F.shiftright("place", 6).alias("word"))
              .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits")))
    with small_batches(df.sparkSession):
        words = merged.toArrow()
    del merged
    release(df.sparkSession)   # the shuffles behind the counted codes are no longer needed
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def holds(bitmap: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Whether each code is (or passes as) a member."""
    bits = int(len(bitmap)).bit_length() - 1 + 6
    one, six, low = np.uint64(1), np.uint64(6), np.uint64(63)
    a, b = _places(code, bits)
    found = (bitmap[a >> six] >> (a & low)) & one == one
    found[found] = (bitmap[b[found] >> six] >> (b[found] & low)) & one == one
    return found


by_value(__name__)
