"""A map of fixed size that tells which keys cannot be in a set.

It spares rows a shuffle; whether a key really is in the set is for a join to say.
"""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the map; it takes 2 MB whatever the number of keys.
MAP_BITS = 1 << 24


def bit_map(keys: DataFrame, column: str) -> np.ndarray:
    """Words of 64 bits; the bit of every key of the bigint column is set."""
    place = F.pmod(F.col(column), F.lit(MAP_BITS)).alias("place")
    words = (
        keys.select(place)
        .groupBy(F.expr("CAST(place div 64 AS int)").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS int)))").alias("bits")).collect()
    )
    out = np.zeros(MAP_BITS // 64, np.int64)
    for word, bits in words:
        out[word] = bits
    return out


def may_have(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    place = np.mod(keys, MAP_BITS)
    return (bits[place // 64] >> (place % 64) & 1).astype(bool)
