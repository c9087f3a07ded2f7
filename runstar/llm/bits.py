"""A bit table of fixed size over 64-bit keys: says for sure which keys are not in a set."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a table: 16 MB, whatever the set. Where that is too little, more keys seem to be in it.
SIZE = 1 << 27


def bit_table(keys: DataFrame, column: str) -> np.ndarray:
    """The table of a column of spread 64-bit keys, put together by Spark: what comes to the driver is at most the table."""
    slot = f"(`{column}` & {SIZE - 1})"
    words = keys.select(F.expr(f"shiftright({slot}, 6)").alias("word"), F.expr(
        f"shiftleft(1L, int({slot} & 63))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(SIZE // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out


def maybe_in(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the set."""
    slot = keys.view(np.uint64) & np.uint64(SIZE - 1)
    return (table[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
