"""A filter of bounded size over 64-bit names: which rows may be wanted, known in every task without a join."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS = 16, 26  # 8 KB to 8 MB


class Marks:
    """Slots of names that are wanted. Others may share a slot, never the other way round: what passes is joined exactly."""

    def __init__(self, wanted: DataFrame):
        """``wanted``: one column of longs. Sixteen slots a name, so one in sixteen others passes, up to MOST_BITS."""
        name = wanted.columns[0]
        count = max(1, wanted.count())
        self.bits = min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))
        slots = wanted.select(F.col(name).bitwiseAND((1 << self.bits) - 1).alias("slot"))
        bits = slots.select((F.col("slot") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, int(slot % 64))").alias("bit"))
        filled = bits.groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow()  # at most 2**20 rows, whatever the input
        self.words = np.zeros(1 << (self.bits - 6), np.uint64)
        self.words[filled.column("word").to_numpy()] = filled.column("bits").to_numpy().view(np.uint64)

    def __contains__(self, name: int) -> bool:
        return bool(self.among(np.array([name], np.int64))[0])

    def among(self, names: np.ndarray) -> np.ndarray:
        slot = names.view(np.uint64) & np.uint64((1 << self.bits) - 1)
        return (self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)
