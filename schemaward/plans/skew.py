"""Time blocks: ordered per-key computations that survive hot keys.

A window over a key runs in one task per key. Keys with more than ``hot_rows``
rows are therefore cut into time blocks; each block is computed on its own, and
what a block needs from its predecessors travels as one summary row per block.
Blocks are cut again while they hold too many rows, so a key whose rows fall into
one short burst is split as well as one with even rows. Ordinary keys are a
single block. The cuts come from exact counts and extremes and reach the plan as
constants, so a recomputed stage (lost executor) cuts the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 2_000_000
MAX_HOT_KEYS = 100_000
MAX_LEVELS = 16
BLOCK = "_block"
HOT = "_hot"


def time_blocks(df: DataFrame, keys: list[str], ts: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Adds a block number per row, 0 for ordinary keys and growing with time for hot ones, and a hot flag.

    A key, and later a block, is hot above ``hot_rows`` rows, or above 1/MAX_HOT_KEYS of
    all rows where that is more. So there are never more than MAX_HOT_KEYS of them at a
    level, however large the input, and their cuts may be broadcast instead of shuffling
    the rows. A level reads keys and times only, from the second on of hot keys alone; without hot keys there is one. Rows of
    one key at one time stay together.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    spark = df.sparkSession
    rows = df.withColumn(HOT, F.lit(False)).withColumn(BLOCK, F.lit(0).cast("long"))
    by = [*keys, BLOCK]
    shape = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], T.StructField(BLOCK, T.LongType())]
                         + [T.StructField(c, T.LongType()) for c in ("_n", "_lo", "_hi")])
    share = None
    for _ in range(MAX_LEVELS):
        # only what was cut at the level before can still be too large
        counted = rows if share is None else rows.where(HOT)
        sizes = counted.groupBy(*by).agg(F.count("*").alias("_n"), F.min(micros).alias("_lo"), F.max(micros).alias("_hi"))
        if share is None:
            top = sizes.agg(F.sum("_n"), F.max("_n")).first()
            share = (top[0] or 0) / MAX_HOT_KEYS
            if (top[1] or 0) <= max(float(hot_rows), share):
                break
        found = sizes.where((F.col("_n") > max(float(hot_rows), share)) & (F.col("_hi") > F.col("_lo"))).collect()
        if not found:
            break
        hot = spark.createDataFrame(found, shape).withColumn("_cuts", 4 * F.ceil(F.col("_n") / hot_rows)).drop("_n")
        span = F.col("_hi") - F.col("_lo") + 1
        at = F.floor((micros - F.col("_lo")).cast("double") * F.col("_cuts") / span)
        # a block is named by the time it begins at, so names keep the order at every level
        begin = F.col("_lo") + F.floor(at.cast("double") * span / F.col("_cuts"))
        rows = (rows.join(F.broadcast(hot), by, "left")
                .withColumn(HOT, F.col(HOT) | F.col("_cuts").isNotNull())
                .withColumn(BLOCK, F.when(F.col("_cuts").isNotNull(), begin).otherwise(F.col(BLOCK)).cast("long"))
                .drop("_lo", "_hi", "_cuts"))
    return rows
