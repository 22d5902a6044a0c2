"""Sorted listings of any length, as arrays of bounded size.

A report wants the sorted set of items of a group. A group may hold most rows, so
neither one task nor one cell may hold its list. Ranks come from a range shuffle:
rows are cut into ranges of (group, item), so a large group lies in many of them,
and the place of an item is its place in its range plus the counts of the ranges
before. The ranges are written before they are counted, so a recomputed task can't
cut them otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from schemaward.session import shared_dir

PART_ITEMS = 1000


def sorted_parts(df: DataFrame, by: list[str], item: str, items: int = PART_ITEMS, ranges: int | None = None) -> DataFrame:
    """Rows (by, part, total, items): the distinct items of a group in order, at most ``items`` in an array.

    Parts count from 0; joined in their order they are the sorted set. ``total`` is the number of items of the group.
    Null items are left out, a null group is a group. ``ranges`` sets the number of ranges, else the session does.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession)
    rows = df.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate(by)], F.col(item).alias("_item")).where("_item is not null").distinct()
    group = [f"_g{i}" for i in range(len(by))]
    order = [*group, "_item"]
    cut = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    cut.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    cut = spark.read.parquet(path)
    # one row per range and group in it: no more than ranges plus groups
    counts = cut.groupBy(*group, "_range").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(*group)
    counts = counts.select(
        *[F.col(g).alias(f"_c{g}") for g in group], F.col("_range").alias("_crange"), F.sum("_n").over(whole).alias("total"),
        F.coalesce(F.sum("_n").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range", *group).orderBy("_item"))
    same = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_c{g}")) for g in group], F.col("_range") == F.col("_crange"))
    ranked = cut.withColumn("_place", place).join(counts, same)
    part = F.floor((F.col("_before") + F.col("_place") - 1) / items).cast("long")
    return ranked.groupBy(*[F.col(g).alias(c) for g, c in zip(group, by)], part.alias("part"), "total").agg(
        F.array_sort(F.collect_list("_item")).alias("items")).select(*by, "part", "total", "items")
