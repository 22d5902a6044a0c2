"""Connected components of a link table by rounds of joins, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaward.llm.batches import store


def smallest_reachable(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the smallest node that it reaches.

    Large-star and small-star rounds: in the first every node hands its larger neighbours to its smallest one, in the
    second its smaller ones. The link count never grows, and a node of any degree costs one aggregation and one join
    on that node, which the adaptive join may split. It ends when a round changes nothing.
    """
    edges = store(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
            low.select("a", F.col("m").alias("b")))
        edges = store(small.where("a <> b").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionAll(edges.select("b", "b")).distinct()
