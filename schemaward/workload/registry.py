"""Registry of queries: name -> (Spark callable, comparison SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from schemaward.workload.inputs import duck_sql, frame

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Context:
    """What a query sees: the session, the data folder and its inputs by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name, self._made)

    def dealt(self, name: str) -> DataFrame:
        """An input in as many even parts as a shuffle has, for costly work on each row.

        A small file is one task, and the adaptive planner leaves as few as bytes ask for, however long a row takes.
        """
        return self[name].repartition(int(self.spark.conf.get("spark.sql.shuffle.partitions")))


def query(sql: str | None = None, name: str | None = None):
    """Registers a function of a Context under its own name, with comparison SQL over @inputs."""
    def register(fn: Callable[[Context], DataFrame]):
        key = name or fn.__name__
        QUERIES[key] = lambda spark, sf_dir: fn(Context(spark, sf_dir))
        if sql:
            ORACLES[key] = duck_sql(sql)
        return fn
    return register
