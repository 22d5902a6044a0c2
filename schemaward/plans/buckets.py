"""State tables in numbered buckets: a run reads and writes only the buckets that it changes.

A state is a folder with data and a list of which data is valid. Rows go to buckets by
a hash of some key columns; each run writes its buckets to a folder of their own and
then adds one row per bucket to the list, in one file. Readers take the newest row of
every bucket, so a run that fails before its list is written has changed nothing. One
run at a time may change a state.

Buckets are sized by their number, which is chosen once: keys are unique in a state,
so a bucket holds about its share of the rows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LIST = "run long, bucket int, path string, buckets int, by array<string>, schema string"


class BucketedState:
    """A state table under ``root``; see ``create`` for a new one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._refresh()

    @classmethod
    def create(cls, state: DataFrame, root: str, by: list[str], buckets: int) -> "BucketedState":
        """Writes ``state`` into ``buckets`` buckets by the columns ``by``, which must be part of its key."""
        self = cls.__new__(cls)
        self.spark, self.root = state.sparkSession, root.rstrip("/")
        self.buckets, self.by, self.schema, self.run, self._paths = buckets, list(by), state.schema, -1, {}
        self._write(state, list(range(buckets)))
        return self

    def _refresh(self) -> None:
        """The valid files: at most one path per bucket."""
        rows = self.spark.read.schema(_LIST).parquet(f"{self.root}/list").groupBy("bucket").agg(
            F.max_by(F.struct("path", "buckets", "by", "schema"), "run").alias("s"), F.max("run").alias("run")).collect()
        newest = max(rows, key=lambda r: r.run)
        self.run, self.buckets, self.by = newest.run, newest.s.buckets, list(newest.s.by)
        self.schema = T.StructType.fromJson(json.loads(newest.s.schema))
        self._paths = {r.bucket: r.s.path for r in rows if r.s.path}

    def bucket(self) -> Column:
        """Number of the bucket of a row; columns are compared as the state's types."""
        return F.pmod(F.xxhash64(*[F.col(c).cast(self.schema[c].dataType) for c in self.by]), F.lit(self.buckets)).cast("int")

    def read(self, only: list[int] | None = None) -> DataFrame:
        """The state, or some of its buckets."""
        paths = [p for b, p in sorted(self._paths.items()) if only is None or b in set(only)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.root}/{p}" for p in paths])

    def touched(self, changes: DataFrame) -> list[int]:
        """Buckets that hold keys of ``changes``; no more numbers than there are buckets."""
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())

    def update(self, changes: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Replaces the buckets that hold keys of ``changes`` by ``merge(their rows, changes)``; returns their numbers.

        ``merge`` must give the rows of other keys back unchanged. The changes are read twice: once for their buckets.
        """
        numbers = self.touched(changes)
        if numbers:
            self._write(merge(self.read(numbers), changes), numbers)
        return numbers

    def _write(self, rows: DataFrame, numbers: list[int]) -> None:
        name, schema = f"data/{uuid.uuid4().hex}", self.schema
        placed = rows.select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in schema.names]).withColumn("_bucket", self.bucket())
        placed.repartition(max(1, len(numbers)), "_bucket").write.partitionBy("_bucket").parquet(f"{self.root}/{name}")
        where = T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])
        found = {r[0] for r in self.spark.read.schema(where).parquet(f"{self.root}/{name}").select("_bucket").distinct().collect()}
        strays = found - set(numbers)
        if strays:
            raise ValueError(f"the merge made rows of buckets that it was not given: {sorted(strays)[:5]}")
        listed = [(self.run + 1, b, f"{name}/_bucket={b}" if b in found else None, self.buckets, self.by, schema.json()) for b in numbers]
        # all rows of a run are one file, which the committer shows at once
        self.spark.createDataFrame(listed, _LIST).coalesce(1).write.mode("append").parquet(f"{self.root}/list")
        self._refresh()
