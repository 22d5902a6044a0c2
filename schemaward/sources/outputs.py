"""Writers. State and reports go to a new path per run; a path being read is never overwritten."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.functions.text import clean_strings, file_key


def write_report(df: DataFrame, path: str) -> None:
    """S3: hit/miss report as JSON with cleaned texts; titles stay as given, they are the key."""
    typed = df.select(*[F.col(f.name).cast(f.dataType) for f in S.REPORT.fields])
    clean_strings(typed, skip=("given_title", "found_title")).write.mode("overwrite").json(path)


def write_state(df: DataFrame, name: str, path: str) -> None:
    """A state table, columns in schema order."""
    df.select(*S.state_schema(name).names).write.mode("errorifexists").parquet(path)


def write_tables_json(pages: DataFrame, path: str, buckets: int = 256) -> None:
    """Parsed pages as JSON lines with their sanitised table name, in at most ``buckets`` folders by that name.

    One folder per table would be one per page, all of which the driver lists at the commit. A bucket is written by as
    many tasks as its pages need, spread by name and page.
    ``pages``: page_id and ``page`` from ``parsed_pages``.
    """
    name = F.coalesce(F.nullif("page.metadata.table_name", F.lit("")), F.lit("untitled_table"))
    keyed = pages.withColumn("file_key", file_key(name)).withColumn("bucket", F.pmod(F.xxhash64("file_key"), F.lit(buckets)))
    keyed.repartition("bucket", F.pmod(F.xxhash64("page_id"), F.lit(16))).write.mode("overwrite").partitionBy("bucket").json(path)
