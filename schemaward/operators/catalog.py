"""Object discovery and existence checks against catalogue inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward.functions.text import add_note


def norm_object_type(c: Column) -> Column:
    """F10, from inventory: BASE TABLE is a TABLE, anything else keeps its name."""
    return F.when(c == "BASE TABLE", "TABLE").otherwise(c)


def inventory_type(c: Column) -> Column:
    """F10, towards inventory: VIEW looks for views, everything else for base tables."""
    return F.when(F.upper(c) == "VIEW", "VIEW").otherwise("BASE TABLE")


def discover(inventory: DataFrame, db: str = "%", schema: str = "%") -> DataFrame:
    """objects whose database and schema match case-insensitive LIKE patterns."""
    return inventory.where(F.col("db_name").ilike(db) & F.col("schema_name").ilike(schema)).select(
        "env", F.concat_ws(".", "db_name", "schema_name", "object_name").alias("fqdn"),
        "db_name", "schema_name", "object_name", norm_object_type(F.col("table_type")).alias("object_type"))


def split_fqdn(df: DataFrame) -> DataFrame:
    """database, schema and object name of a three-part name; others are dropped."""
    part = F.split("fqdn", r"\.")
    return df.where(F.size(part) == 3).select(
        "*", F.get(part, F.lit(0)).alias("db_name"), F.get(part, F.lit(1)).alias("schema_name"),
        F.get(part, F.lit(2)).alias("object_name"))


def object_counts(inventory: DataFrame) -> DataFrame:
    """A3: number of inventory rows per object, case-insensitive; combined before the shuffle."""
    return inventory.groupBy(
        "env", F.upper("db_name").alias("db_key"), F.upper("schema_name").alias("schema_key"),
        F.upper("object_name").alias("object_key"), inventory_type(F.col("table_type")).alias("type_key"),
    ).agg(F.count("*").alias("n"))


def check_existence(grid: DataFrame, inventory: DataFrame) -> DataFrame:
    """Adds obj_exists to (env, fqdn, object_type) rows; names compare case-insensitively.

    The inventory is counted per object first, so each grid row meets at most one row.
    """
    wanted = split_fqdn(grid).select(
        "*", F.upper("db_name").alias("db_key"), F.upper("schema_name").alias("schema_key"),
        F.upper("object_name").alias("object_key"), inventory_type(F.col("object_type")).alias("type_key"))
    keys = ["env", "db_key", "schema_key", "object_key", "type_key"]
    return (
        wanted.join(object_counts(inventory), keys, "left")
        .withColumn("obj_exists", F.coalesce(F.col("n") > 0, F.lit(False)))
        .drop("db_key", "schema_key", "object_key", "type_key", "n")
    )


def missing_objects(existence: DataFrame) -> DataFrame:
    """A8 with U2: objects absent from their environment, all environments in one list."""
    label = F.concat(F.col("fqdn"), F.lit(" ("), F.col("env"), F.lit(", "), F.col("object_type"), F.lit(")"))
    return existence.where(~F.col("obj_exists")).select("env", "fqdn", "object_type", label.alias("label")).distinct()


def absence_note(existence: DataFrame, note: Column) -> Column:
    """A note extended where the object is absent."""
    return add_note(note, F.when(~F.col("obj_exists"), F.concat(F.col("object_type"), F.lit(" does not exist."))))
