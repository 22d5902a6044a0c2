"""Readers for the JSON inputs and the catalogue tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from schemaward import schemas as S


_BLANKS = " \t\r\n"  # what may stand before a JSON document


def _documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per file: (path, value). Files are configuration documents; a folder may hold any number."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("path"), "value")


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """JSON arrays of titles to (path, ord, given_title); documents that are no list are faults, see ``document_faults``."""
    titles = F.from_json("value", "array<string>")
    docs = _documents(spark, path).where(F.ltrim("value", F.lit(_BLANKS)).startswith("["))
    return docs.select("path", F.posexplode(titles).alias("ord", "given_title"))


def read_report(spark: SparkSession, path: str, document: bool = False) -> DataFrame:
    """hit/miss report; broken or missing entries read as none.

    Entries are one JSON object per line, which splits; ``document`` reads a
    hand-edited report that is one JSON array over many lines.
    """
    reader = spark.read.schema(S.REPORT).option("multiLine", document).option("mode", "PERMISSIVE")
    return reader.json(path).where(F.col("given_title").isNotNull())


def read_resolver_raw(spark: SparkSession, path: str) -> DataFrame:
    """Resolver documents to raw entries (path, entry_ord, entry_key, entry_json).

    Entries keep their order, exact duplicates of a key keep both rows, and an entry that is a JSON string keeps its
    quotes, so that a string is never taken for the object it may spell. See ``document_faults`` for broken documents.
    """
    texts = F.map_entries(F.from_json("value", "map<string,string>"))
    kinds = F.map_entries(F.from_json("value", "map<string,variant>"))
    string = F.schema_of_variant("e.kind.value") == "STRING"
    pairs = F.arrays_zip(texts.alias("entry"), kinds.alias("kind"))
    return _documents(spark, path).select("path", F.posexplode(pairs).alias("entry_ord", "e")).select(
        "path", "entry_ord", F.col("e.entry.key").alias("entry_key"),
        F.when(string, F.expr("substr(to_json(array(e.entry.value)), 2, length(to_json(array(e.entry.value))) - 2)")).otherwise(F.col("e.entry.value")).alias("entry_json"))


def document_faults(spark: SparkSession, path: str, kind: str = "object") -> DataFrame:
    """Documents that cannot be used at all, as (path, reason): not JSON, or no ``kind`` ("object" or "list")."""
    value = F.try_parse_json("value")
    wanted = F.startswith(F.ltrim("value", F.lit(_BLANKS)), F.lit("{" if kind == "object" else "["))
    reason = F.when(value.isNull(), "not JSON").when(~wanted, f"not a JSON {kind}")
    return _documents(spark, path).select("path", reason.alias("reason")).where("reason is not null")


def read_type_map_raw(spark: SparkSession, path: str) -> DataFrame:
    """S5, unvalidated: (path, entry_ord, map_key, map_value) as written."""
    entries = F.map_entries(F.from_json("value", "map<string,string>"))
    return _documents(spark, path).select("path", F.posexplode(entries).alias("entry_ord", "e")).select(
        "path", "entry_ord", F.col("e.key").alias("map_key"), F.col("e.value").alias("map_value"))


def read_type_map(spark: SparkSession, path: str) -> DataFrame:
    """(declared_type, warehouse_type), keys upper-cased, blank values dropped."""
    return type_map_from_raw(read_type_map_raw(spark, path))


def type_map_from_raw(raw: DataFrame) -> DataFrame:
    """Upper-case keys, one row each: of colliding keys the last one written, as far as ``raw`` says where it stands.

    Blank values are reported by the validation, not used.
    """
    place = [c for c in ("path", "entry_ord") if c in raw.columns]
    return (raw.where(F.trim("map_value") != "")
            .groupBy(F.upper("map_key").alias("declared_type")).agg(F.max_by("map_value", F.struct(*place, "map_value")).alias("warehouse_type")))


def read_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Catalogue inventory (env, db_name, schema_name, object_name, table_type)."""
    return spark.read.parquet(path).select("env", "db_name", "schema_name", "object_name", "table_type")


def read_ddl_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """DDL snapshots (fqdn, env, object_type, checked_on, obj_exists, ddl)."""
    return spark.read.parquet(path).select("fqdn", "env", "object_type", "checked_on", "obj_exists", "ddl")


def read_state(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A state table under its fixed schema."""
    return spark.read.schema(S.state_schema(name)).parquet(path)
