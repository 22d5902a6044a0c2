"""Resolution of declared data types to warehouse types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward import constants as K
from schemaward.functions.text import strip

# Known dialect limit: base word(s), then at most two integer parameters.
_PARAMETERS = r"\(\s*\d+(\s*,\s*\d+)?\s*\)"
_SYNTAX = rf"^[A-Z_][A-Z0-9_ ]*({_PARAMETERS})?$"
_SIZED = rf"^[A-Z_]+\s*{_PARAMETERS}$"
# what can be wrong with a declared type, and the category it puts the type in
FAULTS = {"absent": "MISSING", "syntax": "MALFORMED", "brackets": "MALFORMED", "base": "MALFORMED", "mapping": "UNMAPPED"}


def _lookup(table: dict[str, str], key: Column) -> Column:
    """Fixed table as a literal map, so that no join is planned for it."""
    return F.expr(f"map({', '.join(repr(x) for kv in table.items() for x in kv)})")[key]


def _count(c: Column, char: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def parse_type(c: Column) -> Column:
    """struct<cleaned, base, params, balanced, wellformed> of a declared type."""
    cleaned = F.replace(strip(F.upper(c)), F.lit("FLOAT OR NUMBER"), F.lit("NUMBER"))
    params = F.regexp_replace(F.regexp_extract(cleaned, r"\(([^()]*)\)", 1), r"\s+", "")
    return F.struct(
        cleaned.alias("cleaned"),
        strip(F.regexp_extract(cleaned, r"^([A-Z0-9_ ]*)", 1)).alias("base"),
        F.nullif(params, F.lit("")).alias("params"),
        (_count(cleaned, "(") == _count(cleaned, ")")).alias("balanced"),
        cleaned.rlike(_SYNTAX).alias("wellformed"),
    )


def canonical_type(base: Column, synonyms: dict[str, str] = K.TYPE_SYNONYMS) -> Column:
    """Synonym replaced by its canonical base type."""
    return F.coalesce(_lookup(synonyms, base), base)


def resolve_types(df: DataFrame, type_map: DataFrame, col: str = "data_type",
                  synonyms: dict[str, str] = K.TYPE_SYNONYMS,
                  valid: list[str] = K.VALID_BASE_TYPES) -> DataFrame:
    """Adds resolved_type, type_warnings (array) and type_category.

    ``type_map`` has (declared_type, warehouse_type) rows with distinct upper-case
    keys. Only valid base types are ever looked up, so at most len(valid) of its
    rows are broadcast, and the declared columns are not shuffled on their type.
    """
    raw = F.col(col)
    typed = df.withColumn("_t", parse_type(raw)).withColumn("_base", canonical_type(F.col("_t.base"), synonyms))
    entries = type_map.where(F.col("declared_type").isin(*valid)).groupBy(F.col("declared_type").alias("_base")).agg(
        F.max("warehouse_type").alias("_mapped"))
    joined = typed.join(F.broadcast(entries), "_base", "left")

    shown = F.coalesce(raw, F.lit("None"))
    base, mapped, params = F.col("_base"), F.col("_mapped"), F.col("_t.params")
    blank = raw.isNull() | (raw == "")
    balanced = F.col("_t.balanced")
    broken = ~blank & ~(F.col("_t.wellformed") & balanced)
    usable = ~blank & ~broken
    unknown = usable & ~base.isin(*valid)
    unmapped = usable & ~unknown & mapped.isNull()
    rebuilt = (
        F.when(F.upper(strip(mapped)).rlike(_SIZED), mapped)
        .when(params.isNotNull(), F.concat(mapped, F.lit("("), params, F.lit(")")))
        .when((F.upper(mapped) == "NUMBER") & base.isin(*K.INTEGER_LIKE), F.lit("NUMBER(38,0)"))
        .otherwise(mapped)
    )
    found = {"absent": blank, "syntax": broken & ~F.col("_t.wellformed"), "brackets": broken & ~balanced, "base": unknown, "mapping": unmapped}
    faults = F.array_compact(F.array(*[F.when(found[code], F.lit(code)) for code in FAULTS]))
    said = F.transform(faults, lambda f: F.concat(f, F.lit(": "), shown))
    return (
        joined
        .withColumn("resolved_type", F.when(usable & ~unknown & ~unmapped, rebuilt).otherwise(K.DEFAULT_TYPE))
        .withColumn("type_warnings", said)
        .withColumn("type_category", fault_category(faults))
        .select(*df.columns, "resolved_type", "type_warnings", "type_category")
    )


def fault_category(faults: Column) -> Column:
    """The category of a type's first fault, MAPPED without any."""
    return F.coalesce(_lookup(FAULTS, F.get(faults, F.lit(0))), F.lit("MAPPED"))
