"""HTML pages to tables, cells, labels and nested documents."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward import constants as K
from schemaward.functions import text as X
from schemaward.functions.html import PageOutline

_LABELS = [K.TABLE_LABEL, K.SCHEMA_LABEL, K.DATABASE_LABEL, K.PRIMARY_KEYS_LABEL, K.FOREIGN_KEYS_LABEL]

_OUTLINE = T.StructType([
    T.StructField("blocks", T.MapType(T.StringType(), T.StringType())),
    T.StructField("tables", T.ArrayType(T.StructType([
        T.StructField("table_ord", T.IntegerType()), T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("rows", T.ArrayType(T.StructType([
            T.StructField("row_ord", T.IntegerType()), T.StructField("cells", T.ArrayType(T.StringType()))]))),
    ]))),
    T.StructField("failure", T.StringType()),
])
_BLOCKS = pa.map_(pa.string(), pa.string())
_TABLES = pa.list_(pa.struct([
    ("table_ord", pa.int32()), ("header", pa.list_(pa.string())),
    ("rows", pa.list_(pa.struct([("row_ord", pa.int32()), ("cells", pa.list_(pa.string()))]))),
]))
_SLICE = 64  # pages per output batch; one page may be long


def _outline(html: str | None) -> tuple[list, list]:
    page = PageOutline(html or "")
    tables = []
    for number, rows in enumerate(page.tables, 1):
        if not rows:
            continue  # a table without rows only consumes a number (W9)
        body = []
        for n, row in enumerate(rows[1:], 1):
            cells = [page.text(c) for c in row if c[2] == "td"]
            if cells:
                body.append({"row_ord": n, "cells": cells})
        tables.append({"table_ord": number, "header": [page.text(c) for c in rows[0]], "rows": body})
    return list(page.labelled(_LABELS).items()), tables


def _safe_outline(html: str | None) -> tuple[list, list, str | None]:
    """The outline, or why there is none: one page that cannot be read must not end the job."""
    try:
        return *_outline(html), None
    except Exception as e:
        return [], [], f"{type(e).__name__}: {e}"


def outline_pages(pages: DataFrame) -> DataFrame:
    """The Python half of H12: html replaced by labelled blocks, raw header and cell texts, and the failure if any.

    One output row per page with its other columns passed through, so nothing is
    shuffled, and everything after the tokenizer stays in native expressions.
    """
    kept = [f for f in pages.schema.fields if f.name != "html"]
    names = [f.name for f in kept] + ["blocks", "tables", "failure"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                some = batch.slice(at, _SLICE)
                made = [_safe_outline(h) for h in some.column(some.num_columns - 1).to_pylist()]
                arrays = [*some.columns[:-1], pa.array([m[0] for m in made], _BLOCKS), pa.array([m[1] for m in made], _TABLES), pa.array([m[2] for m in made], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return pages.select(*[f.name for f in kept], "html").mapInArrow(run, T.StructType([*kept, *_OUTLINE.fields]))


def page_tables(pages: DataFrame, one_per_header: bool = False, filled_rows: bool = False) -> DataFrame:
    """Pages (page_id, html) to cells, as read: repeated headers and blank rows included.

    Short rows get an empty or 'false' value for every missing column. ``one_per_header`` (W6) and ``filled_rows``
    (F5) do inside the table row, before it becomes cells, what ``dedupe_headers`` and ``drop_blank_rows`` do to
    cells, so nothing is shuffled.
    """
    t = outline_pages(pages.select("page_id", "html")).select("page_id", F.inline("tables"))
    keys = F.col("keys")
    if one_per_header:
        place = lambda k: F.struct(k.alias("key"), (F.array_position(keys, k) - 1).cast("int").alias("at"), _last_at(keys, k).alias("last"))
        columns = F.transform(F.array_distinct(keys), place)
    else:
        columns = F.transform(keys, lambda k, at: F.struct(k.alias("key"), at.alias("at"), at.alias("last")))
    # what the header says is worked out once per table, before its rows are dealt out
    t = t.select("page_id", "table_ord", "rows", F.transform("header", X.header_key).alias("keys")).select("page_id", "table_ord", "rows", columns.alias("columns"))
    r = t.select("page_id", "table_ord", "columns", F.inline("rows"))
    made = F.transform("columns", lambda c: F.struct(
        c["at"].alias("col_ord"), c["key"].alias("key"), X.cell_default(F.get(F.col("cells"), c["last"]), c["key"]).alias("value")))
    if filled_rows:  # inside one value: a filter on it would work the row out a second time
        filled = lambda m: F.when(F.exists(m, lambda e: _meaningful(e["key"], e["value"])), m)
        made = F.transform(F.array(made), filled)[0]
    return r.select("page_id", "table_ord", "row_ord", F.inline(made))


def dedupe_headers(cells: DataFrame) -> DataFrame:
    """Repeated headers keep the first place and the last column's value."""
    return cells.groupBy("page_id", "table_ord", "row_ord", "key").agg(
        F.max_by("value", "col_ord").alias("value"), F.min("col_ord").alias("col_ord"),
    ).select("page_id", "table_ord", "row_ord", "col_ord", "key", "value")


def _meaningful(key: Column, value: Column) -> Column:
    return (F.coalesce(value, F.lit("")) != "") & ~(key.isin(*K.FLAG_KEYS) & (value == "false"))


def drop_blank_rows(cells: DataFrame) -> DataFrame:
    """rows whose values are all '', false or null are dropped.

    The window spans one table row, which its header bounds; the cells shuffle once.
    """
    row = Window.partitionBy("page_id", "table_ord", "row_ord")
    filled = F.bool_or(_meaningful(F.col("key"), F.col("value"))).over(row)
    return cells.withColumn("_filled", filled).where("_filled").drop("_filled")


def primary_table(cells: DataFrame) -> DataFrame:
    """cells of the first table of each page."""
    return cells.where(F.col("table_ord") == 1)


def pivot_cells(cells: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One record per table row; wide columns for given keys, else a map column.

    A repeated header gives the value of its last column. A group is one table row,
    so it is bounded by the header of its table.
    """
    by = cells.groupBy("page_id", "table_ord", "row_ord")
    if keys is None:
        cells = by.agg(F.array_sort(F.collect_list(F.struct("col_ord", "key", "value"))).alias("_c"))
        names = F.array_distinct(F.transform("_c", lambda x: x["key"]))
        last = F.transform(names, lambda k: F.element_at(F.filter("_c", lambda x: x["key"] == k), -1)["value"])
        return cells.withColumn("record", F.map_from_arrays(names, last)).drop("_c")
    return by.pivot("key", keys).agg(F.max_by("value", "col_ord"))


def _last_at(keys: Column, key: Column) -> Column:
    return (F.size(keys) - F.array_position(F.reverse(keys), key)).cast("int")


def _last_value(keys: Column, cells: Column, key: Column) -> Column:
    """Value of the last column under a header."""
    return X.cell_default(F.get(cells, _last_at(keys, key)), key)


def _record(keys: Column, cells: Column) -> Column:
    """Map of one row: distinct keys in header order, each with its last column's value."""
    order = F.array_distinct(keys)
    return F.map_from_arrays(order, F.transform(order, lambda k: _last_value(keys, cells, k)))


def parsed_pages(pages: DataFrame) -> DataFrame:
    """A6 up to the struct: html and title replaced by ``page``, the nested parsed document, and ``failure``.

    Everything happens inside the page's own row, without a shuffle.
    ``pages``: page_id, title, html; other columns are passed through.
    """
    document = _document(F.col("page_id"), F.col("title"), F.col("blocks"), F.col("tables"))
    return outline_pages(pages).withColumn("page", document).drop("title", "blocks", "tables")


def _document(page_id: Column, title: Column, blocks: Column, tables: Column) -> Column:
    def table(t: Column) -> Column:
        keys = F.transform(t["header"], X.header_key)
        records = F.transform(t["rows"], lambda r: X.clean_map(_record(keys, r["cells"])))
        return F.struct(
            F.concat(F.lit("table_"), t["table_ord"].cast("string")).alias("id"),
            F.lit("dynamically_parsed").alias("table_type"),
            F.filter(records, lambda m: F.exists(F.map_entries(m), lambda e: _meaningful(e["key"], e["value"]))).alias("columns"),
        )

    clean_title = X.clean_text(title)
    value = {label: X.clean_text(X.label_value(blocks[label], label)) for label in _LABELS}
    return F.struct(
        clean_title.alias("page_title"), page_id.alias("page_id"),
        F.struct(
            X.table_name_or_title(value[K.TABLE_LABEL], clean_title).alias("table_name"),
            value[K.SCHEMA_LABEL].alias("schema_name"),
            value[K.DATABASE_LABEL].alias("database_name"),
            X.key_list(value[K.PRIMARY_KEYS_LABEL]).alias("primary_keys"),
            X.key_list(value[K.FOREIGN_KEYS_LABEL]).alias("foreign_keys"),
        ).alias("metadata"),
        F.transform(tables, table).alias("tables"),
    )


def to_parsed_json(pages: DataFrame) -> DataFrame:
    """page_id and the parsed document as JSON text."""
    return parsed_pages(pages).select("page_id", F.to_json("page", {"ignoreNullFields": "false"}).alias("parsed_json"))


def page_labels(pages: DataFrame) -> DataFrame:
    """H6-H9 over pages: table, schema and database names and the two key lists."""
    return parsed_pages(pages).select("page_id", "page.metadata.*")


# --- declared columns ---------------------------------------------------------

def colspecs(records: DataFrame) -> DataFrame:
    """Declared columns from the first table's records (page_id, row_ord, record map).

    The primary-key flag is read from either of its two headers; where the page
    parser has already made it 'true' or 'false', it reads as 'yes' or ''.
    """
    def value(key: str) -> Column:
        return F.coalesce(F.col("record")[key], F.lit(""))

    flag = F.col("record")["is_primary_key"]
    pk = F.coalesce(F.when(flag == "true", "yes").when(flag == "false", "").otherwise(flag),
                    F.col("record")["primary_key"], F.lit(""))
    return records.select(
        "page_id", "row_ord",
        *[value(k).alias(k) for k in ("source_table", "source_field_name", "target_field_name", "data_type",
                                      "add_source_to_target")],
        pk.alias("is_primary_key"), value("definition").alias("definition"), value("comments").alias("comments"))


def keep_named_rows(specs: DataFrame) -> DataFrame:
    """rows naming a source or a target field."""
    return specs.where((F.coalesce("source_field_name", F.lit("")) != "") | (F.coalesce("target_field_name", F.lit("")) != ""))


def columns_to_map(specs: DataFrame) -> DataFrame:
    """declared columns flagged for mapping."""
    return specs.where(X.is_yes(F.col("add_source_to_target")))
