"""CREATE statements rendered from declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def render_create(specs: DataFrame, keys: list[str], table: str = "table_name") -> DataFrame:
    """One CREATE TABLE text per group of declared columns, in declared order.

    Inputs: keys, table, row_ord, target_field_name, resolved_type, is_primary_key (boolean).
    A statement is one value, so a group is as large as the statement it becomes.
    """
    rows = F.sort_array(F.collect_list(F.struct("row_ord", "target_field_name", "resolved_type", "is_primary_key")))
    made = specs.groupBy(*keys, table).agg(rows.alias("c"))
    lines = F.transform("c", lambda x: F.concat(
        F.lit("    "), F.upper(x["target_field_name"]), F.lit(" "), x["resolved_type"],
        F.when(x["is_primary_key"], " NOT NULL").otherwise("")))
    pk = F.transform(F.filter("c", lambda x: x["is_primary_key"]), lambda x: F.upper(x["target_field_name"]))
    constraint = F.when(F.size(pk) > 0, F.concat(F.lit("    PRIMARY KEY ("), F.array_join(pk, ", "), F.lit(")")))
    body = F.concat_ws(",\n", lines, constraint)
    return made.select(*keys, table, F.concat(F.lit("CREATE TABLE "), F.col(table), F.lit(" (\n"), body, F.lit("\n);")).alias("ddl"))
