"""Keyed upserts into state tables.

Results are new DataFrames: write them to a new directory, never over the input.
Changes are reduced to one row per key before they meet the state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _last(changes: DataFrame, keys: list[str], given: list[str], supplied: str | None, order: str | None) -> DataFrame:
    """One row per key: for each column of ``given`` a struct of its value in the last change that supplies it, or null.

    Changes of one key apply in the sequence of ``order``; rows of equal order, or all without one, go by their values.
    """
    rest = F.struct(*[F.col(c) for c in sorted(given)])
    turn = F.struct(F.col(order), rest) if order else rest
    said = lambda c: F.when(F.array_contains(supplied, c), turn) if supplied else turn
    picks = [F.max_by(F.struct(F.col(c).alias("value")), said(c)).alias(f"_n_{c}") for c in given]
    return changes.groupBy(*keys).agg(*(picks or [F.count(F.lit(1)).alias("_n")])).withColumn("_seen", F.lit(True))


def upsert(state: DataFrame, changes: DataFrame, keys: list[str], supplied: str | None = None, order: str | None = None) -> DataFrame:
    """M1: columns of ``changes`` overwrite the state, other columns are kept; new keys get nulls.

    ``supplied`` names an array column of ``changes`` listing the columns each row
    really supplies; unlisted ones are kept. Several changes of a key apply one after
    the other in the sequence of ``order`` and give one row. Keys are unique in the
    state. State and changes meet in one full outer join.
    """
    given = [c for c in changes.columns if c not in keys and c not in (supplied, order) and c in state.columns]
    new = _last(changes, keys, given, supplied, order)
    pick = lambda c: F.when(F.col(f"_n_{c}").isNotNull(), F.col(f"_n_{c}.value")).otherwise(F.col(c)).alias(c)
    return state.join(new, keys, "full").select(*[pick(c) if c in given else F.col(c) for c in state.columns])


def replace_by_key(state: DataFrame, changes: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """M2: whole rows of ``changes`` take the place of state rows with the same key; of several for a key the last."""
    values = [c for c in state.columns if c not in keys]
    rest = F.struct(*values)
    last = changes.groupBy(*keys).agg(F.max_by(rest, F.struct(F.col(order), rest) if order else rest).alias("_row"))
    kept = state.join(changes.select(*keys), keys, "left_anti").select(*state.columns)
    return kept.unionByName(last.select(*keys, "_row.*").select(*state.columns))


def orphan_keys(child: DataFrame, parent: DataFrame, keys: list[str]) -> DataFrame:
    """Child rows whose key is missing in the parent (referential integrity)."""
    return child.join(parent.select(*keys), keys, "left_anti")


def lookup(df: DataFrame, **key) -> DataFrame:
    """Rows of one key; equality predicates reach the file scan."""
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df
