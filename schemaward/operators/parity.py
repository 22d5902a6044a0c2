"""DDL drift inside an environment and parity between environments."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from schemaward import schemas as S


def existing(ddl_state: DataFrame, objects: DataFrame | list[str] | None = None) -> DataFrame:
    """F8: existing objects, optionally only the listed names (list, or DataFrame with fqdn)."""
    found = ddl_state.where("obj_exists")
    if objects is None:
        return found
    if isinstance(objects, DataFrame):
        return found.join(objects.select(F.upper("fqdn").alias("fqdn")), "fqdn", "left_semi")
    return found.where(F.col("fqdn").isin(*[o.upper() for o in objects]))


def known_envs(df: DataFrame, envs: list[str]) -> DataFrame:
    """rows of environments in the checked list."""
    return df.where(F.col("env").isin(*[e.upper() for e in envs]))


def parity_status(left: Column, right: Column) -> Column:
    """Status of two sides given as struct<hash,...>; a null struct is an absent side."""
    return (
        F.when(left.isNull() & right.isNull(), F.lit(None).cast("string"))
        .when(right.isNull(), "MISSING_IN_TARGET")
        .when(left.isNull(), "MISSING_IN_SOURCE")
        .when(left["hash"].eqNullSafe(right["hash"]), "MATCH")
        .otherwise("DDL_HASH_MISMATCH")
    )


def _side(env: str) -> Column:
    fields = F.struct(F.col("current_ddl_hash").alias("hash"), F.col("fqdn").alias("fqdn"), F.col("object_type").alias("object_type"))
    return F.max(F.when(F.col("env") == env.upper(), fields))


def _compare(rows: DataFrame, keys: list[str], source: str, target: str) -> DataFrame:
    """Both sides of every key from one scan and one aggregation instead of a full outer join."""
    sides = known_envs(rows, [source, target]).groupBy(*keys).agg(_side(source).alias("l"), _side(target).alias("r"))
    return sides.withColumn("status", parity_status(F.col("l"), F.col("r"))).where("status is not null")


def env_parity(ddl_state: DataFrame, source: str, target: str) -> DataFrame:
    """C11: existing objects of two environments compared by (fqdn, object_type)."""
    return _compare(existing(ddl_state), ["fqdn", "object_type"], source, target).select(
        "fqdn", "object_type", "status",
        F.col("l.hash").alias("source_hash"), F.col("r.hash").alias("target_hash"))


def mismatch_texts(ddl_state: DataFrame, source: str, target: str) -> DataFrame:
    """Both texts of the objects that differ between two environments: fqdn, object_type, source_ddl, target_ddl.

    The comparison moves fingerprints only; texts are fetched for the mismatches alone.
    """
    keys = ["fqdn", "object_type"]
    differing = env_parity(ddl_state, source, target).where("status = 'DDL_HASH_MISMATCH'").select(*keys)

    def side(env: str, name: str) -> DataFrame:
        return known_envs(existing(ddl_state), [env]).select(*keys, F.col("current_ddl").alias(name))
    return differing.join(side(source, "source_ddl"), keys).join(side(target, "target_ddl"), keys)


def logical_parity(ddl_state: DataFrame, resolver: DataFrame, source: str, target: str) -> DataFrame:
    """The same comparison per logical source, whose objects are named differently per environment."""
    named = existing(ddl_state).join(
        known_envs(resolver, [source, target]).select("source_name", *S.OBJECT_KEY), S.OBJECT_KEY)
    return _compare(named, ["source_name"], source, target).select(
        "source_name", F.col("l.fqdn").alias("source_fqdn"), F.col("r.fqdn").alias("target_fqdn"), "status",
        F.coalesce(F.col("l.object_type") != F.col("r.object_type"), F.lit(False)).alias("type_mismatch"))


def types_per_fqdn(ddl_state: DataFrame) -> DataFrame:
    """A4: object types per name, sorted; a handful of types bounds the set."""
    return ddl_state.groupBy("fqdn").agg(F.sort_array(F.collect_set(F.upper("object_type"))).alias("object_types"))


def nest_by_fqdn(ddl_state: DataFrame) -> DataFrame:
    """A5: fqdn -> env -> object type -> fingerprint as nested maps.

    Rows are reduced to one per (fqdn, env, type) first, so a map never holds more
    than environments times types entries.
    """
    one = ddl_state.groupBy("fqdn", F.upper("env").alias("env"), F.upper("object_type").alias("object_type")).agg(
        F.max("current_ddl_hash").alias("hash"))
    types = one.groupBy("fqdn", "env").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("object_type", "hash")))).alias("types"))
    return types.groupBy("fqdn").agg(
        F.map_from_entries(F.collect_list(F.struct("env", "types"))).alias("envs"))


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Report order, as a range-partitioned global sort."""
    return df.orderBy(*(columns or ("fqdn", "env", "object_type")))


def line_diff(pairs: DataFrame, keys: list[str], old: str = "old_ddl", new: str = "new_ddl") -> DataFrame:
    """U4: lines only in the old ('-') or only in the new ('+') text, with their surplus copies.

    Only differing pairs are exploded; both directions come from one signed count,
    which combines before the shuffle.
    """
    a, b = F.coalesce(F.col(old), F.lit("")), F.coalesce(F.col(new), F.lit(""))
    differing = pairs.where(a != b)

    def lines(c: Column, side: int) -> Column:
        return F.transform(F.split(c, "\n"), lambda x: F.struct(x.alias("line"), F.lit(side).alias("side")))

    return (
        differing.select(*keys, F.inline(F.concat(lines(a, -1), lines(b, 1))))
        .groupBy(*keys, "line").agg(F.sum("side").alias("balance")).where("balance <> 0")
        .select(*keys, F.when(F.col("balance") < 0, "-").otherwise("+").alias("sign"), "line",
                F.abs("balance").alias("copies"))
    )


def _common_lines(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """A longest common subsequence of two lists as index pairs: one bit per line of ``b`` in the rows of the table."""
    where: dict[str, int] = {}
    for j, line in enumerate(b):
        where[line] = where.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    rows = [full]
    for line in a:
        free = rows[-1]
        hit = free & where.get(line, 0)
        rows.append(((free + hit) | (free - hit)) & full)
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif not rows[i - 1] >> (j - 1) & 1:
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append((i, j))
    return out[::-1]


def _aligned_lines(a: list[str], b: list[str]) -> list[tuple[int, int]]:
    """Index pairs of lines that stay: equal beginnings and ends, then the longest rising run of lines that stand once on
    both sides, and a longest common subsequence in each gap between them."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    mid_a, mid_b = a[head: len(a) - tail], b[head: len(b) - tail]
    once_a, once_b = Counter(mid_a), {line: j for j, line in enumerate(mid_b)}
    single = Counter(mid_b)
    tops, best, before = [], [], {}
    for i, line in enumerate(mid_a):
        if once_a[line] == 1 and single[line] == 1:
            j = once_b[line]
            at = bisect_left(tops, j)
            before[i, j] = best[at - 1] if at else None
            tops[at: at + 1], best[at: at + 1] = [j], [(i, j)]
    anchors, step = [], best[-1] if best else None
    while step:
        anchors.append(step)
        step = before[step]
    kept, i, j = [(k, k) for k in range(head)], 0, 0
    for x, y in [*reversed(anchors), (len(mid_a), len(mid_b))]:
        kept += [(head + i + p, head + j + q) for p, q in _common_lines(mid_a[i:x], mid_b[j:y])]
        if x < len(mid_a):
            kept.append((head + x, head + y))
        i, j = x + 1, y + 1
    return kept + [(len(a) - tail + k, len(b) - tail + k) for k in range(tail)]


def line_edits(pairs: DataFrame, keys: list[str], old: str = "old_ddl", new: str = "new_ddl") -> DataFrame:
    """U4 in order: (keys, sign, line, old_position, new_position), one row for each line removed ('-') or added ('+').

    Positions count from 1; a removed line's new_position, and an added line's old_position, is that of the last line
    before it that stays or is handled, 0 at the start. A moved line is removed in one place and added in another.
    Applying the rows to the old text gives the new one. Texts of a pair meet in one row and only differing pairs are
    read; null texts count as empty.
    """
    a, b = F.coalesce(F.col(old), F.lit("")), F.coalesce(F.col(new), F.lit(""))

    def edits(x: str, y: str) -> list[dict]:
        left, right, out, i, j = x.split("\n"), y.split("\n"), [], 0, 0
        for p, q in [*_aligned_lines(left, right), (len(left), len(right))]:
            out += [{"sign": "-", "line": left[k], "old_position": k + 1, "new_position": j} for k in range(i, p)]
            out += [{"sign": "+", "line": right[k], "old_position": p, "new_position": k + 1} for k in range(j, q)]
            i, j = p + 1, q + 1
        return out

    @F.pandas_udf("array<struct<sign:string,line:string,old_position:long,new_position:long>>")
    def edited(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([edits(x, y) for x, y in zip(xs, ys)], dtype=object)

    return pairs.where(a != b).select(*keys, F.inline(edited(a, b)))


def schema_diff(cols_a: DataFrame, cols_b: DataFrame, keys: list[str]) -> DataFrame:
    """Columns ADDED, REMOVED, TYPE_CHANGED or MOVED between two column lists.

    Inputs: keys, ordinal, name, type. Both lists are united and compared per
    (keys, name) by one combinable aggregation.
    """
    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, "name", F.struct("ordinal", "type").alias("c"), F.lit(side).alias("side"))

    both = tagged(cols_a, "a").unionByName(tagged(cols_b, "b")).groupBy(*keys, "name").agg(
        F.min(F.when(F.col("side") == "a", F.col("c"))).alias("a"),
        F.min(F.when(F.col("side") == "b", F.col("c"))).alias("b"))
    change = (
        F.when(F.col("a").isNull(), "ADDED").when(F.col("b").isNull(), "REMOVED")
        .when(F.col("a.type") != F.col("b.type"), "TYPE_CHANGED")
        .when(F.col("a.ordinal") != F.col("b.ordinal"), "MOVED")
    )
    return both.withColumn("change", change).where("change is not null").select(
        *keys, "name", "change", F.col("a.type").alias("old_type"), F.col("b.type").alias("new_type"),
        F.col("a.ordinal").alias("old_ordinal"), F.col("b.ordinal").alias("new_ordinal"))
