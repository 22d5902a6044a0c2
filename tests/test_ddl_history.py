"""Folding all snapshots at once must equal merging them run by run."""

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from schemaward import schemas as S
from schemaward.operators.ddl_history import (
    advance_history, ddl_history, fold_ddl, history_summary, internal_changes, late_snapshots, merge_ddl, state_of_summary)

SNAP = "fqdn string, env string, object_type string, checked_on timestamp_ntz, obj_exists boolean, ddl string"
T0 = dt.datetime(2024, 1, 1)


def _h(ddl):
    return hashlib.sha256(ddl.encode()).hexdigest() if ddl else None


def _simulate(snaps):
    """One-step history kept row by row in plain Python."""
    state = {}
    for fqdn, env, kind, ts, exists, ddl in sorted(snaps, key=lambda r: r[3]):
        key, h = (fqdn, env, kind), _h(ddl)
        old = state.get(key)
        if old is None:
            new = {"prev": None, "prev_ddl": None, "changed": ts, "extracted": ts if h else None}
        else:
            new = {k: old[k] for k in ("prev", "prev_ddl", "changed", "extracted")}
            if h and h != old["hash"]:
                new |= {"prev": old["hash"], "prev_ddl": old["ddl"], "changed": ts}
            elif not old["exists"] and exists:
                new["changed"] = ts
            if h:
                new["extracted"] = ts
        state[key] = new | {"hash": h, "ddl": ddl or None, "exists": exists, "checked": ts}
    return state


def _rows(df):
    return {(r.fqdn, r.env, r.object_type): {
        "prev": r.previous_ddl_hash, "prev_ddl": r.previous_ddl, "changed": r.ddl_changed_on, "extracted": r.last_extracted_on,
        "hash": r.current_ddl_hash, "ddl": r.current_ddl, "exists": r.obj_exists, "checked": r.last_checked_on} for r in df.collect()}


def _random_snaps(seed, objects=12, runs=60):
    rng, out = random.Random(seed), []
    for i in range(objects):
        for t in range(runs if i < 2 else rng.randrange(1, 12)):  # two hot objects
            exists = rng.random() > 0.25
            ddl = rng.choice(["a", "b", "c", "", None]) if exists else None
            out.append((f"D.S.T{i}", rng.choice(["DEV"]), "TABLE", T0 + dt.timedelta(minutes=17 * t + rng.randrange(10)), exists, ddl))
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 20, 3])
def test_fold_equals_simulation(spark, hot_rows):
    snaps = _random_snaps(hot_rows)
    assert _rows(fold_ddl(spark.createDataFrame(snaps, SNAP), hot_rows)) == _simulate(snaps)


def test_merge_run_by_run_equals_fold(spark):
    snaps = [s for s in _random_snaps(5, objects=4, runs=5)]
    times = sorted({s[3] for s in snaps})
    df = spark.createDataFrame(snaps, SNAP)
    state = spark.createDataFrame([], S.DDL_STATE)
    for ts in times[:8]:
        part = F.split("fqdn", r"\.")
        run = df.where(F.col("checked_on") == F.lit(ts)).select(
            "fqdn", "env", "object_type", part[0].alias("db_name"), part[1].alias("schema_name"), part[2].alias("object_name"),
            "obj_exists", "ddl", F.lit("").alias("notes"))
        state = spark.createDataFrame(merge_ddl(state, run, str(ts)).collect(), S.DDL_STATE)
    assert _rows(state) == _simulate([s for s in snaps if s[3] in times[:8]])


def test_drop_then_reappear_loses_previous(spark):
    ts = [T0 + dt.timedelta(days=d) for d in range(3)]
    snaps = [("D.S.T", "DEV", "TABLE", ts[0], True, "x"), ("D.S.T", "DEV", "TABLE", ts[1], False, None),
             ("D.S.T", "DEV", "TABLE", ts[2], True, "x")]
    row = _rows(fold_ddl(spark.createDataFrame(snaps, SNAP)))["D.S.T", "DEV", "TABLE"]
    assert row["prev"] is None and row["changed"] == ts[2] and row["hash"] == _h("x")


def test_history_marks_changes(spark):
    ts = [T0 + dt.timedelta(days=d) for d in range(4)]
    snaps = [("D.S.T", "DEV", "TABLE", t, True, d) for t, d in zip(ts, ["x", "x", "y", "y"])]
    got = [r.is_change for r in ddl_history(spark.createDataFrame(snaps, SNAP)).orderBy("checked_on").collect()]
    assert got == [True, False, True, False]
    folded = fold_ddl(spark.createDataFrame(snaps, SNAP))
    assert internal_changes(folded).count() == 1


def test_bursts_are_split(spark):
    from schemaward.plans import skew
    burst = [("D.S.B", "DEV", "TABLE", dt.datetime(2000, 1, 1), True, "x")]
    burst += [("D.S.B", "DEV", "TABLE", T0 + dt.timedelta(microseconds=1200 * k), True, f"v{k // 50}") for k in range(4000)]
    burst += [("D.S.C", "DEV", "TABLE", T0, True, "y")]
    rows = skew.time_blocks(spark.createDataFrame(burst, SNAP), S.OBJECT_KEY, "checked_on", 100)
    sizes = {(r.fqdn, r[skew.BLOCK]): r["count"] for r in rows.groupBy("fqdn", skew.BLOCK).count().collect()}
    assert sum(sizes.values()) == len(burst) and max(sizes.values()) <= 100 and sizes["D.S.C", 0] == 1
    order = [r[skew.BLOCK] for r in rows.where("fqdn = 'D.S.B'").orderBy("checked_on").collect()]
    assert order == sorted(order)
    assert _rows(fold_ddl(spark.createDataFrame(burst, SNAP), 100)) == _simulate(burst)


@pytest.mark.parametrize("cuts, hot_rows", [((0.5,), 1_000_000), ((0.2, 0.4, 0.9), 4), ((0.0, 0.97), 20)])
def test_increments_equal_one_fold_on_any_cut(spark, tmp_path, cuts, hot_rows):
    snaps = _random_snaps(11, objects=10, runs=40)
    times = sorted({s[3] for s in snaps})
    ends = [times[int(c * len(times))] for c in cuts] + [None]
    summary, begin = None, None
    for k, end in enumerate(ends):
        some = [s for s in snaps if (begin is None or s[3] >= begin) and (end is None or s[3] < end)]
        df = spark.createDataFrame(some, SNAP)
        summary = history_summary(df, hot_rows) if summary is None else advance_history(summary, df, hot_rows)
        summary.write.parquet(str(tmp_path / f"s{k}"))
        summary, begin = spark.read.parquet(str(tmp_path / f"s{k}")), end
        seen = [s for s in snaps if end is None or s[3] < end]
        assert _rows(state_of_summary(summary)) == _simulate(seen)
    assert state_of_summary(summary).columns == fold_ddl(spark.createDataFrame(snaps, SNAP)).columns


def test_increments_with_ties_and_late_rows(spark):
    shape = SNAP + ", n int"
    key = ("D.S.T", "DEV", "TABLE")
    old = spark.createDataFrame([(*key, T0, True, "x", 1), (*key, T0, True, "y", 2)], shape)
    new = spark.createDataFrame([(*key, T0, True, "z", 3), (*key, T0, True, "w", 2)], shape)
    summary = history_summary(old, tie="n")
    assert [r.ddl for r in late_snapshots(summary, new, tie="n").collect()] == ["w"]
    row = state_of_summary(advance_history(summary, new.where("n = 3"), tie="n")).collect()[0]
    assert (row.current_ddl, row.previous_ddl, row.ddl_changed_on) == ("z", "y", T0)
    same = state_of_summary(advance_history(summary, new.where("n > 9"), tie="n")).collect()[0]
    assert (same.current_ddl, same.previous_ddl) == ("y", "x")
