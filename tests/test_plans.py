"""Sorted lists in parts and state in buckets."""

import random

import pytest
from pyspark.sql import functions as F

from schemaward.operators import merge
from schemaward.plans.buckets import BucketedState
from schemaward.plans.sorted_lists import sorted_parts


@pytest.mark.parametrize("ranges, items", [(1, 7), (9, 7), (40, 1000), (None, 1)])
def test_parts_joined_are_the_sorted_set(spark, ranges, items):
    rng = random.Random(items)
    rows = [(rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, *"xyzé"]) and f"{rng.choice('xyzé')}{rng.randrange(150)}") for _ in range(900)]
    got = sorted_parts(spark.createDataFrame(rows, "g string, i string"), ["g"], "i", items, ranges).collect()
    want = {}
    for g, i in rows:
        if i is not None:
            want.setdefault(g, set()).add(i)
    assert {r.g for r in got} == set(want)
    for g, some in want.items():
        parts = sorted((r for r in got if r.g == g), key=lambda r: r.part)
        assert [r.part for r in parts] == list(range(len(parts)))
        assert [i for r in parts for i in r["items"]] == sorted(some, key=lambda s: s.encode())
        assert all(len(r["items"]) == items for r in parts[:-1]) and {r.total for r in parts} == {len(some)}


def test_parts_of_nothing(spark):
    empty = spark.createDataFrame([], "g string, i long")
    assert sorted_parts(empty, ["g"], "i").count() == 0


def _state(spark, n=400):
    return spark.createDataFrame([(k, f"v{k}", k * 1.0) for k in range(n)], "k long, v string, x double")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_run_reads_and_writes_its_buckets_only(spark, tmp_path):
    plain = _state(spark)
    state = BucketedState.create(plain, str(tmp_path / "s"), ["k"], 32)
    assert _rows(state.read()) == _rows(plain)
    changes = spark.createDataFrame([(7, "new"), (900, "more"), (7, "newest"), (8, None)], "k int, v string").withColumn("at", F.monotonically_increasing_id())
    before, seen = dict(state._paths), []

    def merged(old, new):
        seen.extend(old.inputFiles())
        return merge.upsert(old, new, ["k"], order="at")

    numbers = state.update(changes, merged)
    assert len(numbers) <= 3 and _rows(state.read()) == _rows(merge.upsert(plain, changes, ["k"], order="at"))
    assert seen and all(any(f"_bucket={b}/" in f for b in numbers) for f in seen)
    after = state._paths
    assert {b for b in after if after[b] != before.get(b)} == set(numbers)
    assert _rows(BucketedState(spark, str(tmp_path / "s")).read()) == _rows(state.read())  # as another session finds it


def test_failed_run_leaves_the_state(spark, tmp_path):
    state = BucketedState.create(_state(spark, 50), str(tmp_path / "s"), ["k"], 8)
    want, changes = _rows(state.read()), spark.createDataFrame([(1, "z")], "k long, v string")

    def fails(old, new):
        return merge.upsert(old, new, ["k"]).withColumn("v", F.when(F.col("k") == 1, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    with pytest.raises(Exception, match="lost"):
        state.update(changes, fails)
    assert _rows(BucketedState(spark, str(tmp_path / "s")).read()) == want
    with pytest.raises(ValueError, match="not given"):
        state.update(changes, lambda old, new: _state(spark, 50))
    assert _rows(BucketedState(spark, str(tmp_path / "s")).read()) == want


def test_empty_changes_empty_state_and_emptied_buckets(spark, tmp_path):
    state = BucketedState.create(_state(spark, 0), str(tmp_path / "s"), ["k"], 4)
    changes = spark.createDataFrame([(1, "z"), (2, "y")], "k long, v string")
    assert state.read().count() == 0 and state.update(changes.where("k > 9"), lambda old, new: old) == []
    state.update(changes, lambda old, new: merge.upsert(old, new, ["k"]))
    assert _rows(state.read()) == [(1, "z", None), (2, "y", None)]
    state.update(changes.where("k = 1"), lambda old, new: old.where("k <> 1"))
    assert _rows(state.read()) == [(2, "y", None)]
