"""Scores against the textbook table and hand-computed values."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from schemaward.functions import lanes
from schemaward.functions import similarity as M

names = st.text(alphabet="ABC_ ", max_size=12)


def _table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(names, names)
def test_subsequence_length(a, b):
    assert M._lcs(a, b) == _table(a, b)


@settings(max_examples=200, deadline=None)
@given(names, names)
def test_bounds_and_symmetry(a, b):
    for score in M.STRATEGIES.values():
        assert 0 <= score(a, b) <= 100
        assert score(a, b) == pytest.approx(score(b, a))


@pytest.mark.parametrize("strategy, a, b, score", [
    ("RATIO", "", "", 100), ("QRATIO", "", "", 0), ("RATIO", "ABCD", "ABED", 75),
    ("PARTIAL_RATIO", "ABC", "XXABCXX", 100), ("TOKEN_SORT_RATIO", "B A", "A  B", 100),
    ("TOKEN_SET_RATIO", "A B C", "A B", 100), ("TOKEN_SET_RATIO", "A_B", "A_C", 200 * 2 / 6), ("TOKEN_SET_RATIO", "", "A", 0),
    ("WRATIO", "", "A", 0), ("WRATIO", "AB CD", "CD AB", 95),
])
def test_known_scores(strategy, a, b, score):
    assert M.STRATEGIES[strategy](a, b) == pytest.approx(score)


def test_best_choice_first_on_ties_and_cutoff(spark):
    df = spark.createDataFrame([("ABC", ["ABX", "ABY", "ZZZ"]), ("ABC", ["Q"]), ("ABC", []), ("ABC", ["ABCD", "ABC"]), (None, ["A"])],
                               "n string, c array<string>")
    got = df.select(M.best_choice("RATIO", 60.0, F.col("n"), F.col("c")).alias("b")).collect()
    assert [r.b.matched_column if r.b else None for r in got] == ["ABX", None, None, "ABC", None]


def _plain_choice(strategy, cutoff, name, options):
    """Every option scored, first of the best."""
    if name is None or options is None:
        return None, None
    scores = [(M.STRATEGIES[strategy](name, o), o) for o in options if o is not None]
    best = max((s for s, _ in scores if s >= cutoff), default=None)
    return next((o for s, o in scores if s == best), None), best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.none() | names, st.none() | st.lists(st.none() | names, max_size=6)), max_size=6),
       st.sampled_from([0.0, 50.0, 80.0, 100.0]), st.sampled_from(list(M.STRATEGIES)))
def test_limits_never_change_the_choice(rows, cutoff, strategy):
    found, points, scored = M.choose(strategy, cutoff, [n for n, _ in rows], [o for _, o in rows])
    assert list(zip(found, points)) == [_plain_choice(strategy, cutoff, n, o) for n, o in rows]
    assert all(k <= len(o or []) for k, (_, o) in zip(scored, rows))


def _words(rng, count, alphabet="ABCDE_ é", longest=24):
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))) for _ in range(count)]


@pytest.mark.parametrize("strategy", list(M.STRATEGIES))
def test_lanes_equal_single_pairs_and_stay_under_their_limits(strategy):
    rng = random.Random(7)
    a, b = _words(rng, 10_000), _words(rng, 10_000)
    got = M.lane_scores(strategy, a, b)
    assert got.tolist() == [M.STRATEGIES[strategy](x, y) for x, y in zip(a, b)]
    assert (M.score_limits(strategy, a, b) >= got).all()


@pytest.mark.parametrize("strategy", list(M.STRATEGIES))
def test_most_choices_of_real_names_are_never_scored(strategy):
    rng = random.Random(3)
    parts = ["CUSTOMER", "ORDER", "LINE", "DATE", "AMOUNT", "TAX", "CODE", "STATUS", "REGION", "NATION", "PART", "SUPPLIER"]
    options = [["_".join(rng.sample(parts, rng.randrange(1, 4))) for _ in range(40)] for _ in range(50)]
    wanted = [rng.choice(o)[:-1] + rng.choice("XYZ") for o in options]
    found, points, scored = M.choose(strategy, 80.0, wanted, options)
    assert list(zip(found, points)) == [_plain_choice(strategy, 80.0, n, o) for n, o in zip(wanted, options)]
    assert sum(scored) < (0.6 if strategy in ("PARTIAL_RATIO", "WRATIO") else 0.2) * 50 * 40


@pytest.mark.parametrize("longest", [5, 65, 130, 700])
def test_lanes_of_several_words(longest):
    rng = random.Random(longest)
    a, b = _words(rng, 60, longest=longest), _words(rng, 60, longest=longest)
    assert lanes.lcs_lengths(a, b).tolist() == [M.one_lcs(x, y) for x, y in zip(a, b)]
    wide = [chr(0x4E00 + rng.randrange(9000)) * 3 + x for x in a]
    assert lanes.lcs_lengths(wide, a).tolist() == [M.one_lcs(x, y) for x, y in zip(wide, a)]


def test_windows_of_long_texts():
    rng = random.Random(2)
    pairs = [sorted(p, key=len) for p in zip(_words(rng, 80, longest=90), _words(rng, 80, longest=90)) if all(p)]
    got = lanes.window_ratios([p[0] for p in pairs], [p[1] for p in pairs])
    assert got.tolist() == [M._slide(*p) for p in pairs]


def test_scores_and_choices_with_nulls(spark):
    df = spark.createDataFrame([("AB", "AB", ["AB"]), (None, "A", [None, "A"]), ("", "", [""]), ("AB", None, [None, "ABX"])], "a string, b string, c array<string>")
    for strategy in M.STRATEGIES:
        rows = df.select(M.similarity(strategy, F.col("a"), F.col("b")).alias("s"), M.best_choice(strategy, 50.0, F.col("a"), F.col("c")).alias("w")).collect()
        assert [r.s for r in rows] == [100.0, None, M.STRATEGIES[strategy]("", ""), None]
        want = [_plain_choice(strategy, 50.0, n, o) for n, o in (("AB", ["AB"]), (None, [None, "A"]), ("", [""]), ("AB", [None, "ABX"]))]
        assert [(r.w.matched_column, r.w.score) for r in rows] == want


def test_unknown_strategy():
    with pytest.raises(ValueError):
        M.check_strategy("SOUNDEX")
