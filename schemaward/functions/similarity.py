"""Name similarity: six published scores on a 0-100 scale, Arrow-vectorised.

The scores all rest on the longest common subsequence. ``lane_scores`` computes it for
all pairs of a batch together (see ``lanes``); the functions of one pair say what the
scores are. Spark's own expressions can fold an LCS table with nested ``aggregate``
calls, but those run interpreted per cell of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.functions.lanes import lcs_lengths, one_lcs, window_ratios


_lcs = one_lcs


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    if a == b:
        return 100.0
    return 200.0 * _lcs(a, b) / total


def quick_ratio(a: str, b: str) -> float:
    return ratio(a, b) if a and b else 0.0


def _slide(short: str, long: str) -> float:
    k, n = len(short), len(long)
    best = 0.0
    for i in range(1 - k, n):
        best = max(best, ratio(short, long[max(i, 0):i + k]))
        if best == 100.0:
            break
    return best


def partial_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_slide(a, b), _slide(b, a))
    return _slide(a, b) if len(a) < len(b) else _slide(b, a)


def _sorted_tokens(s: str) -> str:
    return " ".join(sorted(s.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(_sorted_tokens(a), _sorted_tokens(b))


def token_set_ratio(a: str, b: str) -> float:
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = sorted(left & right)
    only_left, only_right = sorted(left - right), sorted(right - left)
    if both and not (only_left and only_right):
        return 100.0
    common, with_left, with_right = (" ".join(x) for x in (both, both + only_left, both + only_right))
    score = ratio(with_left, with_right)
    if both:
        score = max(score, ratio(common, with_left), ratio(common, with_right))
    return score


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    spread = max(len(a), len(b)) / min(len(a), len(b))
    if spread < 1.5:
        return max(ratio(a, b), 0.95 * max(token_sort_ratio(a, b), token_set_ratio(a, b)))
    part = 0.9 if spread < 8 else 0.6
    shared = set(a.split()) & set(b.split())
    tokens = 100.0 if shared else partial_ratio(_sorted_tokens(a), _sorted_tokens(b))
    return max(ratio(a, b), part * partial_ratio(a, b), 0.95 * part * tokens)


STRATEGIES: dict[str, Callable[[str, str], float]] = {
    "RATIO": ratio,
    "PARTIAL_RATIO": partial_ratio,
    "TOKEN_SORT_RATIO": token_sort_ratio,
    "TOKEN_SET_RATIO": token_set_ratio,
    "WRATIO": weighted_ratio,
    "QRATIO": quick_ratio,
}


# --- the same scores for all pairs of a batch ----------------------------------

_PAIRS = 1 << 16  # pairs scored together


def _sizes(texts: Sequence[str]) -> np.ndarray:
    return np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))


def _per_text(texts: Sequence[str], fn: Callable) -> list:
    """``fn`` of every text, computed once per distinct text."""
    known: dict[str, object] = {}
    return [known[t] if t in known else known.setdefault(t, fn(t)) for t in texts]


def _from_common(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """RATIO from the length of a common subsequence and both lengths."""
    total = a + b
    return np.where(total == 0, 100.0, 200.0 * common / np.where(total == 0, 1, total))


def _ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    return _from_common(lcs_lengths(a, b), _sizes(a), _sizes(b))


def _both(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    return (_sizes(a) > 0) & (_sizes(b) > 0)


def _quick_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    return np.where(_both(a, b), _ratios(a, b), 0.0)


def _partial_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    size_a, size_b = _sizes(a), _sizes(b)
    out = np.where((size_a == 0) & (size_b == 0), 100.0, 0.0)
    filled = (size_a > 0) & (size_b > 0)
    for slides, short, long in ((size_a <= size_b, a, b), (size_b <= size_a, b, a)):
        at = np.flatnonzero(filled & slides)
        out[at] = np.maximum(out[at], window_ratios([short[i] for i in at], [long[i] for i in at]))
    return out


def _token_sort_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    return _ratios(_per_text(a, _sorted_tokens), _per_text(b, _sorted_tokens))


def _tokens(s: str) -> frozenset[str]:
    return frozenset(s.split())


def _token_set_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """The shared words begin both joined texts, so they are common to them whole and only the rest is compared."""
    out, at, rest_a, rest_b, shared = np.zeros(len(a)), [], [], [], []
    for i, (left, right) in enumerate(zip(_per_text(a, _tokens), _per_text(b, _tokens))):
        if not left or not right:
            continue
        both = left & right
        if both and (len(both) == len(left) or len(both) == len(right)):
            out[i] = 100.0
            continue
        at.append(i)
        rest_a.append(" ".join(sorted(left - both)))
        rest_b.append(" ".join(sorted(right - both)))
        shared.append(sum(map(len, both)) + len(both) - 1 if both else -1)
    common = np.array(shared, dtype=np.int64)
    front = common + 1  # the shared words and the blank behind them
    size_a, size_b = front + _sizes(rest_a), front + _sizes(rest_b)
    best = _from_common(front + lcs_lengths(rest_a, rest_b), size_a, size_b)
    for size in (size_a, size_b):
        best = np.maximum(best, np.where(common >= 0, _from_common(common, common, size), 0.0))
    out[at] = best
    return out


def _where(mask: np.ndarray, fn: Callable, a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    out = np.zeros(len(a))
    at = np.flatnonzero(mask)
    if len(at):
        out[at] = fn([a[i] for i in at], [b[i] for i in at])
    return out


def _weighted_ratios(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    size_a, size_b = _sizes(a), _sizes(b)
    filled = (size_a > 0) & (size_b > 0)
    spread = np.maximum(size_a, size_b) / np.maximum(np.minimum(size_a, size_b), 1)
    near, far = filled & (spread < 1.5), filled & (spread >= 1.5)
    words = np.maximum(_where(near, _token_sort_ratios, a, b), _where(near, _token_set_ratios, a, b))
    shares = np.array([not x.isdisjoint(y) for x, y in zip(_per_text(a, _tokens), _per_text(b, _tokens))], dtype=bool)
    part = np.where(spread < 8, 0.9, 0.6)
    tokens = np.where(shares, 100.0, _where(far & ~shares, lambda x, y: _partial_ratios(_per_text(x, _sorted_tokens), _per_text(y, _sorted_tokens)), a, b))
    whole = _where(filled, _ratios, a, b)
    far_score = np.maximum(np.maximum(whole, part * _where(far, _partial_ratios, a, b)), 0.95 * part * tokens)
    return np.where(near, np.maximum(whole, 0.95 * words), np.where(far, far_score, 0.0))


_LANES: dict[str, Callable[[Sequence[str], Sequence[str]], np.ndarray]] = {
    "RATIO": _ratios, "PARTIAL_RATIO": _partial_ratios, "TOKEN_SORT_RATIO": _token_sort_ratios,
    "TOKEN_SET_RATIO": _token_set_ratios, "WRATIO": _weighted_ratios, "QRATIO": _quick_ratios,
}


def lane_scores(strategy: str, a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """Scores of all pairs under a strategy."""
    fn = _LANES[check_strategy(strategy)]
    parts = [fn(a[i:i + _PAIRS], b[i:i + _PAIRS]) for i in range(0, len(a), _PAIRS)]
    return np.concatenate(parts) if parts else np.zeros(0)


_LETTERS = 32


def _letter_counts(texts: Sequence[str]) -> np.ndarray:
    """Letters per text, folded to ``_LETTERS`` kinds: folding can only raise what two texts seem to share."""
    sizes = _sizes(texts)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32) % _LETTERS
    at = np.repeat(np.arange(len(texts)), sizes) * _LETTERS + points
    return np.bincount(at, minlength=len(texts) * _LETTERS).reshape(len(texts), _LETTERS)


def _set_words(s: str) -> str:
    return " ".join(sorted(set(s.split())))


def _shared_letters(a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """At least the length of the longest common subsequence of each pair."""
    texts = list(dict.fromkeys([*a, *b]))
    number = {t: i for i, t in enumerate(texts)}
    counts = _letter_counts(texts).astype(np.int32)
    left, right = (np.fromiter((number[t] for t in side), dtype=np.int64, count=len(side)) for side in (a, b))
    return np.minimum(counts[left], counts[right]).sum(axis=1)


def score_limits(strategy: str, a: Sequence[str], b: Sequence[str]) -> np.ndarray:
    """A score that no pair can exceed, from lengths, letters and words.

    A common subsequence holds no letter more often than both texts do. RATIO grows with it. A window of length w
    shares at most min(c, w) letters with a short text of length k, so PARTIAL_RATIO is at most 200 c / (k + c), c
    being the letters that both texts share. TOKEN_SET is 100 at most where words are shared and the RATIO of the
    distinct words otherwise. WRATIO is put together from these limits as from the scores.
    """
    strategy = check_strategy(strategy)
    size_a, size_b = _sizes(a), _sizes(b)

    def whole(x: Sequence[str], y: Sequence[str]) -> np.ndarray:
        return _from_common(_shared_letters(x, y), _sizes(x), _sizes(y))

    def partial(x: Sequence[str], y: Sequence[str]) -> np.ndarray:
        common, short = _shared_letters(x, y), np.minimum(_sizes(x), _sizes(y))
        return np.where(_both(x, y), _from_common(common, short, common), np.where(_sizes(x) == _sizes(y), 100.0, 0.0))

    if strategy == "RATIO":
        return whole(a, b)
    if strategy == "QRATIO":
        return np.where(_both(a, b), whole(a, b), 0.0)
    if strategy == "PARTIAL_RATIO":
        return partial(a, b)
    by_order = whole(_per_text(a, _sorted_tokens), _per_text(b, _sorted_tokens))
    if strategy == "TOKEN_SORT_RATIO":
        return by_order
    words_a, words_b = _per_text(a, _tokens), _per_text(b, _tokens)
    shares = np.array([not x.isdisjoint(y) for x, y in zip(words_a, words_b)], dtype=bool)
    empty = np.array([not x or not y for x, y in zip(words_a, words_b)], dtype=bool)
    by_set = np.where(shares, 100.0, np.where(empty, 0.0, whole(_per_text(a, _set_words), _per_text(b, _set_words))))
    if strategy == "TOKEN_SET_RATIO":
        return by_set
    spread = np.maximum(size_a, size_b) / np.maximum(np.minimum(size_a, size_b), 1)
    part = np.where(spread < 8, 0.9, 0.6)
    tokens = np.where(shares, 100.0, partial(_per_text(a, _sorted_tokens), _per_text(b, _sorted_tokens)))
    near = np.maximum(whole(a, b), 0.95 * np.maximum(by_order, by_set))
    far = np.maximum(np.maximum(whole(a, b), part * partial(a, b)), 0.95 * part * tokens)
    return np.where(_both(a, b), np.where(spread < 1.5, near, far), 0.0)


def choose(strategy: str, cutoff: float, names: Sequence[str | None], options: Sequence) -> tuple[list, list, list]:
    """Best option, its score and the number of options scored, per name.

    Options equal to the name end the list: nothing behind them can be better. Then the option with the highest limit
    is scored, and after it only those whose limit reaches both the cutoff and that score.
    """
    row, place, left, right = [], [], [], []
    for i, (name, some) in enumerate(zip(names, options)):
        if name is None or some is None:
            continue
        for k, option in enumerate(some):
            if option is None:
                continue
            row.append(i), place.append(k), left.append(name), right.append(option)
            if option == name and name.split():
                break
    rows, places, count = np.array(row, dtype=np.int64), np.array(place, dtype=np.int64), len(names)
    limits = np.concatenate([score_limits(strategy, left[i:i + _PAIRS], right[i:i + _PAIRS]) for i in range(0, len(left), _PAIRS)] or [np.zeros(0)])
    scores = np.full(len(rows), -1.0)
    best = np.full(count, -1.0)
    possible = limits >= cutoff
    order = np.lexsort((places, -limits, rows))
    order = order[possible[order]]
    head = order[np.r_[True, rows[order][1:] != rows[order][:-1]]] if len(order) else order

    def score(at: np.ndarray) -> None:
        scores[at] = lane_scores(strategy, [left[i] for i in at], [right[i] for i in at])
        np.maximum.at(best, rows[at], np.where(scores[at] >= cutoff, scores[at], -1.0))

    score(head)
    rest = possible & (limits >= best[rows])
    rest[head] = False
    score(np.flatnonzero(rest))
    scored = np.bincount(rows[scores >= 0], minlength=count)
    won = np.flatnonzero((scores >= cutoff) & (scores >= 0) & (scores == best[rows]))[::-1]  # the first of equals is written last
    found, points = [None] * count, [None] * count
    for i in won:
        found[rows[i]], points[rows[i]] = right[i], float(scores[i])
    return found, points, [int(n) for n in scored]


def check_strategy(name: str) -> str:
    if name.upper() not in STRATEGIES:
        raise ValueError(f"unknown match strategy {name!r}; one of {', '.join(STRATEGIES)}")
    return name.upper()


def similarity(strategy: str, a: Column, b: Column) -> Column:
    """Score of two string columns under a strategy; null if either is null."""
    strategy = check_strategy(strategy)

    @F.pandas_udf(T.DoubleType())
    def scored(left: pd.Series, right: pd.Series) -> pd.Series:
        known = (left.notna() & right.notna()).to_numpy()
        out = np.full(len(left), np.nan)
        out[known] = lane_scores(strategy, left[known].tolist(), right[known].tolist())
        return pd.Series(out).astype(object).where(known, None).astype("Float64")

    return scored(a, b)


def sim_ratio(a: Column, b: Column) -> Column:
    """H20."""
    return similarity("RATIO", a, b)


def sim_partial(a: Column, b: Column) -> Column:
    """H21."""
    return similarity("PARTIAL_RATIO", a, b)


def sim_token_sort(a: Column, b: Column) -> Column:
    """H22."""
    return similarity("TOKEN_SORT_RATIO", a, b)


def sim_token_set(a: Column, b: Column) -> Column:
    """H23."""
    return similarity("TOKEN_SET_RATIO", a, b)


def sim_wratio(a: Column, b: Column) -> Column:
    """H24."""
    return similarity("WRATIO", a, b)


def sim_qratio(a: Column, b: Column) -> Column:
    """H24."""
    return similarity("QRATIO", a, b)


def best_choice(strategy: str, cutoff: float, name: Column, choices: Column) -> Column:
    """struct<matched_column, score, scored> of the first best choice at or above the cutoff.

    The choices stay in one array per row, so no (name, choice) row is ever made. Limits from lengths, letters and
    words leave out a choice only where its score provably stays below the cutoff or the best so far; ``scored`` counts
    the choices that were compared. Where only equal texts score 100 an equal choice is found by a native expression.
    """
    strategy = check_strategy(strategy)
    out = T.StructType([T.StructField("matched_column", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("scored", T.LongType())])

    @F.pandas_udf(out)
    def chosen(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for names, options in batches:
            found, points, scored = choose(strategy, cutoff, names.tolist(), options.tolist())
            yield pd.DataFrame({"matched_column": pd.Series(found, dtype=object), "score": pd.Series(points, dtype="Float64"), "scored": scored})

    if strategy not in ("RATIO", "QRATIO"):
        return chosen(name, choices)
    equal = F.coalesce(F.array_contains(choices, name) & (name != "") & F.lit(cutoff <= 100), F.lit(False))
    exact = F.struct(name.alias("matched_column"), F.lit(100.0).alias("score"), F.lit(0).cast("long").alias("scored"))
    # rows with an equal choice reach Python without their choices
    return F.when(equal, exact).otherwise(chosen(name, F.when(~equal, choices)))


def mapping_status(score: Column, exact_only: bool = False) -> Column:
    """Status of a best score; null score means nothing reached the cutoff."""
    low = F.when(score.isNull(), "UNMAPPED_LOW_SCORE")
    if exact_only:
        low = low.when(score < 100, "UNMAPPED_NOT_EXACT")
    return low.when(score == 100, "MAPPED_EXACT").otherwise("MAPPED_FUZZY")
