"""Best-fit packing of token pieces into sequences of one length, planned on the histogram of piece lengths.

Exact complements first: an index holds the sums of single lengths, pairs and triples; for each length the combinations
that fill its gap exactly are looked up there and taken as often as their counts allow, and leave the index when a count
runs out. What is left is packed best fit. The histogram has at
most one row per length, so the plan's size depends on the capacity and never on the data. Pieces find their place by
length and rank among the pieces of that length, which comes from per-task counts without a shuffle of the pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import fresh, small_batches, spread, store, text_buffer
from schemaward.llm.bpe import default_path, pieces_of
from schemaward.llm.token_files import with_end

OFFSETS_BROADCAST = 2_000_000  # (task, length) counts up to which the rank offsets are broadcast
ADDED = T.StructType([T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType())])


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) for a histogram of lengths from 1 to ``capacity``.

    Exact complements of up to three, two or one lengths are tried, as triples may spend the short lengths that best fit
    needs later; the plan of fewest sequences is taken.
    """
    return min((_plan(counts, capacity, most) for most in (3, 2, 1)), key=lambda p: sum(times for _, times in p))


class _Sums:
    """Single, pair and triple sums of the available lengths, each with the combinations that make it.

    ``pairs`` maps a sum to the larger lengths of its pairs and ``triples`` to the largest lengths of its triples, longest
    first; a single is its own sum. Counts only fall, so a combination whose count has run out leaves the index for good.
    """

    def __init__(self, left: np.ndarray, most: int):
        self.left, capacity = left, len(left) - 1
        lengths = np.flatnonzero(left)[::-1]
        self.pairs: dict[int, np.ndarray] = {}
        self.triples: dict[int, np.ndarray] = {}
        if most > 1:
            i, j = np.nonzero((lengths[:, None] >= lengths) & (lengths[:, None] + lengths <= capacity))
            self.pairs = self._by_sum(lengths[i] + lengths[j], lengths[i])
        if most > 2 and self.pairs:
            sums, least = np.array(list(self.pairs)), np.array([larger[-1] for larger in self.pairs.values()])
            i, j = np.nonzero((lengths[:, None] >= least) & (lengths[:, None] + sums <= capacity))
            self.triples = self._by_sum(lengths[i] + sums[j], lengths[i])

    @staticmethod
    def _by_sum(sums: np.ndarray, longest: np.ndarray) -> dict[int, np.ndarray]:
        order = np.lexsort((-longest, sums))
        keys, first = np.unique(sums[order], return_index=True)
        return dict(zip(keys.tolist(), np.split(longest[order], first[1:]), strict=True)) if len(keys) else {}

    def _fits(self, pattern: tuple[int, ...]) -> bool:
        return all(self.left[x] >= pattern.count(x) for x in pattern)

    def _pair(self, total: int, longest: int, used: tuple[int, ...]) -> tuple[int, int] | None:
        larger = self.pairs.get(total)
        if larger is None:
            return None
        larger = self.pairs[total] = larger[(self.left[larger] > 0) & (self.left[total - larger] > 0)]
        for a in larger[np.searchsorted(-larger, -longest):].tolist():
            if self._fits((a, total - a, *used)):
                return a, total - a
        return None

    def complement(self, first: int) -> tuple[int, ...] | None:
        """The fewest lengths, the most uneven ones of them, none above ``first``, that fill its gap exactly."""
        gap = len(self.left) - 1 - first
        if gap == 0:
            return ()
        if gap <= first and self._fits((first, gap)):
            return (gap,)
        two = self._pair(gap, first, (first,))
        if two or gap not in self.triples:
            return two
        longest = self.triples[gap]
        longest = self.triples[gap] = longest[self.left[longest] > 0]
        for a in longest[np.searchsorted(-longest, -first):].tolist():
            two = self._pair(gap - a, a, (first, a))
            if two:
                return (a, *two)
        return None


def _plan(counts: dict[int, int], capacity: int, most: int) -> list[tuple[tuple[int, ...], int]]:
    """A plan with exact complements of up to ``most`` lengths, best fit behind them.

    Every step uses a pattern as often as its rarest length allows, so each step exhausts a length, or all but a rest
    below its multiplicity in the pattern: the plan has a few patterns per length at most.
    """
    left = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...]) -> bool:
        need: dict[int, int] = {}
        for x in pattern:
            need[x] = need.get(x, 0) + 1
        times = min(int(left[x]) // k for x, k in need.items())
        if times:
            for x, k in need.items():
                left[x] -= k * times
            out.append((pattern, times))
        return times > 0

    sums = _Sums(left, most)
    for first in range(capacity, 0, -1):
        while left[first] and (rest := sums.complement(first)) is not None:
            take((first, *rest))
    for first in range(capacity, 0, -1):
        while left[first]:
            pattern, gap = [first], capacity - first
            left[first] -= 1
            while gap and len(fit := np.flatnonzero(left[: gap + 1])):
                pattern.append(int(fit[-1]))
                left[fit[-1]] -= 1
                gap -= int(fit[-1])
            for x in pattern:
                left[x] += 1
            take(tuple(pattern))
    return out


def places(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, end rank, sequence of the first rank, offset) for every slot of a plan."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length in pattern:
            r = used.get(length, 0)
            rows.append((length, r, r + times, sequence, offset))
            used[length] = r + times
            offset += length
        sequence += times
    return rows


def cut_pieces(docs: DataFrame, capacity: int = 2048, text: str = "text", path: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece: the other columns of ``docs``, piece, start, length, ids, and last _part and _rank.

    A document is its ids and the end id; longer ones than ``capacity`` are cut into full pieces behind a first one
    that holds the remainder. _rank counts the pieces of one length inside one task (_part).
    """
    small_batches(docs.sparkSession)
    path = path or default_path()
    keep = [c for c in docs.columns if c != text and c.lower() not in {*(f.name for f in ADDED), "sequence_id", "offset"}]
    part_name, rank_name = (fresh(docs.columns, x) for x in ("_part", "_rank"))
    schema = T.StructType([docs.schema[c] for c in keep] + ADDED.fields + [T.StructField(part_name, T.IntegerType()), T.StructField(rank_name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, part, seen = pieces_of(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            ids, ends = with_end(*pieces.encode(*text_buffer(batch.column(batch.schema.get_field_index(text)))), end_id)
            sizes = np.diff(ends)
            number = -(-sizes // capacity)
            row = np.repeat(np.arange(len(sizes)), number)
            piece = spread(np.zeros(len(sizes), np.int64), number)
            first = (sizes - capacity * (number - 1))[row]
            start = np.where(piece > 0, first + (piece - 1) * capacity, 0)
            length = np.where(piece > 0, capacity, first)
            order = np.argsort(length, kind="stable")
            lengths, begin, many = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(begin, many) + seen[length[order]]
            seen[lengths] += many
            edges = np.append(ends[row] + start, ends[-1]) * 4
            packed = pa.Array.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(edges.astype(np.int64).tobytes()), pa.py_buffer(ids.astype("<u4").tobytes())])
            chosen = batch.take(pa.array(row)) if len(row) else batch.slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [chosen.column(chosen.schema.get_field_index(c)) for c in keep]
                + [pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), packed.cast(pa.binary()), pa.array(np.full(len(row), part, np.int32)), pa.array(rank)],
                names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def pack(docs: DataFrame, capacity: int = 2048, text: str = "text", path: str | None = None, end_id: int = 0) -> DataFrame:
    """The pieces of ``docs`` (its columns without the text, piece, start, length, ids) with sequence_id and offset.

    Null and empty texts are one piece of the end id alone; ties among equal lengths go by task and order of reading;
    an empty table gives no sequences. Other columns pass through; those of an added name are replaced.
    """
    spark = docs.sparkSession
    made = store(cut_pieces(docs, capacity, text, path, end_id), "pieces")
    *columns, part, rank = made.columns
    counts = store(made.groupBy(F.col(f"`{part}`").alias("part"), "length").agg(F.count(F.lit(1)).alias("n")), "counts")
    patterns = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)  # at most ``capacity`` rows
    own = {x: fresh(made.columns, x) for x in ("_p", "_before", "_length", "_from", "_to", "_sequence")}
    offsets = counts.selectExpr("part", "length", "sum(n) over (partition by length order by part rows between unbounded preceding and current row) - n as before")
    per_part = offsets.groupBy(F.col("part").alias(own["_p"])).agg(F.map_from_entries(F.collect_list(F.struct("length", "before"))).alias(own["_before"]))
    if counts.count() <= OFFSETS_BROADCAST:
        per_part = F.broadcast(per_part)
    # a few slots for each length at most, whatever the data
    slots = spark.createDataFrame(places(patterns), ", ".join(f"`{own[x]}` long" for x in ("_length", "_from", "_to", "_sequence")) + ", offset long")
    number = F.col(f"`{rank}`")
    ranked = made.join(per_part, F.col(f"`{part}`") == F.col(own["_p"])).withColumn(rank, number + F.col(own["_before"])[F.col("length")])
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col(own["_length"])) & (number >= F.col(own["_from"])) & (number < F.col(own["_to"])))
    return placed.withColumn("sequence_id", F.col(own["_sequence"]) + number - F.col(own["_from"])).select(*[f"`{c}`" for c in columns], "sequence_id", "offset")
