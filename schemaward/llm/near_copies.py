"""Near copies by the Jaccard similarity of word shingles: SimHash classes propose pairs, MinHash bands those that SimHash

leaves apart, and the whole shingle sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, fresh, mix, rolling_hashes, small_batches, span_hashes, spread, store, text_buffer, word_spans
from schemaward.llm.components import smallest_reachable
from schemaward.llm.marks import Marks
from schemaward.llm.simhash import _LOWER, row_fingerprints
from schemaward.llm.simhash import near_links as fingerprint_links

BANDS, ROWS = 24, 5  # a pair at 0.8 shares no band with a chance of (1 - 0.8**5)**24, under 1 in 10,000
ROUNDS = ((0, 2), (2, BANDS))  # bands whose members are linked to a centre before the next ones are looked at
PRINT = 3            # words of a shingle of the fingerprints, as in op9
LEVELS = 1           # passes over what the rounds leave apart; one compares all of it
PAIR_BUCKET = 256    # members of a block of a bucket; two blocks are compared in one place
BLOCK_SHINGLES = 1 << 18  # and their shingles, 2 MB
COLUMNS = 1 << 12    # shingles of a tile that are counted at once
_DRAW = np.random.default_rng(805)
_TIMES = _DRAW.integers(1, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _DRAW.integers(0, 1 << 63, BANDS * ROWS, np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of all rows, row by row, and where each row's begin (one more entry).

    A row of fewer words than ``size`` has one shingle, its whole sequence; a row without words has none.
    """
    starts, ends, first = word_spans(data, offsets)
    words, counts = span_hashes(data, starts, ends), np.diff(first)
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for width in range(1, size + 1):
        rows = np.flatnonzero(counts >= size if width == size else counts == width)
        begin = np.concatenate([[0], np.cumsum(counts[rows])])
        at, found = rolling_hashes(words[spread(first[:-1][rows], counts[rows])], begin, width)
        owners.append(rows[np.searchsorted(begin, at, "right") - 1])
        hashes.append(found)
    owner, value = np.concatenate(owners), np.concatenate(hashes)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(len(counts) + 1))


def _set_ids(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit name of each row's set."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(values ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def _bands(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BANDS keys of each row that has shingles, one row of the matrix each, and which rows these are."""
    rows = np.flatnonzero(np.diff(first))
    keys = np.zeros((len(rows), BANDS), np.uint64)
    if len(rows):
        begin = first[rows]
        for band in range(BANDS):
            key = np.full(len(rows), band + 1, np.uint64)
            for k in range(band * ROWS, band * ROWS + ROWS):
                key = mix(key ^ np.minimum.reduceat(values * _TIMES[k] + _PLUS[k], begin))
            keys[:, band] = key
    return keys, rows


def _pieces_of(batch: pa.RecordBatch, text: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes in lower case and row offsets of pieces of a batch."""
    data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
    data = _LOWER[data]
    for i, j in chunks(offsets):
        yield i, data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64), pa.int64())


def _marked(docs: DataFrame, text: str, keep: list[str], size: int, names: list[str]) -> DataFrame:
    """(keep, set, n, bands, print): the name of each row's shingle set, its size, its band keys and the row's fingerprint."""
    schema = T.StructType([*[docs.schema[k] for k in keep], *[T.StructField(n, t) for n, t in zip(names, (T.LongType(), T.LongType(), T.ArrayType(T.LongType()), T.LongType()), strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [batch.schema.get_field_index(k) for k in keep]
            for i, data, offsets in _pieces_of(batch, text):
                values, first = shingle_sets(data, offsets, size)
                keys, rows = _bands(values, first)
                many = np.zeros(len(first), np.int32)
                many[rows + 1] = BANDS
                bands = pa.ListArray.from_arrays(pa.array(np.cumsum(many, dtype=np.int32)), _signed(keys.ravel()))
                yield pa.RecordBatch.from_arrays([*[batch.column(k).slice(i, len(first) - 1) for k in at], _signed(_set_ids(values, first)), pa.array(np.diff(first), pa.int64()), bands,
                                                  _signed(row_fingerprints(data, offsets, PRINT))], names=schema.names)

    return docs.select(*[f"`{k}`" for k in keep], f"`{text}`").mapInArrow(run, schema)


def _sets(docs: DataFrame, text: str, size: int, wanted: DataFrame) -> DataFrame:
    """(set, shingles) for the sets ``wanted`` (one column); others that share a slot of the filter may be there too."""
    marks = Marks(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, offsets in _pieces_of(batch, text):
                values, first = shingle_sets(data, offsets, size)
                ids = _set_ids(values, first)
                rows = np.flatnonzero(marks.among(ids))
                counts = np.diff(first)[rows]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), _signed(values[spread(first[:-1][rows], counts)]))
                yield pa.RecordBatch.from_arrays([_signed(ids[rows]), lists], names=["set", "shingles"])

    return docs.select(f"`{text}`").mapInArrow(run, "set long, shingles array<long>").groupBy("set").agg(F.any_value("shingles").alias("shingles"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of sets whose Jaccard similarity reaches the bound."""
    left = pairs.select("a", "b").distinct().join(sets.select(F.col("set").alias("a"), F.col("shingles").alias("x")).hint("merge"), "a")
    both = left.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("y")).hint("merge"), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common / (F.size("x") + F.size("y") - common) >= similarity).select("a", "b")


def _rooted(rows: DataFrame, roots: DataFrame | None, column: str, name: str) -> DataFrame:
    """``rows`` with the class so far of the set in ``column``; a set without links is a class of its own."""
    if roots is None:
        return rows.withColumn(name, F.col(column))
    side = roots.select(F.col("set").alias("_node"), F.col("root").alias(name)).hint("merge")
    return rows.join(side, F.col(column) == F.col("_node"), "left").drop("_node").withColumn(name, F.coalesce(name, column))


def _apart(members: DataFrame) -> DataFrame:
    """Members (key, set, size, root) of buckets that hold several classes; of buckets with the same members one stays."""
    mixed = members.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set")).alias("x"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return members.join(mixed.groupBy("n", "x", "lo", "hi").agg(F.min("key").alias("key")).select("key").hint("merge"), "key")


def _tiles(apart: DataFrame) -> DataFrame:
    """(tile, left, set, root): the members of every two blocks of a bucket, and of each block by itself.

    A block holds about PAIR_BUCKET members or BLOCK_SHINGLES shingles. A large class has blocks of its own, which are
    not compared with each other, so a crowd of near copies meets only the others of its bucket.
    """
    weight = F.greatest(F.lit(1 / PAIR_BUCKET), F.col("size") / F.lit(BLOCK_SHINGLES))
    classes = apart.groupBy("key", "root").agg(F.sum(weight).alias("w"))
    pools = classes.groupBy("key").agg(F.greatest(F.ceil(F.sum(F.when(F.col("w") <= 0.5, F.col("w")).otherwise(0.0))), F.lit(1)).alias("pool"))
    alone = F.col("w") > 0.5
    part = F.when(alone, F.pmod(F.xxhash64("set"), F.ceil("w"))).otherwise(F.pmod(F.xxhash64("root"), "pool"))
    block = F.xxhash64("key", alone, F.when(alone, F.col("root")).otherwise(F.lit(0).cast("long")), part)
    dealt = store(apart.join(classes.hint("merge"), ["key", "root"]).join(pools.hint("merge"), "key").select("key", block.alias("block"), "set", "root"), "blocks")
    blocks = dealt.groupBy("key", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    a, b = (blocks.select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("block", "lo", "hi")]) for side in "ab")
    both = a.join(b.hint("merge"), "key").where("block_a <= block_b and least(lo_a, lo_b) <> greatest(hi_a, hi_b)")
    meet = both.select(F.xxhash64("block_a", "block_b").alias("tile"), "block_a", F.explode(F.array_distinct(F.array("block_a", "block_b"))).alias("block"))
    return dealt.drop("key").join(meet.hint("merge"), "block").select("tile", (F.col("block") == F.col("block_a")).alias("left"), "set", "root")


def _common(values: np.ndarray, counts: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many values each row of ``left`` shares with each of ``right``; a row's values differ."""
    owner = np.repeat(np.arange(len(counts)), counts)
    column = np.unique(values, return_inverse=True)[1]
    shared = np.bincount(column) > 1  # a value of one row alone meets nothing
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float32)
    width = int(shared.sum())
    for lo in range(0, width, COLUMNS):
        i, j = np.searchsorted(column, [lo, lo + COLUMNS])
        held = np.zeros((len(counts), min(COLUMNS, width - lo)), np.float32)
        held[owner[i:j], column[i:j] - lo] = 1
        out += held[left] @ held[right].T
    return out.astype(np.int64)


def _tile_links(values: np.ndarray, counts: np.ndarray, roots: np.ndarray, first: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Links (smaller, larger) that join the classes of a tile whose members reach the similarity, no more than join them."""
    left, right = np.flatnonzero(first), np.flatnonzero(~first)
    if not len(right):
        right = left
    common = _common(values, counts, left, right)
    whole = counts[left][:, None] + counts[right][None, :] - common
    i, j = np.nonzero((common / whole >= similarity) & (roots[left][:, None] != roots[right][None, :]))
    pairs = np.sort(np.stack([roots[left[i]], roots[right[j]]], axis=1), axis=1)
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while x in above:
            x = above[x]
        return x
    out = []
    for a, b in np.unique(pairs, axis=0).tolist():
        x, y = sorted((top(a), top(b)))
        if x != y:
            above[y] = x
            out.append((a, b))
    return out


def _compared(apart: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) of classes with members of one bucket that reach the similarity.

    Members travel once per tile with their shingles, and a tile's pairs are counted by products of its 0/1 matrix,
    so no row is made for a pair. Two blocks of a few megabytes are the most that meet in one place.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rest = batch if rest is None else pa.concat_batches([rest, batch])
            tile = rest.column(0).to_numpy()
            cut = int(np.searchsorted(tile, tile[-1])) if len(tile) else 0
            if cut:
                yield links(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield links(rest)

    def links(rows: pa.RecordBatch) -> pa.RecordBatch:
        tile, left, root = (rows.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        counts = pc.list_value_length(rows.column(3)).to_numpy().astype(np.int64)
        values, ends = rows.column(3).flatten().to_numpy(), np.concatenate([[0], np.cumsum(counts)])
        edges = [0, *(np.flatnonzero(np.diff(tile)) + 1).tolist(), len(tile)]
        out = [x for i, j in zip(edges, edges[1:]) for x in _tile_links(values[ends[i]: ends[j]], counts[i:j], root[i:j], left[i:j], similarity)]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = _tiles(apart).join(sets.hint("merge"), "set").select("tile", "left", "root", "shingles")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(run, "a long, b long").distinct()


def _by_fingerprint(distinct: DataFrame) -> DataFrame:
    """Pairs (a, b): every set and the first one of its SimHash class, in which fingerprints link at two bits or fewer."""
    prints = distinct.where("size > 0").select("set", "fp")
    roots = smallest_reachable(fingerprint_links(prints.select("fp").distinct()))
    rooted = store(_rooted(prints, roots.select(F.col("node").alias("set"), "root"), "fp", "class"), "classes")
    first = rooted.groupBy("class").agg(F.min("set").alias("a"), F.max("set").alias("last")).where("a <> last").select("class", "a")
    return rooted.join(first.hint("merge"), "class").where("set <> a").select("a", F.col("set").alias("b"))


def near_links(distinct: DataFrame, docs: DataFrame, text: str, size: int, similarity: float) -> DataFrame | None:
    """(set, root) of linked sets of ``distinct`` (set, size, bands, fp): what SimHash or a band proposes and reaches the similarity.

    SimHash comes first: each set is compared with the first one of its class, so most copies are linked by one pair.
    Every set is compared with one centre of its bucket, another in each band, and only if the links found in earlier
    rounds of bands do not connect them yet: a crowd of near copies costs about one comparison a set. In buckets
    whose members stay apart all classes are compared by whole sets, in tiles of two blocks: rows grow with the members
    (up to PAIR_BUCKET, then with the number of blocks), and none of the pairs that share a band is left out.
    """
    keyed = distinct.select("set", "size", F.posexplode("bands").alias("band", "key"))
    centres = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("key", "set").alias("h"), "set", "size")).alias("c")).where("n > 1")
    members = store(keyed.join(centres.select("key", F.col("c.set").alias("centre"), F.col("c.size").alias("centre_size")).hint("merge"), "key"), "buckets")
    alike = store(_by_fingerprint(distinct), "alike")
    wanted = members.select("set").unionAll(alike.select("a")).unionAll(alike.select("b")).distinct()
    sets = store(_sets(docs, text, size, wanted), "sets")
    roots = None

    def linked(links: DataFrame) -> None:
        """Adds links of sets or of classes: only the classes that they join are looked at again."""
        nonlocal roots
        found = store(links, "verified")
        if found.isEmpty():
            return
        between = _rooted(_rooted(found, roots, "a", "x"), roots, "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        joined = smallest_reachable(between).select(F.col("node").alias("set"), "root")
        if roots is not None:
            others = joined.join(roots.select("set").hint("merge"), "set", "left_anti")
            joined = _rooted(roots.select("set", F.col("root").alias("was")), joined, "was", "root").select("set", "root").unionAll(others)
        roots = store(joined, "roots")

    linked(_verified(alike, sets, similarity))
    for low, high in ROUNDS:
        near = members.where(F.col("band").between(low, high - 1) & (F.col("set") != F.col("centre")) & (F.least("size", "centre_size") / F.greatest("size", "centre_size") >= similarity))
        near = _rooted(_rooted(near, roots, "set", "x"), roots, "centre", "y").where("x <> y")
        linked(_verified(near.select(F.least("set", "centre").alias("a"), F.greatest("set", "centre").alias("b")), sets, similarity))
    for _ in range(LEVELS):
        linked(_compared(store(_apart(_rooted(members.select("key", "set", "size"), roots, "set", "root")), "apart"), sets, similarity))
    return roots


def _classes(marked: DataFrame, names: list[str], low, docs: DataFrame, text: str, size: int, similarity: float) -> DataFrame:
    """(set, low, root): one row per distinct set with the least ``low`` of its rows."""
    distinct = store(marked.groupBy(*[F.col(n).alias(m) for n, m in zip(names, ("set", "size", "bands"), strict=False)]).agg(F.min(names[3]).alias("fp"), F.min(low).alias("low")), "distinct")
    return _rooted(distinct.select("set", "low"), near_links(distinct.drop("low"), docs, text, size, similarity), "set", "root")


def near_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """(key, component_id) for every row: the smallest ``key`` of all rows that links reach.

    Rows link when the Jaccard similarity of their sets of ``size``-word shingles is ``similarity`` or more; A-Z counts
    as a-z. Copies share a set and never form pairs. Rows without words are copies of each other. Null keys are kept
    and never name a class unless it has no other key.
    """
    small_batches(docs.sparkSession)
    names = [fresh([key], n) for n in ("set", "size", "bands", "print")]
    marked = store(_marked(docs, text, [key], size, names), "marked")
    classes = _classes(marked, names, F.col(f"`{key}`"), docs, text, size, similarity)
    # one row per set; a class of any size is reduced before it is joined
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lows.hint("merge"), "root").select(F.col("set").alias(names[0]), "component_id")
    return marked.select(f"`{key}`", names[0]).join(named.hint("merge"), names[0]).drop(names[0])


def first_of_classes(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 5, similarity: float = 0.8) -> DataFrame:
    """One row of ``docs`` of each class of ``near_copies``, with all its columns: that of the smallest key, null keys last.

    The choice is by rows, so keys may repeat: of several rows of the smallest key in a class, and of wholly equal rows,
    one stays. Columns of map type are not allowed, as a row is known by a hash of all its columns beside its key.
    """
    small_batches(docs.sparkSession)
    names = [fresh([*docs.columns, "_hash"], n) for n in ("_set", "_size", "_bands", "_print")]
    mark = fresh(docs.columns, "_hash")
    hashed = docs.withColumn(mark, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    marked = store(_marked(hashed, text, [key, mark], size, names), "marked")
    low = F.struct(F.col(f"`{key}`").isNull().alias("none"), F.col(f"`{key}`").alias("key"), F.col(mark).alias("hash"))
    classes = _classes(marked, names, low, docs, text, size, similarity)
    first = classes.groupBy("root").agg(F.min("low").alias("low")).select(F.col("low.hash").alias("_first"), F.col("low.key").alias("_key")).distinct()
    # both sides grow with the corpus, so neither is broadcast at any size
    kept = hashed.join(first.hint("merge"), (F.col(mark) == F.col("_first")) & F.col(f"`{key}`").eqNullSafe(F.col("_key")), "left_semi")
    return kept.dropDuplicates([mark, key]).select(*[f"`{c}`" for c in docs.columns])
