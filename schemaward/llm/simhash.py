"""SimHash near-dedup: fingerprints of word shingles, links at a small Hamming distance, one class per component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from schemaward.llm.batches import chunks, fresh, small_batches, spread, store, text_buffer, word_spans
from schemaward.llm.components import smallest_reachable

SEED = 42
PAIR_BUCKET = 16  # fingerprints of a bucket that are compared pair by pair; larger buckets take the exact way beside it
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# a byte's eight bits, each in a byte of its own, so that up to 255 hashes add up without carry
_SPREAD = np.array([sum(((v >> k) & 1) << (8 * k) for k in range(8)) for v in range(256)], np.uint64)


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per row of consecutive hashes: the bits set in over half of them; zero without hashes."""
    counts = np.diff(first)
    pieces = -(-counts // 255)
    owner = np.repeat(np.arange(len(counts)), pieces)
    begin = np.repeat(first[:-1], pieces) + 255 * spread(np.zeros(len(counts), np.int64), pieces)
    sums = np.zeros((len(counts), 64), np.int64)
    if len(begin):
        wide = np.add.reduceat(_SPREAD[hashes.astype("<u8").view(np.uint8).reshape(-1, 8)], begin, axis=0)
        bits = wide.astype("<u8").view(np.uint8).reshape(len(begin), 64).astype(np.int64)
        full = np.flatnonzero(pieces)
        sums[full] = np.add.reduceat(bits, np.searchsorted(owner, full), axis=0)
    return np.packbits(sums * 2 > counts[:, None], axis=1, bitorder="little").view("<u8").ravel()


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles, row by row, and for each row its first one."""
    starts, ends, first = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    # the words in one buffer with a single space behind each, so that a shingle is one slice
    lengths = ends - starts + 1
    close = np.cumsum(lengths)
    flat = np.full(close[-1], 0x20, np.uint8)
    at = spread(close - lengths, lengths - 1)
    flat[at] = data[spread(starts, lengths - 1)]
    words = np.diff(first)
    counts = np.where(words > 0, np.maximum(words - size + 1, 1), 0)
    head = spread(first[:-1], counts)
    tail = np.minimum(head + size, np.repeat(first[1:], counts)) - 1
    begin, stop = (close - lengths)[head].tolist(), (close - 1)[tail].tolist()
    raw, one = flat.tobytes(), xxhash.xxh64_intdigest
    hashes = np.fromiter((one(raw[a:b], SEED) for a, b in zip(begin, stop, strict=True)), np.uint64, len(begin))
    return hashes, np.concatenate([[0], np.cumsum(counts)])


def row_fingerprints(data: np.ndarray, offsets: np.ndarray, size: int) -> np.ndarray:
    """The fingerprint of every row of a buffer in lower case."""
    return _majority(*_shingle_hashes(data, offsets, size))


def fingerprints(docs: DataFrame, text: str = "text", size: int = 3) -> DataFrame:
    """``docs`` without its text, with fingerprint (a long that holds the 64 bits).

    Texts are whole; A-Z counts as a-z. A text of fewer words than ``size`` has one shingle, its whole sequence; one
    without words (null and empty too) has fingerprint zero.
    """
    small_batches(docs.sparkSession)
    name = "fingerprint"
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), name)]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
            data, parts = _LOWER[data], [np.zeros(0, np.uint64)]
            for i, j in chunks(offsets):
                parts.append(row_fingerprints(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], size))
            made = pa.array(np.concatenate(parts).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [made], names=[*keep, name])

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def _variants(distinct: DataFrame) -> DataFrame:
    """(key, fp): for each 32-bit segment of fp and each of its bits, the segment with that bit left out."""
    low = F.lit(0xFFFFFFFF).cast("long")
    bits = F.array(*[F.lit(k).cast("long") for k in range(32)])
    wild = distinct.select("fp", F.explode(bits).alias("bit"))
    wild = wild.select("fp", "bit", F.expr("~shiftleft(1L, int(bit))").alias("mask"), F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    part = F.expr("shiftrightunsigned(fp, 32 * half)").bitwiseAND(low).bitwiseAND(F.col("mask"))
    return wild.select((part + F.expr("shiftleft(bit * 2 + half, 32)")).alias("key"), "fp")


def near_links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct values ``fp`` so that two values within two bits are connected.

    Of two segments one differs by at most one bit, so such values share a key that leaves this bit out. Keys of one
    pair give it at once; keys of up to PAIR_BUCKET values are joined with themselves and every pair is verified. The
    values of larger keys (near copies in great number) are spelled out instead with each bit flipped once: values
    within two bits share such a spelling, and all that share one lie within two bits of each other, so the smallest
    of at most 65 stands for all and no pairs are formed.
    """
    close = "bit_count(a ^ b) <= 2"
    # the 64 variants of a value arise in as many tasks as the shuffle has, and cross it once
    spread_out = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    shared = _variants(spread_out).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("n > 1")
    members = store(shared, "buckets")
    two = members.where("n = 2").groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where(close).select("a", "b")
    few = members.where(F.col("n") <= PAIR_BUCKET)
    pairs = few.select("key", F.col("fp").alias("a")).join(few.select("key", F.col("fp").alias("b")), "key").where("a < b").where(close).select("a", "b")
    crowd = members.where(F.col("n") > PAIR_BUCKET).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k).cast("long") for k in range(64)])
    balls = crowd.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("key"))
    ball = balls.groupBy("key").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = balls.join(ball, "key").where("fp <> a").select("a", F.col("fp").alias("b"))
    return two.unionAll(pairs).unionAll(star).distinct()


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = 3) -> DataFrame:
    """``docs`` without its text, with fingerprint and component_id, the smallest ``key`` of all rows that links reach.

    Rows link at fingerprints two or fewer bits apart. Copies share a fingerprint and never form pairs: links run
    between distinct fingerprints. Null keys are kept and never name a class unless it has no other key; an empty
    table gives an empty result; other columns pass through.
    """
    marked = store(fingerprints(docs, text, size), "fingerprints")
    distinct = store(marked.groupBy(F.col("fingerprint").alias("fp")).agg(F.min(key).alias("low")), "distinct")
    roots = smallest_reachable(near_links(distinct.select("fp")))
    classes = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    # one row per fingerprint; a class of any size is reduced before it is joined
    lows = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(lows, "root").select(F.col("fp").alias(fresh(docs.columns, "_fp")), "component_id")
    other = named.columns[0]
    return marked.drop("component_id").join(named, F.col("fingerprint") == F.col(other)).drop(other)
