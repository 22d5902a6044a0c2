"""Token-id files of directly addressable codes: any token is read without decoding its neighbours.

An id is split into bytes, lowest first. Level k holds the k-th byte of every id that has one; a bitmap says for each
whether a further byte follows, and a rank directory counts the set bits before every 512th, so the place of an id on
the next level is one lookup and one short popcount. A file set is a folder of segments in ascending key order, each
row one segment of whole documents, written by Spark's own committer, so a lost executor leaves no part behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import fresh, small_batches, text_buffer
from schemaward.llm.bpe import default_path, pieces_of

RANK_BITS = 512
BASES_BROADCAST = 100_000  # files up to which their first positions are broadcast; more are joined by shuffle
ASKED_BROADCAST = 1_000_000  # positions up to which they are broadcast to the segments; more are joined by shuffle
_SLICE = 8_192  # positions of a segment read at once
_CELL = 1 << 20  # positions of one cell of the segment index
LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))
_LEVEL_TYPE = "array<struct<chunks:binary,more:binary,ranks:binary>>"


def encode_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of non-negative ids below 2**32."""
    out, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        blocks = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        out.append({"chunks": (rest & 0xFF).astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": (np.cumsum(blocks) - blocks).astype("<u4").tobytes()})
        rest = rest[more] >> 8
        if not len(rest):
            return out


def token_at(levels: list[dict[str, bytes]], position: int) -> int:
    """The id at a position: one byte, one bit and one rank a level."""
    value, shift = 0, 0
    for level in levels:
        value |= level["chunks"][position] << shift
        if not level["more"][position >> 3] >> (position & 7) & 1:
            break
        block = position // RANK_BITS
        lo = block * RANK_BITS // 8
        before = int.from_bytes(level["more"][lo: (position >> 3) + 1], "little") & ((1 << (position - block * RANK_BITS)) - 1)
        position = int.from_bytes(level["ranks"][4 * block: 4 * block + 4], "little") + before.bit_count()
        shift += 8
    return value


def tokens_at(levels: list[dict[str, bytes]], positions: np.ndarray) -> np.ndarray:
    """``token_at`` for many positions at once; nothing else of the segment is decoded."""
    out, at, live = np.zeros(len(positions), np.uint32), positions.astype(np.int64), np.arange(len(positions))
    for k, level in enumerate(levels):
        if not len(live):
            break
        chunks, more, ranks = np.frombuffer(level["chunks"], np.uint8), np.frombuffer(level["more"], np.uint8), np.frombuffer(level["ranks"], "<u4")
        out[live] |= chunks[at].astype(np.uint32) << np.uint32(8 * k)
        further = (more[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        at, live = at[further], live[further]
        block = at // RANK_BITS
        place = block[:, None] * (RANK_BITS // 8) + np.arange(RANK_BITS // 8)  # the bytes of the block
        bits = np.minimum(np.maximum(at[:, None] - 8 * place, 0), 8)           # how many bits of each lie before the position
        inside = more[np.minimum(place, len(more) - 1)] & ((1 << bits) - 1).astype(np.uint8)
        at = ranks[block].astype(np.int64) + np.bitwise_count(inside).sum(axis=1, dtype=np.int64)
    return out


def decode_levels(levels: list[dict[str, bytes]]) -> np.ndarray:
    """All ids of a segment."""
    below = np.zeros(0, np.uint32)
    for level in reversed(levels):
        chunk = np.frombuffer(level["chunks"], np.uint8).astype(np.uint32)
        more = np.unpackbits(np.frombuffer(level["more"], np.uint8), count=len(chunk), bitorder="little").astype(bool)
        chunk[more] |= below << np.uint32(8)
        below = chunk
    return below


def with_end(ids: np.ndarray, ends: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ids with the end id behind each, and where they begin."""
    lengths = np.diff(ends) + 1
    stop = np.cumsum(lengths)
    out = np.full(int(stop[-1]) if len(stop) else 0, end_id, np.int32)
    inside = np.ones(len(out), bool)
    inside[stop - 1] = False
    out[inside] = ids
    return out, np.concatenate([[0], stop])


def write_token_files(docs: DataFrame, folder: str, text: str = "text", key: str = "doc_id", path: str | None = None, end_id: int = 0) -> None:
    """Encodes every text, ends it with ``end_id`` and writes the ids in ascending ``key`` order, null keys first.

    Null texts are empty: their row holds the end id alone. Rows of one key stand side by side in the order of their
    text's hash; a key of very many rows may span files. Files are not compressed, so reading an id decodes no block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = path or default_path()
    salt = fresh([key, text], "_salt")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.select(F.col(f"`{key}`").cast("long").alias(key), f"`{text}`").withColumn(salt, F.xxhash64(text))
    ordered = ordered.repartitionByRange(parts, key, salt).sortWithinPartitions(key, salt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, before, part = pieces_of(path), 0, TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                ids, ends = with_end(*pieces.encode(*text_buffer(batch.column(1))), end_id)
                yield pa.RecordBatch.from_arrays([
                    pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                    pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([np.diff(ends)], pa.list_(pa.int32())),
                    pa.array([encode_levels(ids)], LEVELS)], names=["part", "before", "n_tokens", "keys", "lengths", "levels"])
                before += len(ids)

    ordered.mapInArrow(run, f"part int, before long, n_tokens long, keys array<long>, lengths array<int>, levels {_LEVEL_TYPE}").write.option("compression", "uncompressed").parquet(folder)


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of a file set with the position of their first id over all files."""
    segments = spark.read.schema(f"part int, before long, n_tokens long, keys array<long>, lengths array<int>, levels {_LEVEL_TYPE}").parquet(folder)
    # a row for each file, however many documents it holds
    totals = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    bases = totals.selectExpr("part as p", "sum(n) over (order by part rows between unbounded preceding and current row) - n as base")
    side = F.broadcast(bases) if totals.count() <= BASES_BROADCAST else bases
    return segments.join(side, F.col("part") == F.col("p")).withColumn("first", F.col("base") + F.col("before"))


def read_tokens(spark: SparkSession, folder: str, positions: DataFrame, position: str = "position") -> DataFrame:
    """(position, id) for each asked position that the file set holds, counted over all files from 0.

    Repeated positions give one row; null ones and those outside give none. The segment of a position is found by the
    segments' first positions, its id by ranks, so no segment is decoded. The positions of one segment, no more than it
    has ids, are one row.
    """
    asked = positions.select(F.col(f"`{position}`").cast("long").alias("position")).where("position is not null").distinct()
    segments = _segments(spark, folder)
    # segments and positions meet in cells of the position range; only the index takes part, not the levels
    index = segments.select("first", (F.col("first") + F.col("n_tokens")).alias("stop")).where("stop > first")
    index = index.withColumn("cell", F.explode(F.sequence(F.expr(f"first div {_CELL}"), F.expr(f"(stop - 1) div {_CELL}"))))
    found = asked.withColumn("cell", F.expr(f"position div {_CELL}")).join(index, "cell").where("position >= first and position < stop")
    grouped = found.groupBy(F.col("first").alias("f")).agg(F.collect_list(F.col("position") - F.col("first")).alias("asked"))
    side = F.broadcast(grouped) if asked.count() <= ASKED_BROADCAST else grouped
    rows = segments.select("first", "levels").join(side, F.col("first") == F.col("f")).select("first", "asked", "levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                at = np.array(row["asked"], np.int64)
                for begin in range(0, len(at), _SLICE):
                    some = at[begin:begin + _SLICE]
                    yield pa.RecordBatch.from_arrays([pa.array(row["first"] + some), pa.array(tokens_at(row["levels"], some).astype(np.int64))], names=["position", "id"])

    return rows.mapInArrow(run, "position long, id long")


def read_token_files(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """One row per document of a file set: key, start (ids before it), n_tokens, ids (little-endian unsigned 32-bit)."""
    placed = _segments(spark, folder).select("first", "keys", "lengths", "levels")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode_levels(row["levels"]).astype("<u4")
                lengths = np.array(row["lengths"], np.int64)
                ends = np.concatenate([[0], np.cumsum(lengths)])
                packed = pa.Array.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer((ends * 4).tobytes()), pa.py_buffer(ids.tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(row["keys"], pa.int64()), pa.array(row["first"] + ends[:-1]), pa.array(lengths), packed.cast(pa.binary())],
                                                 names=[key, "start", "n_tokens", "ids"])

    return placed.mapInArrow(run, f"`{key}` long, start long, n_tokens long, ids binary")
