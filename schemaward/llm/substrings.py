"""Substring dedup: removes every word covered by a window of consecutive words that occurs elsewhere too.

Each block of documents hashes all its windows with a rolling (Rabin-Karp) hash and sends each distinct hash once to
the bucket of its high bits; a bucket counts its hashes over all blocks and answers with one bit per hash, so a
passage of a third of all documents is one value per block and the answers are small. The second pass over the block
marks the repeated windows and merges them into maximal removal intervals.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import fresh, rolling_hashes, small_batches, span_hashes, text_buffer, word_spans

BLOCK_ROWS = 256           # documents of a block; small, so that blocks spread evenly over tasks
BUCKET_WINDOWS = 1 << 20   # windows a bucket should get
MAX_CROWDS = 1_000_000     # rows equal in all columns that are dealt over several blocks: at most so many kinds of them
ADDED = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
    T.StructField("removed", T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))),
    T.StructField("kept_text", T.StringType()),
])


def _distinct_windows(table: pa.Table, text: str, width: int):
    """(bytes, row offsets, word starts, ends, first word per row, window positions, inverse, counts, distinct hashes)"""
    data, offsets = text_buffer(table.column(text))
    starts, ends, first = word_spans(data, offsets)
    at, hashes = rolling_hashes(span_hashes(data, starts, ends), first, width)
    distinct, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    return data, offsets, starts, ends, first, at, inverse, counts, distinct


def _bounds(distinct: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket of the high bits begins among sorted hashes."""
    if bits == 0:
        return np.array([0, len(distinct)])
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.concatenate([[0], np.searchsorted(distinct, edges), [len(distinct)]])


def _pack(values: np.ndarray, drop: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : 8 - drop]).tobytes()


def _unpack(raw: bytes, drop: int) -> np.ndarray:
    got = np.frombuffer(raw, np.uint8).reshape(-1, 8 - drop)
    out = np.zeros((len(got), 8), np.uint8)
    out[:, : 8 - drop] = got
    return out.reshape(-1).view("<u8")


def _in_blocks(docs: DataFrame, text: str) -> tuple[DataFrame, str, int]:
    """``docs`` with the block of each row, the name of that column, and the length of all texts."""
    content = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in docs.columns if c != text], F.col(f"`{text}`"))
    kinds = docs.groupBy(content.alias("_content")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(f"`{text}`")).alias("size"))
    rows, size, most = kinds.agg(F.sum("n"), F.sum("size"), F.max("n")).first()
    blocks = max(1, -(-(rows or 0) // BLOCK_ROWS))
    block = fresh(docs.columns, "_block")
    # content, not position: rows land in the same block whenever they are read
    keyed = docs.withColumn(block, F.pmod(content, F.lit(blocks)))
    crowd = max(BLOCK_ROWS, (rows or 0) // MAX_CROWDS)
    if (most or 0) > crowd:
        # fewer than MAX_CROWDS kinds have more rows than this; any of their rows may go to any of their blocks, as they are equal
        own, share = fresh(docs.columns, "_content"), fresh(docs.columns, "_share")
        crowds = F.broadcast(kinds.where(F.col("n") > crowd).select(F.col("_content").alias(own), F.ceil(F.col("n") / BLOCK_ROWS).alias(share)))
        dealt = keyed.withColumn(own, content).join(crowds, own, "left")
        turn = F.pmod(F.monotonically_increasing_id(), F.col(share))
        keyed = dealt.withColumn(block, F.when(F.col(share).isNull(), F.col(f"`{block}`")).otherwise(F.pmod(F.xxhash64(own, turn), F.lit(blocks)))).select(*[f"`{c}`" for c in docs.columns], f"`{block}`")
    return keyed, block, size or 0


def remove_repeated_windows(docs: DataFrame, text: str = "text", width: int = 35) -> DataFrame:
    """The rows of ``docs`` with n_words, n_removed, removed (maximal word intervals, end exclusive) and kept_text.

    A window is ``width`` consecutive words of one row; a word goes if a window that covers it starts anywhere else in
    the input, in the same row too. All windows are judged on the input. kept_text joins the kept words by one space.
    Null and empty texts have no words and give an empty kept_text; rows shorter than a window lose nothing; repeated
    rows lose all words of their windows; other columns pass through (one of an added name is replaced). The block of a
    row depends on its content only, so a lost task repeats its work exactly; rows equal in all columns, where they are
    more than a block holds, are dealt over blocks by their place in the input, which should be a stored table. Windows are compared by 64-bit hashes: n
    windows hold a false match with a chance of about n * n / 2**65.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop(*[f.name for f in ADDED if f.name != text])
    keyed, block, size = _in_blocks(docs, text)
    bits = max(0, int(np.ceil(np.log2(max(1, size / 6 / BUCKET_WINDOWS)))))
    bits = max(bits, 8) if size > BUCKET_WINDOWS else bits
    drop = bits // 8  # whole bytes that the bucket already says

    def send(table: pa.Table) -> pa.Table:
        *_, distinct = _distinct_windows(table, text, width)
        edges = _bounds(distinct, bits)
        full = np.flatnonzero(np.diff(edges))
        return pa.table({"block": pa.array(np.full(len(full), table.column(block)[0].as_py(), np.int64)), "bucket": pa.array(full.astype(np.int64)),
                         "hashes": pa.array([_pack(distinct[edges[k]: edges[k + 1]], drop) for k in full], pa.binary())})

    def count(table: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_py(), drop) for x in table.column("hashes")]
        values = np.sort(np.concatenate(parts))
        twice = np.unique(values[1:][values[1:] == values[:-1]])
        out = []
        for b, part in zip(table.column("block").to_pylist(), parts, strict=True):
            if len(twice):
                near = np.minimum(np.searchsorted(twice, part), len(twice) - 1)
                hit = twice[near] == part
                if hit.any():
                    out.append((b, np.packbits(hit).tobytes()))
        k = table.column("bucket")[0].as_py()
        return pa.table({"block": pa.array([b for b, _ in out], pa.int64()), "bucket": pa.array([k] * len(out), pa.int64()),
                         "hit": pa.array([h for _, h in out], pa.binary())})

    schema = T.StructType(docs.schema.fields + ADDED.fields)
    names = docs.columns

    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        data, offsets, starts, ends, first, at, inverse, counts, distinct = _distinct_windows(table, text, width)
        repeated, edges = counts > 1, _bounds(distinct, bits)
        for k, raw in zip(answers.column("bucket").to_pylist(), answers.column("hit"), strict=True):
            n = edges[k + 1] - edges[k]
            repeated[edges[k]: edges[k + 1]] |= np.unpackbits(np.frombuffer(raw.as_py(), np.uint8), count=n).astype(bool)
        marked = at[repeated[inverse]]
        depth = np.zeros(len(starts) + 1, np.int64)
        np.add.at(depth, marked, 1)
        np.add.at(depth, marked + width, -1)
        covered = np.cumsum(depth)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(covered)])
        lost = removed[first[1:]] - removed[first[:-1]]
        raw, kept, spans = data.tobytes(), [], []
        for i in range(table.num_rows):
            words = raw[offsets[i]: offsets[i + 1]].split()
            if not lost[i]:
                spans.append([])
            else:
                here = covered[first[i]: first[i + 1]]
                edge = np.flatnonzero(np.diff(np.concatenate([[0], here.view(np.int8), [0]])))
                spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
                words = itertools.compress(words, ~here)
            kept.append(b" ".join(words))
        added = [pa.array(np.diff(first), pa.int64()), pa.array(lost, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.table([table.column(c) for c in names] + added, names=names + ADDED.names)

    answers = (keyed.groupBy(block).applyInArrow(send, "block long, bucket long, hashes binary")
               .groupBy("bucket").applyInArrow(count, "block long, bucket long, hit binary"))
    return keyed.groupBy(block).cogroup(answers.groupBy("block")).applyInArrow(cut, schema)
