"""Helpers shared by the operators that work on Arrow batches: word spans, hashes, chunks, shared scratch tables.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D. Hashes are polynomial prefix sums modulo 2**64 over
random values, so every span of a buffer costs one subtraction and one product; a bijective mixer spreads the bits.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

CHUNK_BYTES = 1 << 20
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            up, down = np.full(size, self.base, np.uint64), np.full(size, self.inverse, np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_POWERS = _Powers(_BASE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def chunks(sizes_end: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    i, n = 0, len(sizes_end) - 1
    while i < n:
        j = int(np.searchsorted(sizes_end, sizes_end[i] + limit, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j
        i = j


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the number of its first word (one more entry at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    white = _WHITE[data]
    before, after = np.empty_like(white), np.empty_like(white)
    before[0], before[1:] = True, white[:-1]
    after[-1], after[:-1] = True, white[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    word = ~white
    starts, ends = np.flatnonzero(word & before), np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, over pieces of about CHUNK_BYTES so that long buffers need no more memory."""
    out, i, n = np.empty(len(starts), np.uint64), 0, len(starts)
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + CHUNK_BYTES, "right")))
        lo, hi = int(starts[i]), int(ends[j - 1])
        up, down = _POWERS.get(hi - lo)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data[lo:hi]] * up, out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def rolling_hashes(values: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rabin-Karp hashes of all ``width`` consecutive values inside each row: (index of the first value, hash)."""
    n = len(values)
    counts = np.maximum(np.diff(first) - width + 1, 0)
    at = spread(first[:-1], counts)
    if not len(at):
        return at, np.zeros(0, np.uint64)
    up, down = _POWERS.get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return at, mix((sums[at + width] - sums[at]) * down[at])


def spread(start: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start[0], start[0]+1, .. (counts[0] values), start[1], .. as one array."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(start - (ends - counts), counts)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``; only a local session without that setting gets a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000, size: str = "8m") -> None:
    """Bounds the Arrow batches sent to Python by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)


def fresh(columns: list[str], wanted: str) -> str:
    """A working column name that no column of the input has, whatever its case."""
    taken = {c.lower() for c in columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted
