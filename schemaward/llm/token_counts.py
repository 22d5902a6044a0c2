"""Token counts at every prefix of a text, by a prefix dynamic program over its pieces."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, small_batches, text_buffer
from schemaward.llm.bpe import default_path, pieces_of

ADDED = T.StructType([T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
                      T.StructField("step_bytes", T.IntegerType()), T.StructField("prefix_steps", T.BinaryType())])


def _steps(flat: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Differences of the counts, begun anew in each row."""
    out = np.diff(flat, prepend=0)
    begin = rows[:-1][np.diff(rows) > 0]
    out[begin] = flat[begin]
    return out


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with n_bytes (UTF-8), n_tokens, and the token count of every prefix.

    prefix_steps has one signed little-endian number of step_bytes bytes for each character: by how much the count of
    the prefix changes with it; the sum of the first k is the exact count of the first k characters encoded alone.
    Special tokens inside texts count as the library takes them by default. Null counts as empty: no steps, no tokens.
    Columns of an added name are replaced; others pass through.
    """
    small_batches(docs.sparkSession)
    path = path or default_path()
    keep = [c for c in docs.columns if c.lower() not in {f.name for f in ADDED}]
    schema = T.StructType([docs.schema[c] for c in keep] + ADDED.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, True)
        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
            steps, ends, totals = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(0, np.int64)]
            for i, j in chunks(offsets):
                flat, rows = pieces.count_prefixes(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
                steps.append(_steps(flat, rows).astype(np.int32))
                ends.append(ends[-1][-1] + rows[1:])
                totals.append(np.where(np.diff(rows) > 0, flat[np.maximum(rows[1:] - 1, 0)] if len(flat) else 0, 0))
            steps, ends = np.concatenate(steps), np.concatenate(ends)
            width = 1 if not len(steps) or (steps.min() >= -128 and steps.max() < 128) else 4
            raw = steps.astype("<i1" if width == 1 else "<i4").tobytes()
            packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((ends * width).astype(np.int64).tobytes()), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in keep]
                + [pa.array(np.diff(offsets), pa.int64()), pa.array(np.concatenate(totals), pa.int64()), pa.array(np.full(batch.num_rows, width, np.int32)), packed.cast(pa.binary())],
                names=[*keep, *ADDED.names])

    return docs.select(*[f"`{c}`" for c in keep]).mapInArrow(run, schema)


def longest_prefix(budget: int, step_bytes: str = "step_bytes", prefix_steps: str = "prefix_steps") -> Column:
    """How many characters the longest prefix of at most ``budget`` tokens has; reads the counts, encodes nothing."""
    @F.pandas_udf(T.LongType())
    def longest(width: pd.Series, steps: pd.Series) -> pd.Series:
        def one(w, raw):
            fits = np.flatnonzero(np.cumsum(np.frombuffer(raw, f"<i{w}"), dtype=np.int64) <= budget)
            return int(fits[-1]) + 1 if len(fits) else 0
        return pd.Series([one(w, r) for w, r in zip(width, steps, strict=True)], dtype="int64")
    return longest(F.col(step_bytes), F.col(prefix_steps))
