"""Cross-tokenizer alignment: tokens of a byte-level BPE (A) and a SentencePiece model (B) over the same bytes.

All documents of a chunk advance together: one state vector holds an A pointer and a B pointer for each, every step emits
one link per document and, where both tokens end at one byte, a cut, and finished documents leave the vector. Long
documents enter as several lanes that begin at common cuts, so the number of steps is bounded by the lane, not by the
longest document. What tasks learn of the whole corpus (in how many documents a pair of ids is linked) travels once per
block of documents and id pair, in both directions.
"""

from __future__ import annotations

import functools
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, fresh, small_batches, spread, store, text_buffer
from schemaward.llm.bpe import Pieces, _byte_letters, default_path

LANE = 256   # A tokens after which a document is cut into a further lane, at the next common end
PROBE = 32   # A tokens that are looked at for it at a time
ADDED = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


class _PlainPieces(Pieces):
    """Special strings inside texts are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special, self._special = {}, None
        back = {c: b for b, c in _byte_letters().items()}
        entries = [b""] * self.tokenizer.get_vocab_size()
        for token, i in self.tokenizer.get_vocab().items():
            entries[i] = bytes(back.get(c, 0) for c in token)
        self.entries = _Entries(entries)


class _Entries:
    """The bytes of every token of a vocabulary in one buffer."""

    def __init__(self, entries: list[bytes]):
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[spread(self.starts[ids], self.sizes[ids])]


class _SentencePieces:
    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        self.entries = _Entries([
            bytes([int(self.model.id_to_piece(i)[3:5], 16)]) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = self.model.encode(texts, num_threads=1) if texts else []
        sizes = np.array([len(x) for x in got], np.int64)
        return np.fromiter((i for x in got for i in x), np.int32, int(sizes.sum())), np.concatenate([[0], np.cumsum(sizes)])


@functools.cache
def _encoders(path_a: str, path_b: str) -> tuple[_PlainPieces, _SentencePieces]:
    """One pair of encoders per Python worker."""
    return _PlainPieces(path_a), _SentencePieces(path_b)


def _lanes(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first A, stop A, first B, stop B) of lanes; ``ends`` are byte ends that grow over all documents."""
    doc, at = [np.arange(len(first_a) - 1)], [first_a[:-1]]
    long = np.flatnonzero(np.diff(first_a) > LANE)
    for d in long.tolist():
        a = int(first_a[d])
        while (a := a + LANE) < first_a[d + 1]:
            while a < first_a[d + 1]:  # the next A token that ends with a B token
                some = ends_a[a: min(a + PROBE, int(first_a[d + 1]))]
                hits = np.flatnonzero(ends_b[np.searchsorted(ends_b, some)] == some)
                if len(hits):
                    a += int(hits[0]) + 1
                    break
                a += PROBE
            if a < first_a[d + 1]:
                doc.append(np.array([d]))
                at.append(np.array([a]))
    doc, a = np.concatenate(doc), np.concatenate(at)
    order = np.lexsort((a, doc))
    doc, a = doc[order], a[order]
    inner = a > first_a[doc]
    b = first_b[doc].copy()
    b[inner] = np.searchsorted(ends_b, ends_a[a[inner] - 1]) + 1
    last = np.append(doc[1:] != doc[:-1], True)
    return doc, a, np.where(last, first_a[doc + 1], np.append(a[1:], 0)), b, np.where(last, first_b[doc + 1], np.append(b[1:], 0))


def align(ends_a: np.ndarray, first_a: np.ndarray, ends_b: np.ndarray, first_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links (A token, B token) and cuts (number of A tokens, of B tokens up to it), both in text order.

    ``ends``: the last byte + 1 of every token, counted over all documents, which cover the same bytes on both sides.
    """
    doc, pa_, stop_a, pb, stop_b = _lanes(ends_a, first_a, ends_b, first_b)
    room = (stop_a - pa_) + (stop_b - pb)
    base = np.cumsum(room) - room
    link_a, link_b = np.full(int(room.sum()), -1, np.int64), np.empty(int(room.sum()), np.int64)
    cut = np.zeros(len(link_a), bool)
    live = (pa_ < stop_a) & (pb < stop_b)
    a, b, stop_a, stop_b, out = pa_[live], pb[live], stop_a[live], stop_b[live], base[live]
    while len(a):
        link_a[out], link_b[out] = a, b
        x, y = ends_a[a], ends_b[b]
        cut[out] = x == y
        a, b, out = a + (x <= y), b + (y <= x), out + 1
        done = (a >= stop_a) | (b >= stop_b)
        if done.any():
            go = ~done
            a, b, stop_a, stop_b, out = a[go], b[go], stop_a[go], stop_b[go], out[go]
    used = link_a >= 0
    link_a, link_b, cut = link_a[used], link_b[used], cut[used]
    return link_a, link_b, link_a[cut] + 1, link_b[cut] + 1


def _listing(ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2;`` over all groups, and where each group begins (one more entry)."""
    size_a, size_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    group_a, group_b = np.repeat(np.arange(len(cut_a)), size_a), np.repeat(np.arange(len(cut_b)), size_b)
    place_a = np.arange(len(ids_a)) + (cut_b - size_b)[group_a]
    place_b = np.arange(len(ids_b)) + cut_a[group_b]
    ids, after = np.empty(len(ids_a) + len(ids_b), np.int64), np.full(len(ids_a) + len(ids_b), ord(","), np.uint8)
    ids[place_a], ids[place_b] = ids_a, ids_b
    after[place_a[cut_a - 1]], after[place_b[cut_b - 1]] = ord("|"), ord(";")
    digits = np.maximum(np.ceil(np.log10(ids + 1)).astype(np.int64), 1)
    digits += (10 ** digits <= ids) * 1 - ((digits > 1) & (10 ** (digits - 1) > ids)) * 1
    close = np.cumsum(digits + 1)
    out = np.empty(int(close[-1]) if len(close) else 0, np.uint8)
    out[close - 1] = after
    for k in range(int(digits.max(initial=0))):
        some = digits > k
        out[close[some] - 2 - k] = ids[some] // 10 ** k % 10 + 48
    begin = np.append(0, close)[np.append((cut_a - size_a) + (cut_b - size_b), len(ids))]
    return out, begin


def _aligned(data: np.ndarray, offsets: np.ndarray, path_a: str, path_b: str) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
    """For all rows of a chunk: [n_a, n_b, n_groups, n_links] and digests; the link id pairs with their row."""
    enc_a, enc_b = _encoders(path_a, path_b)
    n, sizes = len(offsets) - 1, np.diff(offsets)
    there = sizes > 0
    spaced = np.concatenate([[0], np.cumsum(sizes + there)])
    flat = np.full(int(spaced[-1]), 0x20, np.uint8)
    flat[spread(spaced[:-1] + there, sizes)] = data
    ids_a, first_a = enc_a.encode(flat, spaced)
    raw = data.tobytes()
    ids_b, first_b = enc_b.encode([raw[x:y].decode() for x, y in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
    # rows whose joined bytes differ on a side have no tokens
    good = there
    for entries, ids, first in ((enc_a.entries, ids_a, first_a), (enc_b.entries, ids_b, first_b)):
        total = np.concatenate([[0], np.cumsum(entries.sizes[ids])])
        same = np.diff(total[first]) == np.diff(spaced)
        rows = np.flatnonzero(same & good)
        joined = entries.joined(ids[spread(first[:-1][rows], np.diff(first)[rows])])
        wrong = np.concatenate([[0], np.cumsum(joined != flat[spread(spaced[:-1][rows], np.diff(spaced)[rows])])])
        edge = np.concatenate([[0], np.cumsum(np.diff(spaced)[rows])])
        same[rows] = np.diff(wrong[edge]) == 0
        good = good & same
    count_a, count_b = np.diff(first_a) * good, np.diff(first_b) * good
    ids_a, ids_b = ids_a[spread(first_a[:-1], count_a)], ids_b[spread(first_b[:-1], count_b)]
    first_a, first_b = np.concatenate([[0], np.cumsum(count_a)]), np.concatenate([[0], np.cumsum(count_b)])
    link_a, link_b, cut_a, cut_b = align(np.cumsum(enc_a.entries.sizes[ids_a]), first_a, np.cumsum(enc_b.entries.sizes[ids_b]), first_b)
    listing, begin = _listing(ids_a, ids_b, cut_a, cut_b)
    groups = np.searchsorted(cut_a, first_a, "right")
    text = listing.tobytes()
    edges = begin[groups]
    digests = [hashlib.sha256(text[x: y - 1]).hexdigest() if y > x else "" for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    row = np.searchsorted(first_a, link_a, "right") - 1
    pairs = ids_a[link_a].astype(np.int64) << 32 | ids_b[link_b].astype(np.int64)
    return [count_a, count_b, np.diff(groups), np.bincount(row, minlength=n)], digests, row, pairs


def _linked(docs: DataFrame, text: str, keep: list[str], names: list[str], path_a: str, path_b: str) -> DataFrame:
    """``keep`` and, under ``names``: block, a row number in it, the counts, the digest, the document's distinct id pairs
    as places in the block's list, how often each is linked there; rows without a number carry a block's list instead."""
    kinds = [T.StringType(), T.IntegerType(), *[T.LongType()] * 4, T.StringType(), T.ArrayType(T.IntegerType()), T.ArrayType(T.IntegerType()), T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in zip(names, kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
            counts, digests, many, values, times = [], [], [], [], []
            for i, j in chunks(offsets):
                numbers, shas, row, pairs = _aligned(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], path_a, path_b)
                order = np.lexsort((pairs, row))
                row, pairs = row[order], pairs[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (pairs[1:] != pairs[:-1])
                at = np.flatnonzero(new)
                counts.append(np.array(numbers))
                digests += shas
                many.append(np.bincount(row[at], minlength=j - i))
                values.append(pairs[at])
                times.append(np.diff(np.append(at, len(row))))
            distinct, where, held = np.unique(np.concatenate(values), return_inverse=True, return_counts=True)
            numbers, close = np.concatenate(counts, axis=1), np.concatenate([[0], np.cumsum(np.concatenate(many))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(close), pa.array(v.astype(np.int32))) for v in (where, np.concatenate(times))]
            n, block = batch.num_rows, uuid.uuid4().hex  # the table is written before it is used, so one attempt's name stays
            nothing = [pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [
                pa.array([block] * n), pa.array(np.arange(n), pa.int32()), *[pa.array(x, pa.int64()) for x in numbers], pa.array(digests, pa.string()), *lists, *nothing], names=schema.names)
            if len(distinct):
                wide = [pa.array([distinct], pa.list_(pa.int64())), pa.array([held.astype(np.int32)], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.nulls(1, batch.column(batch.schema.get_field_index(c)).type) for c in keep] + [
                    pa.array([block]), pa.nulls(1, pa.int32()), *[pa.nulls(1, pa.int64())] * 4, pa.nulls(1, pa.string()), *[pa.nulls(1, pa.list_(pa.int32()))] * 2, *wide], names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def align_documents(docs: DataFrame, text: str = "text", path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``docs`` without its text, with the columns of ADDED.

    n_a, n_b tokens; n_groups byte ranges between common token ends; n_links pairs of overlapping tokens; n_best links
    whose id pair stands linked in as many documents of the whole table as any pair of its A id; count_sum the sum of
    these document counts over the links; groups_sha256 of the groups' ids. A encodes a space and the text, B adds the
    space itself. Null and empty texts, and texts that a side does not give back byte by byte, have zeros and ''.
    Repeated rows are documents of their own; columns of an added name are replaced, others pass through.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), *ADDED)]
    working = ["block", "row", "links", "times", "pairs", "held"]
    names = {w: fresh([*keep, *ADDED], f"_{w}") for w in working}
    block, row = names["block"], names["row"]
    marked = store(_linked(docs, text, keep, [block, row, "n_a", "n_b", "n_groups", "n_links", "groups_sha256", names["links"], names["times"], names["pairs"], names["held"]],
                           path_a or default_path(), path_b or default_path("piece_bpe_32k.model")), "aligned")
    blocks = marked.where(F.col(row).isNull()).select(F.col(block).alias("block"), F.posexplode(F.arrays_zip(F.col(names["pairs"]).alias("pair"), F.col(names["held"]).alias("held"))).alias("at", "p"))
    blocks = blocks.select("block", "at", "p.pair", "p.held")
    # one row per block and pair; a pair of every document is one row per block
    totals = store(blocks.groupBy("pair").agg(F.sum("held").alias("docs")), "pairs")
    most = totals.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("docs").alias("most"))
    judged = totals.join(most.hint("merge"), F.shiftright("pair", 32) == F.col("a")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
    back = blocks.select("block", "at", "pair").join(judged.hint("merge"), "pair").select("block", "at", "docs", "best")
    rows = marked.where(F.col(row).isNotNull()).drop(names["pairs"], names["held"])
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.StringType() if c == "groups_sha256" else T.LongType()) for c in ADDED])

    def sums(left: pa.Table, right: pa.Table) -> pa.Table:
        docs_of, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        at = right.column("at").to_numpy()
        docs_of[at], best[at] = right.column("docs").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        lists = left.column(names["links"]).combine_chunks()
        links, times = lists.flatten().to_numpy(), left.column(names["times"]).combine_chunks().flatten().to_numpy().astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        made = {}
        for name, value in (("n_best", best), ("count_sum", docs_of)):
            total = np.concatenate([[0], np.cumsum(value[links] * times)])
            made[name] = pa.array(total[edge[1:]] - total[edge[:-1]], pa.int64())
        return pa.Table.from_arrays([made[c] if c in made else left.column(c) for c in schema.names], names=schema.names)

    return rows.groupBy(block).cogroup(back.groupBy("block")).applyInArrow(sums, schema)
