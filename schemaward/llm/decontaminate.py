"""Benchmark decontamination by latent semantic retrieval.

Documents become word numbers in the benchmark's vocabulary (other words are gaps), stored once. Fixed passages of all
documents are weighted by TF-IDF; a randomised SVD, its products summed over all tasks, gives a latent space in which
sliding passages of each document are compared with every benchmark item by cosine. What comes near an item is checked
word by word: the longest common subsequence with the item, and for paraphrases the item's answer.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, fresh, small_batches, span_hashes, spread, store, text_buffer

RANK = 64            # dimensions of the latent space
PASSAGE = 32         # words of the fixed passages that the space is learnt from
COSINE = 0.3         # a sliding passage this near an item is compared word by word; at 0.55 a quarter of the paraphrases of share 0.6 is lost
COPIED = 0.8         # share of an item's words, in order, that makes a copy
PARAPHRASED = 0.6    # share that makes a paraphrase if the answer stands there too
ANSWER = 5           # last words of an item that count as its answer
ITEMS = 4_000        # items searched in one pass; a larger benchmark takes several
SLICE = 1 << 15      # words handled at once
MATCH = T.StructType([T.StructField(n, t()) for n, t in (("item_id", T.LongType), ("start", T.LongType), ("n_matched", T.LongType), ("item_words", T.LongType),
                                                        ("lcs_share", T.DoubleType), ("cosine", T.DoubleType), ("answer", T.BooleanType))])
_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123)]] = True
# scripts written without blanks between words: Thai, Lao, Myanmar, Khmer, kana, Han
_UNSPACED = [(0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]


@functools.cache
def _kinds() -> np.ndarray:
    """Kind of every code point: 1 letters, numbers and their marks, 2 those of scripts without blanks, each a word, 0 others."""
    out = np.array([unicodedata.category(chr(c))[0] in "LNM" for c in range(0x110000)], np.uint8)
    for a, b in _UNSPACED:
        out[a: b + 1] *= 2
    return out


def _word_edges(piece: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of every word of a chunk; a word never crosses rows."""
    lead, rows, single = None, off, None
    if len(piece) and piece.max() >= 128:  # by characters, then back to bytes
        lead = np.append(np.flatnonzero((piece & 0xC0) != 0x80), len(piece))
        kind = _kinds()[np.frombuffer(piece.tobytes().decode().encode("utf-32-le"), np.uint32)]
        rows, inner, single = np.searchsorted(lead, off), kind > 0, kind == 2
    else:
        inner = _WORD[piece]
    word, cut = np.zeros(len(inner) + 2, bool), np.zeros(len(inner) + 1, bool)
    word[1:-1], cut[rows] = inner, True
    if single is not None:
        cut[:-1] |= single
        cut[1:] |= single
    starts = np.flatnonzero(word[1:-1] & (~word[:-2] | cut[:-1]))
    stops = np.flatnonzero(word[1:-1] & (~word[2:] | cut[1:])) + 1
    return (starts, stops) if lead is None else (lead[starts], lead[stops])


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row (runs of letters and digits, lower case) and where each row's begin."""
    data, offsets = text_buffer(pc.utf8_lower(column.cast(pa.large_string())))
    parts, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for i, j in chunks(offsets):
        piece, off = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        starts, stops = _word_edges(piece, off)
        parts.append(span_hashes(piece, starts, stops))
        ends.append(ends[-1][-1] + np.searchsorted(starts, off[1:]))
    return np.concatenate(parts), np.concatenate(ends)


class Items:
    """A block of benchmark items as word numbers of their own vocabulary; ``copies`` says how often each is given."""

    def __init__(self, ids: list[int], texts: list[str], copies: list[int] | None = None):
        hashes, ends = _words(pa.array(texts, pa.string()))
        self.vocabulary, numbers = np.unique(hashes, return_inverse=True)
        keep = np.flatnonzero(np.diff(ends) > 0)  # an item without words is nowhere
        self.ids = [ids[k] for k in keep]
        self.copies = [1 if copies is None else copies[k] for k in keep]
        self.words = [numbers[ends[k]: ends[k + 1]] for k in keep]

    def number(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1).astype(np.int32)


def _numbered(docs: DataFrame, items: Items, text: str) -> DataFrame:
    """``docs`` without its text, and last the numbers of all its words as little-endian 32-bit, -1 for a gap."""
    keep = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(fresh(docs.columns, "words"), T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, ends = _words(batch.column(batch.schema.get_field_index(text)))
            packed = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer((ends * 4).astype(np.int64).tobytes()), pa.py_buffer(items.number(hashes).astype("<i4").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [packed.cast(pa.binary())], names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def _passages(column) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Words and passage of each word (gaps left out), and the number of passages, for pieces of a batch."""
    raw, ends = _numbers_of(column)
    for i, j in chunks(ends, SLICE * 16):
        words = raw[ends[i]: ends[j]]
        sizes = np.diff(ends[i: j + 1])
        passages = -(-sizes // PASSAGE)
        within = spread(np.zeros(len(sizes), np.int64), sizes)
        passage = np.repeat(np.cumsum(passages) - passages, sizes) + within // PASSAGE
        known = words >= 0
        yield words[known].astype(np.int64), passage[known], int(passages.sum())


def _numbers_of(column) -> tuple[np.ndarray, np.ndarray]:
    """32-bit numbers and row offsets of a binary column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset: column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0]: off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return np.frombuffer(raw.tobytes(), "<i4"), (off - off[0]) // 4


def _summed(numbered: DataFrame, size: int, add) -> np.ndarray:
    """The sum over all rows of the float64 vectors of ``size`` numbers that ``add(total, column)`` adds up.

    Each task sends its sum in 32 parts; a part is added up over all tasks in one place, and only the sums of fixed
    size reach the driver.
    """
    edges = np.linspace(0, size, 33).astype(int)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(size), False
        for batch in batches:
            add(total, batch.column(0))
            some = some or batch.num_rows > 0
        if some:
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(32), pa.int32()), "value": pa.array([total[a:b].tobytes() for a, b in zip(edges, edges[1:], strict=False)], pa.binary())})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = np.frombuffer(v.as_py())
                sums[k] = sums[k] + got if k in sums else got
        yield pa.RecordBatch.from_pydict({"part": pa.array(sums.keys(), pa.int32()), "value": pa.array([v.tobytes() for v in sums.values()], pa.binary())})

    shape = "part int, value binary"
    out = numbered.select(f"`{numbered.columns[-1]}`").mapInArrow(task, shape).repartition("part").mapInArrow(merge, shape).collect()  # 32 rows in all
    total = np.zeros(size)
    for r in out:
        total[edges[r["part"]]: edges[r["part"] + 1]] += np.frombuffer(r["value"])
    return total


def _weighted(words: np.ndarray, passage: np.ndarray, n: int, idf: np.ndarray) -> np.ndarray:
    """TF-IDF weight of each word occurrence, scaled so that passages of any length count alike."""
    weights = idf[words]
    return weights / np.sqrt(np.maximum(np.bincount(passage, weights * weights, n), 1e-30))[passage]


def latent_space(numbered: DataFrame, vocabulary: int, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """Latent coordinates of each word: idf times its row of the right singular vectors, over all passages.

    Three rounds over all documents: passage counts of the words; the product of the TF-IDF matrix's Gram with a random
    block, whose orthonormal basis spans the leading singular vectors; and the small Gram inside that basis, whose
    eigenvectors are rotated back. Every round sums blocks of fixed size.
    """
    def frequencies(total, column):
        for words, passage, n in _passages(column):
            pair = np.unique(passage * vocabulary + words)
            total[:vocabulary] += np.bincount(pair % vocabulary, minlength=vocabulary)
            total[vocabulary] += n

    counts = _summed(numbered, vocabulary + 1, frequencies)
    idf = np.log((counts[-1] + 1) / (counts[:-1] + 1)) + 1e-3
    rank = min(rank, vocabulary)
    start = np.random.default_rng(seed).standard_normal((vocabulary, rank))

    def project(words, passage, n, weights, basis):
        out = np.empty((n, basis.shape[1]))
        for c in range(basis.shape[1]):
            out[:, c] = np.bincount(passage, weights * basis[words, c], n)
        return out

    def power(total, column):
        block = total.reshape(vocabulary, rank)
        for words, passage, n in _passages(column):
            if len(words):
                weights = _weighted(words, passage, n, idf)
                near = project(words, passage, n, weights, start)
                for c in range(rank):
                    block[:, c] += np.bincount(words, weights * near[passage, c], vocabulary)

    basis, _ = np.linalg.qr(_summed(numbered, vocabulary * rank, power).reshape(vocabulary, rank))

    def gram(total, column):
        for words, passage, n in _passages(column):
            if len(words):
                near = project(words, passage, n, _weighted(words, passage, n, idf), basis)
                total += (near.T @ near).ravel()

    values, vectors = np.linalg.eigh(_summed(numbered, rank * rank, gram).reshape(rank, rank))
    # every direction counts alike: the common words of the language fill the first ones and would make all passages near
    scale = np.where(values > values.max(initial=0) * 1e-9, 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return idf[:, None] * (basis @ (vectors * scale)) * np.sqrt(max(counts[-1], 1))


def lcs(item: np.ndarray, words: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    masks: dict[int, int] = {}
    for k, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << k
    full = (1 << len(item)) - 1
    state = full
    for w in words.tolist():
        hit = state & masks.get(w, 0)
        state = ((state + hit) | (state - hit)) & full
    return len(item) - state.bit_count()


def lcs_many(items: list[np.ndarray], windows: list[np.ndarray]) -> np.ndarray:
    """``lcs`` of many pairs at once; items of up to 64 words advance together, one 64-bit state each."""
    out = np.zeros(len(items), np.int64)
    short = [k for k, x in enumerate(items) if len(x) <= 64]
    for k in range(0, len(short), 4096):
        part = short[k: k + 4096]
        left, right = np.full((len(part), 64), -3, np.int32), np.full((len(part), max(len(windows[p]) for p in part)), -2, np.int32)
        for n, p in enumerate(part):
            left[n, : len(items[p])], right[n, : len(windows[p])] = items[p], windows[p]
        state = np.full(len(part), ~np.uint64(0))
        for t in range(right.shape[1]):
            hit = state & np.packbits(left == right[:, t: t + 1], axis=1, bitorder="little").view("<u8")[:, 0]
            state = (state + hit) | (state - hit)
        out[part] = 64 - np.bitwise_count(state).astype(np.int64)
    for k, x in enumerate(items):
        if len(x) > 64:
            out[k] = lcs(x, windows[k])
    return out


def _window(n_words: int) -> int:
    """Length of the sliding passages for an item: the next of 8, 12, 16, 24, 32, 48, .. words."""
    size = 8
    while size < n_words:
        size = size * 3 // 2 if size & (size - 1) == 0 else size // 3 * 4
    return size


class Searcher:
    """Compares all sliding passages of documents with the items."""

    def __init__(self, items: Items, space: np.ndarray):
        self.items, self.space = items, np.vstack([space, np.zeros((1, space.shape[1]))]).astype(np.float32)  # the last row is a gap's
        self.scales: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        latent = np.array([self.space[w].sum(axis=0) for w in items.words]).reshape(len(items.words), space.shape[1])
        norms = np.linalg.norm(latent, axis=1)
        latent /= np.maximum(norms, 1e-30)[:, None]
        by: dict[int, list[int]] = {}
        for k, w in enumerate(items.words):
            by.setdefault(_window(len(w)), []).append(k)
        self.scales = {size: (np.array(ks), latent[ks].astype(np.float32)) for size, ks in by.items()}
        self.most = max(by, default=8)
        # which words stand in which item, a bit each; the last row is a gap's
        held = np.zeros((len(self.space), len(items.words)), bool)
        for k, w in enumerate(items.words):
            held[w, k] = True
        self.held = np.packbits(held, axis=1, bitorder="little")
        self.lengths = np.array([len(w) for w in items.words], np.int64)
        self.answers = np.array([np.resize(w[-ANSWER:], ANSWER) for w in items.words], np.int64).reshape(len(items.words), ANSWER)

    def _near(self, words: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """(row, item, first word, end word, cosine) of the sliding passages near an item, as columns."""
        sums = np.zeros((len(words) + 1, self.space.shape[1]), np.float32)
        np.cumsum(self.space[words], axis=0, out=sums[1:])
        sizes, found = np.diff(ends), [np.zeros((5, 0))]
        for size, (items, latent) in self.scales.items():
            slack = np.maximum(sizes - size, 0)
            stride = size // 3
            many = np.where(sizes > 0, -(-slack // stride) + 1, 0)
            row = np.repeat(np.arange(len(sizes)), many)
            first = ends[:-1][row] + np.minimum(spread(np.zeros(len(sizes), np.int64), many) * stride, slack[row])
            stop = np.minimum(first + size, ends[1:][row])
            for a in range(0, len(first), 1 << 14):
                here = slice(a, a + (1 << 14))
                vectors = sums[stop[here]] - sums[first[here]]
                vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
                cosine = vectors @ latent.T
                p, k = np.nonzero(cosine >= COSINE)
                found.append(np.array([row[a + p], items[k], first[a + p], stop[a + p], cosine[p, k]], np.float64))
        return np.concatenate(found, axis=1)

    def _possible(self, words: np.ndarray, item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which candidates can be leaks at all: the words of the passage that stand in the item bound the common
        subsequence from above, and a paraphrase needs every word of the answer."""
        out, width, held = [], self.held.shape[1], self.held.ravel()
        for k in range(0, len(item), 1 << 14):
            i, lo, sizes = item[k: k + (1 << 14)], a[k: k + (1 << 14)], (b - a)[k: k + (1 << 14)]
            w, begin = words[spread(lo, sizes)], np.cumsum(sizes) - sizes
            inside = held[w * np.int64(width) + np.repeat(i >> 3, sizes)] >> np.repeat((i & 7).astype(np.uint8), sizes) & 1
            bound = np.add.reduceat(inside, begin, dtype=np.int64)
            some = np.flatnonzero(bound >= PARAPHRASED * self.lengths[i] - 1e-9)
            weak = some[bound[some] < COPIED * self.lengths[i[some]] - 1e-9]
            if len(weak):
                many = sizes[weak]
                w, first = w[spread(begin[weak], many)], np.cumsum(many) - many
                whole = np.ones(len(weak), bool)
                for answer in self.answers[i[weak]].T:
                    whole &= np.logical_or.reduceat(w == np.repeat(answer, many), first)
                some = np.setdiff1d(some, weak[~whole])
            out.append(k + some)
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def search(self, words: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple]:
        """(row, item) -> best match (start, matched words, item words, share, cosine, answer) that makes a leak."""
        near = self._near(words, ends)
        row, item, a, b = near[:4].astype(np.int64)
        pad = (b - a) // 4
        a, b = np.maximum(ends[row], a - pad), np.minimum(ends[row + 1], b + pad)
        left = self._possible(words, item, a, b)
        row, item, a, b, cosine = row[left], item[left], a[left], b[left], near[4, left]
        wanted = [self.items.words[k] for k in item]
        common = lcs_many(wanted, [words[x:y] for x, y in zip(a, b, strict=True)])
        share = common / np.array([len(w) for w in wanted]).clip(1)
        out: dict[tuple[int, int], tuple] = {}
        for k in np.flatnonzero(share >= PARAPHRASED):
            tail, key = wanted[k][-ANSWER:], (int(row[k]), int(item[k]))
            if share[k] < COPIED and key in out and common[k] <= out[key][1]:
                continue
            answer = lcs(tail, words[a[k]: b[k]]) == len(tail)
            if (share[k] >= COPIED or answer) and (key not in out or common[k] > out[key][1]):
                out[key] = (int(a[k] - ends[row[k]]), int(common[k]), len(wanted[k]), float(share[k]), float(cosine[k]), answer)
        return out

    def matches(self, numbers: np.ndarray, ends: np.ndarray) -> dict[tuple[int, int], tuple]:
        """``search`` over all rows of a batch, very long ones in overlapping slices."""
        out: dict[tuple[int, int], tuple] = {}
        for i, j in chunks(ends, SLICE):
            if ends[j] - ends[i] <= 2 * SLICE:
                pieces = [(numbers[ends[i]: ends[j]], ends[i: j + 1] - ends[i], 0)]
            else:
                size = SLICE + 2 * self.most
                cuts = [(a, min(a + size, int(ends[j]))) for a in range(int(ends[i]), int(ends[j]), SLICE)]
                pieces = [(numbers[a:b], np.array([0, b - a]), a - int(ends[i])) for a, b in cuts]
            for words, cut, base in pieces:
                for (row, item), m in self.search(words, cut).items():
                    key = (i + row, item)
                    if key not in out or m[1] > out[key][1]:
                        out[key] = (m[0] + base, *m[1:])
        return out


def _searchers(source: DataFrame, benchmark: DataFrame, text: str) -> Iterator[tuple[DataFrame, Searcher]]:
    """For each block of at most about ITEMS items: the documents as word numbers, and what searches them.

    Whatever the benchmark's size, a block of it fits a task; an item that is given many times is one row of it.
    """
    once = store(benchmark.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("copies")), "items")
    blocks = max(1, -(-once.count() // ITEMS))
    for k in range(blocks):
        mine = once.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        items = Items([r["item_id"] for r in mine], [r["text"] or "" for r in mine], [r["copies"] for r in mine])
        numbered = store(_numbered(source, items, text), "numbered")
        yield numbered, Searcher(items, latent_space(numbered, max(1, len(items.vocabulary))))


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, one row per document and benchmark item that it holds, with the columns of MATCH.

    start is where, in words (runs of letters and digits, lower-cased), the passage around the match begins; n_matched
    words of the item stand there in order, lcs_share of all; a match is a copy (share of COPIED or more) or a
    paraphrase (share of PARAPHRASED or more, and the item's last ANSWER words in order). Null and empty texts and
    items match nothing; repeated rows match alike; an item id given twice is two items; columns of an added name are
    replaced, others pass through.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c != text and c.lower() not in {f.name for f in MATCH.fields}]
    source = docs.select(*[f"`{c}`" for c in keep], f"`{text}`")
    schema = T.StructType([docs.schema[c] for c in keep] + MATCH.fields)
    kinds = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.bool_()]
    out = None
    for numbered, searcher in _searchers(source, benchmark, text):

        def run(batches: Iterator[pa.RecordBatch], searcher: Searcher = searcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = searcher.matches(*_numbers_of(batch.column(batch.num_columns - 1)))
                if found:
                    rows = [(row, searcher.items.ids[item], *m) for (row, item), m in sorted(found.items()) for _ in range(searcher.items.copies[item])]
                    chosen, cells = batch.take(pa.array([r[0] for r in rows])), list(zip(*rows, strict=True))[1:]
                    yield pa.RecordBatch.from_arrays([chosen.column(chosen.schema.get_field_index(c)) for c in keep] + [pa.array(c, t) for c, t in zip(cells, kinds, strict=True)], names=schema.names)

        part = numbered.mapInArrow(run, schema)
        out = part if out is None else out.unionAll(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, by the rule of ``find_leaks``; texts stay where they are."""
    small_batches(docs.sparkSession)
    out = docs
    for _, searcher in _searchers(docs.select(f"`{text}`"), benchmark, text):

        def run(batches: Iterator[pa.RecordBatch], searcher: Searcher = searcher) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes, ends = _words(batch.column(batch.schema.get_field_index(text)))
                leaks = {row for row, _ in searcher.matches(searcher.items.number(hashes), ends)}
                yield batch.take(pa.array([k for k in range(batch.num_rows) if k not in leaks], pa.int64())) if leaks else batch

        out = out.mapInArrow(run, docs.schema)
    return out
