"""Toxicity scores from a classifier that is held to the same score when identity terms change places.

A linear model over the presence of words and word beginnings is fitted on a bounded sample of labelled documents. Each
sampled document that names a group is also read with the group replaced by another of its list; the squared change of
the score joins the loss, so a mention weighs the same whichever group it names. Identity terms have no beginnings among
the features, so the swapped word is all of a mention that the model sees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, small_batches, span_hashes, store, text_buffer

SAMPLE = 40_000      # labelled documents that a model is fitted on at most, those of the smallest hashes
FEATURES = 4_096     # words and beginnings that a model keeps at most
EVIDENCE = 20.0      # likelihood-ratio statistic that a feature needs
BUCKETS = 1 << 22
BEGINNINGS = (4, 5, 6)
# groups of interchangeable terms, by language
IDENTITY = (
    ("women", "men"), ("girls", "boys"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("woman", "man"), ("girl", "boy"), ("muslim", "christian", "jew", "hindu", "buddhist", "atheist"),
    ("immigrants", "refugees", "locals"), ("immigrant", "refugee", "local"),
    ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian", "trans"),
    ("femmes", "hommes"), ("musulmans", "juifs"), ("frauen", "männer"), ("muslime", "juden"), ("mujeres", "hombres"), ("musulmanes", "judíos"),
    ("femme", "homme"), ("musulman", "juif"), ("musulmane", "juive"), ("frau", "mann"), ("muslimin", "jüdin"), ("jude", "christ"), ("mujer", "hombre"),
    ("musulmán", "judío"), ("musulmana", "judía"),
)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True


def _features(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of each row, and where each row's begin (one more entry)."""
    data, offsets = text_buffer(pc.utf8_lower(column.cast(pa.large_string())))
    parts, ends = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]
    for i, j in chunks(offsets):
        piece, off = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        letter = np.zeros(len(piece) + 2, bool)
        letter[1:-1] = _LETTER[piece]
        cut = np.zeros(len(piece) + 1, bool)
        cut[off] = True
        starts = np.flatnonzero(letter[1:-1] & (~letter[:-2] | cut[:-1]))
        ends_ = np.flatnonzero(letter[1:-1] & (~letter[2:] | cut[1:])) + 1
        row = np.searchsorted(off, starts, "right") - 1
        whole = span_hashes(piece, starts, ends_)
        found = [(row << 22) | (whole & np.uint64(BUCKETS - 1)).astype(np.int64)]
        other = ~np.isin(whole, _IDENTITY_HASHES)  # the beginnings of an identity term would stay when it is swapped
        for k in BEGINNINGS:
            longer = (ends_ - starts > k) & other
            s = starts[longer]
            found.append((row[longer] << 22) | ((span_hashes(piece, s, s + k) + np.uint64(k)) & np.uint64(BUCKETS - 1)).astype(np.int64))
        distinct = np.unique(np.concatenate(found))
        parts.append(distinct & (BUCKETS - 1))
        ends.append(ends[-1][-1] + np.searchsorted(distinct, np.arange(1, j - i + 1, dtype=np.int64) << 22))
    return np.concatenate(parts), np.concatenate(ends)


def _identity_buckets() -> tuple[dict[int, int], np.ndarray]:
    """For the bucket of each identity term the bucket of the term that takes its place; and all these buckets."""
    flat = [t for group in IDENTITY for t in group]
    buckets = np.array([_word_bucket(t) for t in flat], np.int64)
    place = dict(zip(flat, buckets.tolist(), strict=True))
    return {place[t]: place[g[(k + 1) % len(g)]] for g in IDENTITY for k, t in enumerate(g)}, buckets


def _word_hash(term: str) -> np.uint64:
    raw = np.frombuffer(term.lower().encode(), np.uint8)
    return span_hashes(raw, np.array([0]), np.array([len(raw)]))[0]


def _word_bucket(term: str) -> int:
    return int(_word_hash(term) & np.uint64(BUCKETS - 1))


_IDENTITY_HASHES = np.array([_word_hash(t) for group in IDENTITY for t in group], np.uint64)


def document_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with features: the distinct buckets of its words and word beginnings."""
    keep = [c for c in docs.columns if c not in (text, "features")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("features", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, ends = _features(batch.column(batch.schema.get_field_index(text)))
            made = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(buckets, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [made], names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


class Model:
    """Weights of the chosen feature buckets and a bias."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias

    @staticmethod
    def fit(rows: list[list[int]], toxic: np.ndarray, buckets: np.ndarray, counterfactual: float = 10.0, ridge: float = 1e-5, rounds: int = 400) -> Model:
        """Logistic regression with a counterfactual penalty, by full-batch Adam; deterministic."""
        buckets = np.sort(buckets)
        sizes = np.array([len(r) for r in rows], np.int64)
        owner = np.repeat(np.arange(len(rows)), sizes)
        column = np.searchsorted(buckets, np.array([b for r in rows for b in r], np.int64))
        swaps, _ = _identity_buckets()
        have = set(buckets.tolist())
        # rows of the differences between a document and its counterfactual
        pairs = [(k, b, swaps[b]) for k, r in enumerate(rows) for b in r if b in swaps and swaps[b] in have]
        d_row = np.array([p[0] for p in pairs], np.int64)
        d_from, d_to = (np.searchsorted(buckets, np.array([p[i] for p in pairs], np.int64)) for i in (1, 2))
        n, m = len(rows), len(buckets)
        w, bias = np.zeros(m), float(np.log((toxic.sum() + 0.5) / (n - toxic.sum() + 0.5))) if n else -2.0
        g1, g2 = np.zeros(m + 1), np.zeros(m + 1)
        for t in range(1, rounds + 1 if n else 1):
            z = bias + np.bincount(owner, w[column], n)
            p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            error = (p - toxic) / n
            gw = np.bincount(column, error[owner], m) + ridge * w
            if len(pairs):
                change = np.bincount(d_row, w[d_to] - w[d_from], n)[d_row] * (2 * counterfactual / n)
                gw += np.bincount(d_to, change, m) - np.bincount(d_from, change, m)
            g = np.append(gw, error.sum())
            g1, g2 = 0.9 * g1 + 0.1 * g, 0.999 * g2 + 0.001 * g * g
            step = 0.1 * (g1 / (1 - 0.9 ** t)) / (np.sqrt(g2 / (1 - 0.999 ** t)) + 1e-9)
            w, bias = w - step[:-1], bias - float(step[-1])
        return Model(buckets, w, bias)

    def scores(self, column) -> np.ndarray:
        dense = np.zeros(BUCKETS, np.float32)
        dense[self.buckets] = self.weights
        found, ends = _features(column)
        sums = np.concatenate([[0.0], np.cumsum(dense[found], dtype=np.float64)])
        z = self.bias + sums[ends[1:]] - sums[ends[:-1]]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic", sample: int = SAMPLE, features: int = FEATURES) -> Model:
    """A model from labelled documents: ``labels`` is (``key``, ``label`` 0 or 1), other labels and null keys are left out.

    At most ``sample`` labelled keys, those with the smallest hashes, are used; they are few enough to be broadcast, so
    no text is shuffled. The model holds the ``features`` words and word beginnings of most evidence. Rows of one key count as one document, the one with the smallest features. A key with two
    labels counts as toxic. Without any toxic label every score is low.
    """
    small_batches(docs.sparkSession)
    marks = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("toxic"))
    marks = marks.orderBy(F.xxhash64("k"), "k").limit(sample)
    read = docs.select(f"`{key}`", f"`{text}`").join(F.broadcast(marks), F.col(f"`{key}`") == F.col("k")).select("k", "toxic", f"`{text}`")
    one = document_features(read, text).groupBy("k", "toxic").agg(F.min("features").alias("features"))
    seen = store(one.select("toxic", "features"), "features")
    total, positive = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    _, identity = _identity_buckets()
    counts = seen.select("toxic", F.explode("features").alias("f")).groupBy("f").agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
    negative = max(total - positive, 1)
    b = F.col("n") - F.col("a")

    def term(x: Column, row: Column, col: float) -> Column:
        return F.when(x > 0, x * F.log(x * float(max(total, 1)) / (row * col))).otherwise(0.0)
    evidence = 2 * (term(F.col("a"), F.col("n"), float(max(positive, 1))) + term(b, F.col("n"), float(negative))
                    + term(positive - F.col("a"), total - F.col("n"), float(max(positive, 1))) + term(negative - b, total - F.col("n"), float(negative)))
    strong = counts.where(F.col("a") / max(positive, 1) > b / negative).withColumn("g", evidence).where(F.col("g") >= EVIDENCE)
    chosen = [r["f"] for r in strong.orderBy(F.desc("g"), "f").limit(features).select("f").collect()]
    buckets = np.unique(np.array([*chosen, *identity.tolist()], np.int64))
    wanted = F.lit(buckets.astype(np.int32))
    rows = seen.select("toxic", F.array_sort(F.array_intersect("features", wanted)).alias("f")).collect()  # one row of chosen features for each of at most ``sample`` keys
    rows.sort(key=lambda r: (r["toxic"], r["f"]))
    return Model.fit([r["f"] for r in rows], np.array([r["toxic"] for r in rows], np.float64), buckets)


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text, with score (0 to 1). Null and empty texts get the score of no evidence at all.

    Repeated rows score alike; a column of the added name, whatever its case, is replaced, others pass through."""
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), "score")]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array(model.scores(batch.column(batch.schema.get_field_index(text))))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [made], names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)
