"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are sequences of three words, an edge is a sequence of four and joins its first three words to its last three; its
weight is how often it occurs. Only edges are counted, one for every word that a piece of text holds: behind the last
word of a piece stand three end marks, so a piece's last words have edges too, and these are the piece-end corrections.
How often a shorter phrase occurs is then the flow through its nodes: all edges that begin with it, into words or ends.

Frequent edges whose nodes have one way in and one way out are contracted to longer paths, so a passage that is repeated
often is one row; inside a path, what surrounds a node is known in the row, and only path ends meet by joins.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, small_batches, span_hashes, store, text_buffer
from schemaward.llm.simhash import _LOWER

CHUNK = 6 << 20      # bytes of text whose edges are counted together before they travel
ROUNDS = 5           # contractions of unary paths
PATH_WORDS = 64      # a path grows no further
SALTS = 64           # parts of a language that are ranked before the language is
_WORD_BITS = 31      # numbers of frequent words
_END = np.zeros(256, bool)
_END[[*range(0x0A, 0x0E), *b".,;:!?"]] = True
_BLANK = _END.copy()
_BLANK[[0x20, 0x09]] = True
_CODED = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("size", T.LongType()), T.StructField("codes", T.BinaryType()), T.StructField("lang", T.ArrayType(T.StringType())),
    T.StructField("word", T.ArrayType(T.StringType())), T.StructField("n", T.ArrayType(T.LongType()))])


def _piece_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and whether a piece ends behind it."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    blank, edge = _BLANK[data], np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.append(True, blank[:-1]) | edge[:-1], np.append(blank[1:], True) | edge[1:]
    starts, ends = np.flatnonzero(~blank & before), np.flatnonzero(~blank & after) + 1
    stop = np.cumsum(_END[data], dtype=np.int32)  # end marks up to a byte
    row = np.cumsum(edge[:-1], dtype=np.int32)
    last = np.ones(len(starts), bool)
    last[:-1] = (stop[starts[1:]] > stop[starts[:-1]]) | (row[starts[1:]] > row[starts[:-1]])
    return starts, ends, last


def _packed(codes: np.ndarray) -> bytes:
    """Numbers as compressed byte planes; frequent words have small ones, so the upper planes are nearly empty."""
    return pa.compress(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(raw, 4 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4")[:, 0]


def _coded(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """One row per chunk of documents: their words as numbers in the chunk's own list of words by language, 0 between
    pieces, with the count of each word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
            data = _LOWER[data]
            names = batch.column(batch.schema.get_field_index(lang)).cast(pa.string()).fill_null("und").dictionary_encode()
            tongue, spoken = names.indices.to_numpy(), names.dictionary.to_pylist()
            for i, j in chunks(offsets, CHUNK):
                piece, off = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
                starts, ends, last = _piece_words(piece, off)
                if not len(starts):
                    continue
                of = tongue[i:j][np.searchsorted(off, starts, "right") - 1]
                keys = span_hashes(piece, starts, ends) ^ (of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
                distinct, where, number, many = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
                order = np.argsort(-many, kind="stable")
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(len(order))
                where, many = where[order], many[order]
                codes = np.zeros(len(starts) + int(last.sum()), np.uint32)
                codes[np.arange(len(starts)) + np.cumsum(last) - last] = rank[number] + 1
                raw = piece.tobytes()
                words = [raw[a:b].decode() for a, b in zip(starts[where].tolist(), ends[where].tolist(), strict=True)]
                langs = [spoken[k] for k in of[where].tolist()]
                yield pa.RecordBatch.from_pydict({
                    "block": [uuid.uuid4().hex], "size": [len(codes)], "codes": pa.array([_packed(codes)], pa.binary()), "lang": pa.array([langs], pa.list_(pa.string())),
                    "word": pa.array([words], pa.list_(pa.string())), "n": pa.array([many], pa.list_(pa.int64()))})

    return docs.select(f"`{text}`", f"`{lang}`").mapInArrow(run, _CODED)


def _edges(codes: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first two words, last two, count) of the edges of a chunk; a word without a number ends a piece like an end."""
    words = np.concatenate([numbers[codes], np.zeros(3, np.int64)])
    at = np.flatnonzero(words)
    a, b, c, d = (words[at + k] for k in range(4))
    c = c * (b > 0)  # behind an end all is end
    d = d * (c > 0)
    lo, hi = a << 32 | b, c << 32 | d
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    new = np.ones(len(lo), bool)
    new[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    first = np.flatnonzero(new)
    return lo[first], hi[first], np.diff(np.append(first, len(lo)))


def _numbered(words: DataFrame) -> DataFrame:
    """(lang, word, id): numbers from 1 on, without a global order: each task's rows follow those of the tasks before."""
    rows = store(words.select("lang", "word", F.monotonically_increasing_id().alias("at")), "frequent")
    task = F.shiftright("at", 33)
    sizes = rows.groupBy(task.alias("task")).count().orderBy("task").collect()  # one row per task
    base, total = {}, 0
    for r in sizes:
        base[r["task"]] = total
        total += r["count"]
    if total >= 1 << _WORD_BITS:
        raise ValueError(f"{total} frequent words; their numbers have {_WORD_BITS} bits")
    if not base:
        return rows.select("lang", "word", F.lit(0).cast("long").alias("id"))
    offsets = F.create_map(*[F.lit(x).cast("long") for k in base.items() for x in k])
    return rows.select("lang", "word", (offsets[task] + F.col("at").bitwiseAND((1 << 33) - 1) + 1).alias("id"))


def _counted(edges: DataFrame, least: int) -> DataFrame:
    """Frequent phrases of 2 to 4 words as (k, lo, hi, n), and all words (k = 1) with their counts.

    Edges meet by their first two words: their weights, the flow of three-word nodes and that of two-word nodes are three
    aggregations inside one shuffle, each handing on what is frequent beside its flow; only words need another, small one.
    """
    big, low = F.col("n") >= least, 0xFFFFFFFF

    def handed(rows: DataFrame, passes: Column, flows: Column, *keys: Column) -> DataFrame:
        kept = F.when(passes, F.struct(F.col("k"), F.col("lo").alias("at"), "hi", "n"))
        onward = F.when(flows, F.struct((F.col("k") - 1).alias("k"), keys[0].alias("at"), keys[1].alias("hi"), F.col("n")))
        return rows.select("lo", F.inline(F.array(kept, onward))).where("k is not null")

    none = F.lit(0).cast("long")
    four = edges.repartition("lo").groupBy("lo", "hi").agg(F.sum("n").alias("n")).withColumn("k", F.lit(4))
    three = handed(four, big & (F.col("hi").bitwiseAND(low) > 0), F.lit(True), F.col("lo"), F.col("hi").bitwiseAND(~low)).groupBy("lo", "k", "hi").agg(F.sum("n").alias("n"))
    two = handed(three, (F.col("k") == 4) | (big & (F.col("hi") > 0)), F.col("k") == 3, F.col("lo"), none).groupBy("lo", "k", "hi").agg(F.sum("n").alias("n"))
    one = handed(two, (F.col("k") > 2) | (big & (F.col("lo").bitwiseAND(low) > 0)), F.col("k") == 2, F.col("lo").bitwiseAND(~low), none)
    return one.groupBy("k", F.col("at").alias("lo"), "hi").agg(F.sum("n").alias("n"))


def _compact(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Paths (words, weights, flows) of the frequent graph: its edges, joined over nodes with one way in and one way out.

    Each round draws a side for every path; a path of one side takes over its successor if that is of the other, unless
    both together grow beyond PATH_WORDS. So a path never meets itself, circles too, and what stays uncontracted is only
    a longer table. ``flows`` are those of the nodes, one more than edges.
    """
    w = lambda c, s: F.shiftright(c, 32) if s else F.col(c).bitwiseAND(0xFFFFFFFF)
    start = F.struct(F.col("lo").alias("x"), w("hi", 1).alias("y"))
    end = F.struct((F.shiftleft(w("lo", 0), 32) + w("hi", 1)).alias("x"), w("hi", 0).alias("y"))
    ins = edges.groupBy(end.alias("node")).agg(F.count(F.lit(1)).alias("ins"))
    outs = edges.groupBy(start.alias("node")).agg(F.count(F.lit(1)).alias("outs"))
    known = nodes.select(F.struct(F.col("lo").alias("x"), F.shiftright("hi", 32).alias("y")).alias("node"), F.col("n").alias("flow"))
    ways = store(known.join(ins, "node", "left").join(outs, "node", "left").select("node", "flow", (F.col("ins").eqNullSafe(1) & F.col("outs").eqNullSafe(1)).alias("unary")), "nodes")
    side = lambda p: ways.select(F.col("node").alias(p), F.col("flow").alias(f"{p}_flow"), F.col("unary").alias(f"{p}_unary"))
    paths = edges.select(start.alias("s"), end.alias("t"), F.array(w("lo", 1), w("lo", 0), w("hi", 1), w("hi", 0)).alias("words"), F.array("n").alias("weights")).join(side("s"), "s").join(side("t"), "t")
    paths = store(paths.select("s", "t", "words", "weights", F.array("s_flow", "t_flow").alias("flows"), "s_unary", "t_unary"), "paths")
    for r in range(ROUNDS):
        drawn = paths.withColumn("takes", F.pmod(F.xxhash64("s", F.lit(r)), F.lit(2)) == 0)
        heads, tails = drawn.where("takes and t_unary"), drawn.where("not takes and s_unary")
        rest = drawn.where("(takes and not t_unary) or (not takes and not s_unary)")
        h = heads.select(*[F.col(c).alias(f"h_{c}") for c in paths.columns])
        u = tails.select(*[F.col(c).alias(f"u_{c}") for c in paths.columns])
        met = h.join(u, (F.col("h_t") == F.col("u_s")) & (F.size("h_words") + F.size("u_words") <= PATH_WORDS + 3), "full_outer")
        both = F.col("h_s").isNotNull() & F.col("u_s").isNotNull()
        join = {"words": F.concat("h_words", F.slice("u_words", F.lit(4), F.greatest(F.size("u_words") - 3, F.lit(0)))), "weights": F.concat("h_weights", "u_weights"),
                "flows": F.concat("h_flows", F.slice("u_flows", F.lit(2), F.greatest(F.size("u_flows") - 1, F.lit(0))))}
        first = {"t", "t_unary"}
        grown = met.select(*[F.when(both, join.get(c, F.col(f"u_{c}" if c in first else f"h_{c}"))).otherwise(F.coalesce(f"h_{c}", f"u_{c}")).alias(c) for c in paths.columns])
        paths = store(grown.unionAll(rest.select(paths.columns)), "paths")
    return paths.select("words", "weights", "flows")


def _phrases(paths: DataFrame, grams: DataFrame) -> DataFrame:
    """(k, lo, hi, n, above): all candidates, with the largest count of a phrase one word longer around them.

    A phrase is dropped for some longer one exactly if it is for one a word longer, as counts only fall. Inner nodes of a
    path have both their edges in the row; nodes at path ends, and phrases of two words, take the largest by a grouping.
    """
    node = lambda p, i: F.struct(F.shiftleft(F.element_at(p, i), 32) + F.element_at(p, i + 1), F.shiftleft(F.element_at(p, i + 2), 32))
    spots = paths.select("words", "weights", "flows", F.explode(F.sequence(F.lit(1), F.size("flows"))).alias("i"))
    edge = lambda i: F.when((i >= 1) & (i <= F.size("weights")), F.try_element_at("weights", i))
    here = spots.select(node("words", F.col("i")).alias("g"), F.greatest(edge(F.col("i") - 1), edge(F.col("i"))).alias("above"), ((F.col("i") > 1) & (F.col("i") < F.size("flows"))).alias("inner"), F.element_at("flows", F.col("i")).alias("n"))
    inside = here.where("inner").select(F.lit(3).alias("k"), "g.*", "n", "above").toDF("k", "lo", "hi", "n", "above")
    ends = here.where("not inner").groupBy("g").agg(F.max("n").alias("n"), F.max("above").alias("above")).select(F.lit(3).alias("k"), "g.*", "n", "above").toDF("k", "lo", "hi", "n", "above")
    four = paths.select("words", F.posexplode("weights").alias("i", "n")).select(
        F.lit(4).alias("k"), (F.shiftleft(F.element_at("words", F.col("i") + 1), 32) + F.element_at("words", F.col("i") + 2)).alias("lo"),
        (F.shiftleft(F.element_at("words", F.col("i") + 3), 32) + F.element_at("words", F.col("i") + 4)).alias("hi"), "n", F.lit(None).cast("long").alias("above"))
    threes = grams.where("k = 3")
    # nodes without a frequent edge stand on no path
    alone = threes.join(here.select(F.col("g")["col1"].alias("lo"), F.col("g")["col2"].alias("hi")), ["lo", "hi"], "left_anti").select("k", "lo", "hi", "n", F.lit(None).cast("long").alias("above"))
    inner_pair = F.shiftleft(F.col("lo").bitwiseAND(0xFFFFFFFF), 32) + F.shiftright("hi", 32)
    around = threes.select(F.explode(F.array("lo", inner_pair)).alias("lo"), "n").groupBy("lo").agg(F.max("n").alias("above"))
    two = grams.where("k = 2").join(around, "lo", "left").select("k", "lo", "hi", "n", "above")
    return four.unionAll(inside).unionAll(ends).unionAll(alone).unionAll(two)


def _scored(kept: DataFrame, grams: DataFrame) -> DataFrame:
    """``kept`` (k, lo, hi, n) with score, l and r of the cut that scores lowest, the first of equal ones."""
    words = F.array(F.shiftright("lo", 32), F.col("lo").bitwiseAND(0xFFFFFFFF), F.shiftright("hi", 32), F.col("hi").bitwiseAND(0xFFFFFFFF))

    def packed(w: Column) -> Column:
        at = lambda i: F.coalesce(F.try_element_at(w, F.lit(i)), F.lit(0).cast("long"))
        return F.struct((F.shiftleft(at(1), 32) + at(2)).alias("lo"), (F.shiftleft(at(3), 32) + at(4)).alias("hi"))

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).withColumn("w", F.slice(words, F.lit(1), F.col("k")))
    cuts = cuts.select("k", "lo", "hi", "n", "cut", packed(F.slice("w", F.lit(1), F.col("cut"))).alias("p"), packed(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut"))).alias("q"))
    count = grams.select(F.struct("lo", "hi").alias("g"), F.col("n").alias("count"))
    cuts = cuts.join(count.select(F.col("g").alias("p"), F.col("count").alias("l")).hint("merge"), "p").join(count.select(F.col("g").alias("q"), F.col("count").alias("r")).hint("merge"), "q")
    score = F.expr("(cast(2000000 as decimal(7,0)) * cast(n as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))").cast("long")
    return cuts.groupBy("k", "lo", "hi", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("b")).select("k", "lo", "hi", F.col("n").alias("a"), "b.score", "b.l", "b.r")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, share: int = 80, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 4 words that occur ``least`` times or more.

    Texts are whole, A-Z counts as a-z; phrases stay inside pieces between ``[.,;:!?]`` and line ends. A phrase inside a
    longer one that occurs ``share`` percent as often or more is dropped. Null languages are ``und``; null and empty texts
    hold nothing, repeated rows count each time, other columns are not read. Words are told apart inside a chunk by
    64-bit hashes; everything after is exact. Ties of score and count go by the phrase's bytes.
    """
    small_batches(docs.sparkSession, rows=2000)
    blocks = store(_coded(docs, text, lang), "coded")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("lang", "word", "n")).alias("at", "w")).select("block", "at", "w.lang", "w.word", "w.n")
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    numbers = store(_numbered(listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)), "numbers")
    # no frequent phrase holds a rarer word, so rarer words only end pieces; a word of every document is a row per chunk
    back = listed.select("block", "at", "lang", "word").join(numbers.hint("merge"), ["lang", "word"]).select("block", "at", "id")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64)] * 3
        if left.num_rows:
            codes = _unpacked(left.column("codes")[0].as_py(), left.column("size")[0].as_py())
            ids = np.zeros(int(codes.max(initial=0)) + 1, np.int64)
            ids[right.column("at").to_numpy() + 1] = right.column("id").to_numpy()
            out = _edges(codes, ids)
        return pa.Table.from_pydict({n: pa.array(v, pa.int64()) for n, v in zip(("lo", "hi", "n"), out, strict=True)})

    edges = blocks.select(F.col("block").alias("of"), "size", "codes").groupBy("of").cogroup(back.groupBy("block")).applyInArrow(count, "lo long, hi long, n long")
    grams = store(_counted(edges, least), "grams")
    paths = store(_compact(grams.where("k = 4"), grams.where("k = 3")), "compacted")
    candidates = _phrases(paths, grams)
    kept = candidates.where(F.col("above").isNull() | (F.col("above").cast("decimal(19,0)") * 100 < F.col("n").cast("decimal(19,0)") * share)).select("k", "lo", "hi", "n")
    scored = store(_scored(kept, grams), "scored")
    # the language is that of any of its words; ties of the last place stay until the phrases are spelled out
    first = scored.join(numbers.select(F.col("id").alias("head"), "lang").hint("merge"), F.shiftright("lo", 32) == F.col("head")).drop("head")
    # first inside SALTS parts of each language, so that no task sorts all its phrases
    order = "order by score desc, a desc"
    parts = first.withColumn("part", F.pmod(F.xxhash64("lo", "hi"), F.lit(SALTS)))
    leading = parts.withColumn("place", F.expr(f"rank() over (partition by lang, part {order})")).where(F.col("place") <= top)
    placed = leading.withColumn("place", F.expr(f"rank() over (partition by lang {order})")).where(F.col("place") <= top)
    ids = F.slice(F.array(F.shiftright("lo", 32), F.col("lo").bitwiseAND(0xFFFFFFFF), F.shiftright("hi", 32), F.col("hi").bitwiseAND(0xFFFFFFFF)), F.lit(1), F.col("k"))
    spelled = placed.select("lo", "hi", "lang", "a", "l", "r", "score", F.posexplode(ids).alias("at", "id")).join(numbers.select("id", "word").hint("merge"), "id")
    whole = spelled.groupBy("lo", "hi", "lang", "a", "l", "r", "score").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    ranked = whole.withColumn("rank", F.expr("row_number() over (partition by lang order by score desc, a desc, phrase)").cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals.hint("merge"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
