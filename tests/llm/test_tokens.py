"""Token counts, token files and packing against the tokenizers library."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from schemaward.llm import bpe, packing, queries, token_counts, token_files
from schemaward.llm.batches import scratch, text_buffer

PARTS = ["a", "b", "th", "er", " ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'v", "1", "23", "é", "ß", "!", "?!", "<|endoftext|>", "<|end", "|>", "漢", "😀", "\x00", "\x1c",
         "\x85", "\u00a0", "S", "𝔘", "ⱥ", "_", "\r\n", "'d", "t", "====", "re", "e", "l", "Ⅷ"]


def _texts(n, most, seed=5):
    rng = random.Random(seed)
    return ["", " ", "  ", "don't", "'re", " 're", "a\n\nb", "a \n b", "''s", "a  'tis"] + ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, most))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_path())


def _ids(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_ids_are_the_librarys(library):
    texts = _texts(6000, 30)
    ids, ends = bpe.Pieces(bpe.default_path()).encode(*text_buffer(pa.array(texts)))
    assert [ids[a:b].tolist() for a, b in zip(ends, ends[1:], strict=False)] == _ids(library, texts)


def test_small_tables_forget_and_stay_right(library, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_PIECES", 20)
    monkeypatch.setattr(bpe, "TABLE_PAIRS", 20)
    monkeypatch.setattr("schemaward.llm.batches.CHUNK_BYTES", 64)
    texts, pieces = _texts(300, 30), bpe.Pieces(bpe.default_path(), True)
    for t, want in zip(texts, _ids(library, texts), strict=True):
        ids, _ = pieces.encode(*text_buffer(pa.array([t])))
        assert ids.tolist() == want
        counts, _ = pieces.count_prefixes(*text_buffer(pa.array([t])))
        assert (counts[-1] if len(counts) else 0) == len(want)


def test_every_prefix_count(library):
    texts = _texts(700, 14, 7)
    counts, rows = bpe.Pieces(bpe.default_path(), True).count_prefixes(*text_buffer(pa.array(texts)))
    assert counts.tolist() == [len(x) for x in _ids(library, [t[:k] for t in texts for k in range(1, len(t) + 1)])]
    assert np.diff(rows).tolist() == [len(t) for t in texts]


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.Pieces(bpe.default_path("word_bpe_49k.json"))


def test_token_counts_and_budgets(spark, library, awkward, nothing):
    rows = token_counts.count_tokens(awkward).withColumn("fit", token_counts.longest_prefix(7)).collect()
    assert len(rows) == 10 and all(r._block == "keep" for r in rows)
    texts = {r.doc_id: r.text or "" for r in awkward.collect()}
    for r in rows:
        t = texts[r.doc_id]
        assert r.n_tokens == len(_ids(library, [t])[0]) and r.n_bytes == len(t.encode()) and len(r.prefix_steps) == len(t) * r.step_bytes
        assert len(_ids(library, [t[: r.fit]])[0]) <= 7 and (r.fit == len(t) or len(_ids(library, [t[: r.fit + 1]])[0]) > 7)
    assert token_counts.count_tokens(nothing).count() == 0


def test_codes_round_trip_and_random_access():
    rng = np.random.default_rng(3)
    for ids in (np.zeros(0), np.array([0, 255, 256, 65535, 65536, 2**32 - 1]), rng.integers(0, 70_000, 5000), rng.integers(0, 200, 700)):
        levels = token_files.encode_levels(np.array(ids, np.uint64))
        assert token_files.decode_levels(levels).tolist() == [int(x) for x in ids]
        assert [token_files.token_at(levels, k) for k in range(len(ids))] == [int(x) for x in ids]
        some = rng.permutation(len(ids))
        assert token_files.tokens_at(levels, some).tolist() == [int(ids[k]) for k in some]


def test_token_files(spark, library, awkward, nothing):
    for docs in (awkward, nothing):
        folder = scratch(spark, "files")
        token_files.write_token_files(docs, folder)
        got = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
        want = collections.Counter((r.doc_id, tuple(_ids(library, [r.text])[0]) + (0,)) for r in docs.collect())
        assert collections.Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == want
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got]).tolist()][: len(got)]
        keys = [-1 if r.doc_id is None else r.doc_id for r in got]
        assert keys == sorted(keys)


@pytest.mark.parametrize("bound", [1_000_000, 0])
def test_tokens_by_position_across_segments(spark, awkward, nothing, bound, monkeypatch):
    monkeypatch.setattr(token_files, "ASKED_BROADCAST", bound)
    monkeypatch.setattr(token_files, "_CELL", 1000)
    folder = scratch(spark, "files")
    token_files.write_token_files(awkward, folder)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r.start)
    ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows]).tolist()
    assert spark.read.parquet(folder).count() > 1
    some = sorted({0, len(ids) - 1, *(r.start for r in rows), *range(0, len(ids), 97)})
    asked = spark.createDataFrame([(p,) for p in [*some, *some[:5], None, -1, len(ids), 10**12]], "position long")
    got = token_files.read_tokens(spark, folder, asked).collect()
    assert sorted((r.position, r.id) for r in got) == [(p, ids[p]) for p in some]
    empty = scratch(spark, "files")
    token_files.write_token_files(nothing, empty)
    assert token_files.read_tokens(spark, empty, asked).count() == 0


def test_token_files_query(spark):
    docs = [(2, "b c"), (1, "a"), (3, None), (4, "")]
    sf = scratch(spark, "sf")
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{sf}/documents.parquet")
    rows = queries.QUERIES["op6_token_files"](spark, sf).orderBy("doc_id").collect()
    ids = [np.frombuffer(r.ids, "<u4").tolist() for r in sorted(token_files.read_token_files(spark, _folder_of(spark, docs)).collect(), key=lambda r: r.doc_id)]
    assert [(r.doc_id, r.n_tokens, r.first_id, r.ids_crc32) for r in rows] == [
        (k, len(x), x[0], zlib.crc32(np.array(x, "<u4").tobytes())) for k, x in zip((1, 2, 3, 4), ids)]


def _folder_of(spark, docs):
    folder = scratch(spark, "files")
    token_files.write_token_files(spark.createDataFrame(docs, "doc_id long, text string"), folder)
    return folder


def _check_packing(library, docs, rows, capacity):
    whole = collections.Counter((r.doc_id, tuple(_ids(library, [r.text])[0]) + (0,)) for r in docs.collect())
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length <= capacity and (r.length == capacity or r.piece == 0)
        by[r.doc_id].append((r.piece, r.start, ids))
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts]).tolist()][: len(parts)] and sum(n for _, n in parts) <= capacity
    for (key, ids), times in whole.items():
        if times == 1:
            parts = sorted(by[key])
            assert [p for p, _, _ in parts] == list(range(-(-len(ids) // capacity))) and sum((x for _, _, x in parts), []) == list(ids)
            assert [s for _, s, _ in parts] == [0, *np.cumsum([len(x) for _, _, x in parts]).tolist()][: len(parts)]
    return len(seqs)


def test_packing(spark, library, awkward, nothing):
    assert packing.pack(nothing).count() == 0
    rows = packing.pack(awkward, capacity=64).collect()
    assert all(r._block == "keep" for r in rows) and len([r for r in rows if r.doc_id == 7]) == 2
    n = _check_packing(library, awkward, rows, 64)
    assert n <= -(-sum(r.length for r in rows) // 64) + 1


def test_plan_uses_every_piece_once_and_few_sequences():
    rng = random.Random(8)
    for capacity, pieces in ((2048, [rng.randint(1, 2048) for _ in range(6000)]), (10, [5, 5, 4, 3, 3, 7, 10, 1, 1, 1]), (100, [51] * 7 + [49] * 3 + [1] * 40), (9, [4] * 5)):
        counts = collections.Counter(pieces)
        patterns = packing.plan(dict(counts), capacity)
        used = collections.Counter()
        for pattern, times in patterns:
            assert sum(pattern) <= capacity and times > 0
            for x in pattern:
                used[x] += times
        assert used == counts
        ranks = collections.defaultdict(list)
        for length, a, b, _, _ in packing.places(patterns):
            ranks[length] += range(a, b)
        assert all(sorted(r) == list(range(counts[x])) for x, r in ranks.items())
        bound = max(-(-sum(pieces) // capacity), sum(2 * x > capacity for x in pieces))
        assert sum(t for _, t in patterns) <= bound * 1.02 + 2


def test_crc_of_ids_is_of_little_endian_words(spark):
    raw = np.array([1, 50256], "<u4").tobytes()
    assert spark.createDataFrame([(raw,)], "ids binary").select(F.crc32("ids")).first()[0] == zlib.crc32(raw)
