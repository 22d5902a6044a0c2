"""URL filter, chat formatting, decontamination and the pipeline."""

import hashlib
import random
import re

import brute
import numpy as np
import pytest
from compare import compare, duck
from conftest import WORDS
from pyspark.sql import functions as F

from test_near_copies import _classes

import corpus_pipeline
from schemaward.llm import chat, decontaminate, queries, urls
from schemaward.llm.batches import store

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), duck(SF), queries.ORACLES[name]) is None


def _plain(pattern):
    return re.compile("".join("(?s:.*)" if p == "**" else "[^/?#]*" if p == "*" else re.escape(p) for p in re.split(r"(\*\*|\*)", pattern)))


def test_automaton_matches_regular_expressions():
    rng = random.Random(6)
    patterns = ["*.com/**", "*.a.com/x**", "**", "*", "", "a*b", "**/b*", "é*", "a**b*c", ".net/es/**"] + ["".join(rng.choice(["a", "b", "/", ".", "*", "**"]) for _ in range(12)) for _ in range(30)]
    patterns = [re.sub(r"\*{3,}", "**", p) for p in patterns]
    texts = ["", "a", "ab", ".com/", ".x.com/y", "é", "éé?", "\n/b"] + ["".join(rng.choice("ab/.?#") for _ in range(rng.randint(0, 14))) for _ in range(400)]
    got = urls.ShiftAnd(patterns).matches([t.encode() for t in texts])
    for k, p in enumerate(patterns):
        assert [bool(x) for x in got[:, k]] == [_plain(p).fullmatch(t) is not None for t in texts], p


def test_urls_awkward(spark):
    rows = [(1, None), (2, ""), (3, "HTTP://WWW.Example.COM/en/"), (4, "x://example.com/en"), (5, "x://notexample.com/en/"), (6, "no scheme"), (7, "x://a.net:80/es/"), (None, "x://a.net/es/?q"),
            (9, "x://a.net" + "/es/" * 30_000), (9, "x://İ.net/fr/#"), (10, "x://y?://b.net/es/")]
    df = spark.createDataFrame([(*r, "keep") for r in rows], "page_id long, url string, _hit string")
    got = [(r.page_id, r.host, r.rule, r.verdict) for r in urls.filter_urls(df, queries.URL_RULES).collect()]
    assert got == [(1, "", None, "allow"), (2, "", None, "allow"), (3, "www.example.com", "www.example.com/en/", "allow"), (4, "example.com", "com/", "allow"), (5, "notexample.com", "com/", "allow"),
                   (6, "", None, "allow"), (7, "a.net:80", None, "allow"), (None, "a.net", "net/es/", "block"), (9, "a.net", "net/es/", "block"), (9, "İ.net", "net/fr/", "block"), (10, "y", None, "allow")]
    assert urls.filter_urls(df.where("false"), queries.URL_RULES).count() == 0 and urls.filter_urls(df, []).where("verdict = 'allow'").count() == len(rows)


def test_reply_trees(spark):
    nodes = [(1, None, 9, "us\\er\nx", "a<|b<\\|c<|im_end|>\n<|im_start|>", 1.0), (2, 1, 9, "assistant", "r1", 0.2), (3, 1, 9, "assistant", None, 0.9), (4, 3, 9, "user", "<\\\\|x", 0.0),
             (5, 99, None, None, "", None), (6, 7, 1, "a", "b", 1.0), (7, 6, 1, "a", "b", 1.0), (2, 1, 9, "assistant", "r1", 0.2), (None, 1, 9, "x", "y", 0.0)]
    nodes += [(100 + k, 99 + k if k else None, 5, "assistant" if k % 2 else "user", f"t{k}", 0.0) for k in range(70)]
    trees = chat.format_trees(spark.createDataFrame(nodes, "node long, parent long, tree long, role string, text string, score double"))
    rows = {r.leaf: r for r in trees.withColumns({"turns": chat.read_turns(F.col("formatted")), "loss": chat.masked_text(F.col("formatted"), F.col("loss_spans"))}).collect()}
    first = ("us\\er\nx", "a<|b<\\|c<|im_end|>\n<|im_start|>")
    assert [tuple(t) for t in rows[4].turns] == [first, ("assistant", ""), ("user", "<\\\\|x")] and rows[4].rank == 1 and rows[4].loss == ""
    assert [tuple(t) for t in rows[2].turns] == [first, ("assistant", "r1")] and rows[2].rank == 2 and rows[2].loss == "r1"
    assert [tuple(t) for t in rows[5].turns] == [("", "")] and 6 not in rows and 7 not in rows
    assert [t.text for t in rows[169].turns] == [f"t{k}" for k in range(70)] and rows[169].loss == "".join(f"t{k}" for k in range(1, 70, 2))
    assert rows[4].formatted.count("<|im_start|>") == rows[4].formatted.count("<|im_end|>") == 3
    best = chat.format_trees(spark.createDataFrame(nodes, "node long, parent long, tree long, role string, text string, score double"), per_tree=1)
    assert {r.leaf for r in best.collect()} == {4, 5, 169}


def test_conversations_with_alike_numbers_stay_apart(spark):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"{c}/{t}") for c in (1, 11, 111) for t in range(12)]
    trees = chat.format_trees(chat.linear_trees(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")))
    got = {r.tree: [t.text for t in r.turns] for r in trees.withColumn("turns", chat.read_turns(F.col("formatted"))).collect()}
    assert got == {c: [f"{c}/{t}" for t in range(12)] for c in (1, 11, 111)}


def test_linear_conversations_awkward(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, None, None), (None, 1, "user", "é"), (2, 5, "assistant", "z" * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    got = {r.tree: r.n_turns for r in chat.format_trees(chat.linear_trees(df)).collect()}
    assert got == {1: 3, None: 1, 2: 1} and chat.format_trees(chat.linear_trees(df.where("false"))).count() == 0


def test_subsequence_lengths():
    rng = random.Random(3)
    items = [np.array([rng.randint(0, 9) for _ in range(rng.randint(1, 90))]) for _ in range(60)]
    windows = [np.array([rng.randint(-1, 9) for _ in range(rng.randint(0, 120))], np.int64) for _ in range(60)]
    want = [brute.common(a.tolist(), b.tolist()) for a, b in zip(items, windows, strict=True)]
    assert decontaminate.lcs_many(items, windows).tolist() == want == [decontaminate.lcs(a, b) for a, b in zip(items, windows, strict=True)]


def _leaky(spark):
    rng = random.Random(12)
    vocabulary = [a + b for a in WORDS for b in ("", "s", "ing", "ed", "ly")] + ["the", "of", "and"] * 12
    items = [rng.choices(vocabulary, k=rng.randint(14, 60)) for _ in range(30)]
    docs, truth = [], set()
    for k in range(300):
        w = rng.choices(vocabulary, k=rng.randint(0, 300))
        if k % 10 == 0:
            i = rng.randrange(30)
            passage = [x.upper() + "," if rng.random() < 0.3 else x for x in items[i]]
            if k % 20 == 0:  # a paraphrase: some words changed, the end kept
                passage = [rng.choice(vocabulary) if n < len(passage) - 6 and rng.random() < 0.15 else x for n, x in enumerate(passage)]
            at = rng.randint(0, len(w))
            w = w[:at] + passage + w[at:]
            truth.add((k, i))
        docs.append((k, " ".join(w)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string"), truth


def test_leaks_are_found_and_clean_documents_left(spark, monkeypatch):
    docs, items, truth = _leaky(spark)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert len(got & truth) >= 0.9 * len(truth) and len(got - truth) <= 1
    assert {d for d, i in truth if d % 20} <= {d for d, _ in got}
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, items).collect()}
    assert kept == set(range(300)) - {d for d, _ in got}
    monkeypatch.setattr(decontaminate, "ITEMS", 8)  # the benchmark in several blocks
    monkeypatch.setattr(decontaminate, "SLICE", 64)  # texts in overlapping slices
    again = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, items).collect()}
    assert {d for d, i in truth if d % 20} <= {d for d, _ in again} and len(again - truth) <= 2 and len(again & truth) >= 0.9 * len(truth)


def test_words_of_any_script(spark):
    """Verbatim items behind non-breaking blanks and dashes, in quotes, and in texts without blanks."""
    items = ["which river runs through the old town near the northern harbour and why", "東京の古い川はどこを流れていますか北の港まで", "แม่น้ำสายเก่าไหลผ่านเมือง", "l’été à la mer où l’eau brûle les yeux des enfants"]
    docs = ["before it " * 20 + items[0].replace(" ", "\u00a0") + " after it" * 20, "one two " * 20 + "—".join(items[0].split()) + "—three", "“" + items[0].upper() + "”…",
            "本日は晴天なり" * 9 + items[1] + "明日は雨でしょう" * 9, "สวัสดี" * 12 + items[2] + "ลาก่อน" * 12, "Il dit «" + items[3].upper() + "»", "before it " * 40, "本日は晴天なり" * 30]
    found = decontaminate.find_leaks(spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(0, 0), (1, 0), (2, 0), (3, 1), (4, 2), (5, 3)}


def test_repeated_items_match_each_time(spark):
    item = "quartz meadow signal harbour violin copper thistle orbit candle"
    items = spark.createDataFrame([(1, item), (1, item), (1, item), (2, item)], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame([(7, "so " + item)], "doc_id long, text string"), items)
    assert sorted(r.item_id for r in found.collect()) == [1, 1, 1, 2]


def test_bounds_lose_no_leak(monkeypatch):
    """The bounds before the word comparison change no answer."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices(WORDS[:9], k=rng.randint(6, 40))) for _ in range(25)]
    items = decontaminate.Items(list(range(25)), texts)
    searcher = decontaminate.Searcher(items, np.random.default_rng(1).standard_normal((len(items.vocabulary), 6)))
    monkeypatch.setattr(decontaminate, "COSINE", -1.0)
    words = np.concatenate([items.words[rng.randrange(25)] if rng.random() < 0.3 else np.array(rng.choices(range(-1, len(items.vocabulary)), k=9)) for _ in range(60)])
    ends = np.array([0, 100, 100, 260, len(words)])
    got = searcher.search(words, ends)
    monkeypatch.setattr(decontaminate.Searcher, "_possible", lambda self, words, item, a, b: np.arange(len(item)))
    assert got == searcher.search(words, ends) and got


def test_bounds_check_all_candidates_at_once(monkeypatch):
    """The bound by words and answers is that of a plain comparison, without a call for each candidate."""
    rng = random.Random(3)
    items = decontaminate.Items(list(range(40)), [" ".join(rng.choices(WORDS[:9], k=rng.randint(1, 30))) for _ in range(40)])
    searcher = decontaminate.Searcher(items, np.zeros((len(items.vocabulary), 2)))
    words = np.array(rng.choices(range(-1, len(items.vocabulary)), k=900), np.int32)
    item = np.array([rng.randrange(40) for _ in range(3000)])
    a = np.array([rng.randrange(890) for _ in item])
    b = np.minimum(a + np.array([rng.randint(1, 40) for _ in item]), len(words))
    want = []
    for n, (k, x, y) in enumerate(zip(item.tolist(), a.tolist(), b.tolist(), strict=True)):
        own, there = items.words[k].tolist(), words[x:y].tolist()
        share = sum(w in own for w in there) / len(own)
        if share >= decontaminate.COPIED - 1e-9 or share >= decontaminate.PARAPHRASED - 1e-9 and set(own[-decontaminate.ANSWER:]) <= set(there):
            want.append(n)
    monkeypatch.setattr(np, "isin", None)
    assert searcher._possible(words, item, a, b).tolist() == want and 100 < len(want) < 2900


def test_decontamination_awkward(spark, awkward, nothing):
    _, items, _ = _leaky(spark)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!!!"), (None, "quartz meadow signal harbour violin copper thistle orbit"), (5, "one")], "item_id long, text string")
    rows = decontaminate.find_leaks(awkward, odd).collect()
    assert all(r._block == "keep" for r in rows) and {r.item_id for r in rows if r.doc_id == 6} == {None}
    assert decontaminate.drop_leaks(awkward, odd).columns == awkward.columns
    for empty in (nothing, awkward):
        assert decontaminate.find_leaks(empty, odd.where("false")).count() == 0
    assert decontaminate.find_leaks(nothing, items).count() == 0


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = store(stage(spark, docs, SF), "test")
        if k < 4:
            assert docs.columns == seen[0].columns
        seen.append(docs)
    texts = [{r.doc_id: r.text for r in d.collect()} for d in seen[:5]]
    assert all(texts[1][k] == texts[0][k] for k in texts[1]) and not any(brute.base_measures(t)[-1] for t in texts[1].values())
    ids = sorted(texts[1])
    assert sorted(texts[2]) == sorted(set(_classes(ids, [texts[1][k] for k in ids]).values()))
    order = sorted(texts[2])
    cut = {k: c for k, c in zip(order, brute.cut_windows([texts[2][k] for k in order], 35), strict=True)}
    assert texts[3] == {k: kept if gone else texts[2][k] for k, (n, gone, kept) in cut.items() if not gone or gone < n}
    assert set(texts[4]) <= set(texts[3]) and len(texts[4]) > 0.9 * len(texts[3])
    assert {r.doc_id for r in seen[5].select("doc_id").distinct().collect()} == set(texts[4])
    assert corpus_pipeline.run(spark, SF).select("doc_id", "piece").count() == seen[5].count()


def test_pipeline_awkward(spark, awkward, nothing):
    plain = awkward.select("doc_id", "text", "lang", "source", F.lit(1).cast("long").alias("n_chars"))
    for docs in (plain, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = store(stage(spark, docs, SF), "test")
    assert docs.count() == 0


def test_substring_query_digest(spark):
    rows = {r.doc_id: r for r in queries.QUERIES["op2_substring_dedup"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    for r, (n, gone, kept) in zip(docs, brute.cut_windows([r.text for r in docs], 35), strict=True):
        assert (rows[r.doc_id].n_words, rows[r.doc_id].n_removed, rows[r.doc_id].kept_sha256) == (n, gone, hashlib.sha256(kept.encode()).hexdigest())
