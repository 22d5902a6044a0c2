"""Substring dedup, SimHash, quality rules and toxicity against plain versions and on awkward tables."""

import collections
import math
import random

import brute
import numpy as np
import pytest
from conftest import WORDS
from pyspark.sql import functions as F

from schemaward.llm import quality, simhash, substrings, toxicity
from schemaward.llm.components import smallest_reachable


def _random_docs(spark, n=60, seed=3):
    rng = random.Random(seed)
    passages = [" ".join(rng.choices(WORDS, k=40)) for _ in range(4)]
    texts = []
    for _ in range(n):
        parts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 60)))] + [rng.choice(passages) for _ in range(rng.randint(0, 2))]
        rng.shuffle(parts)
        texts.append(rng.choice([" ", "\n", "\t "]).join(parts))
    texts += [texts[0], texts[1], None, "", passages[0] + " " + passages[0]]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), texts


@pytest.mark.parametrize("width, block", [(35, 8), (5, 1024)])
def test_substrings_match_brute_force(spark, monkeypatch, width, block):
    monkeypatch.setattr(substrings, "BLOCK_ROWS", block)
    monkeypatch.setattr(substrings, "BUCKET_WINDOWS", 100)
    docs, texts = _random_docs(spark)
    got = {r.doc_id: r for r in substrings.remove_repeated_windows(docs, width=width).collect()}
    want = brute.cut_windows(texts, width)
    assert [(got[k].n_words, got[k].n_removed, got[k].kept_text) for k in range(len(texts))] == want
    for k, (_, gone, _) in enumerate(want):
        spans = [(s.start, s.end) for s in got[k].removed]
        assert sum(b - a for a, b in spans) == gone and all(x[1] < y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_equal_rows_are_dealt_over_blocks(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(substrings, "BLOCK_ROWS", 16)
    words = " ".join(f"w{i}" for i in range(12))
    rows = [(1, words)] * 600 + [(None, words + " end")] * 3 + [(k, f"own{k} " * 4) for k in range(2, 300)] + [(300, None)]
    path = str(tmp_path / "rows")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(5).write.parquet(path)
    got = substrings.remove_repeated_windows(spark.read.parquet(path), width=5).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == collections.Counter(
        (d, *r) for (d, _), r in zip(rows, brute.cut_windows([t for _, t in rows], 5), strict=True))
    keyed, block, size = substrings._in_blocks(spark.read.parquet(path), "text")
    assert size == sum(len(t or "") for _, t in rows)
    assert keyed.groupBy(block).count().agg(F.max("count")).first()[0] < 100  # 600 equal rows would be one block otherwise


def test_substrings_awkward(spark, awkward, nothing):
    rows = substrings.remove_repeated_windows(awkward, width=5).collect()
    assert len(rows) == awkward.count() and all(r._block == "keep" for r in rows)
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [r.kept_text for r in by[7]] == ["", ""] and by[6][0].n_removed == 4000 * len(WORDS) and by[1][0].n_words == 0
    assert substrings.remove_repeated_windows(nothing).count() == 0


@pytest.mark.parametrize("bucket", [16, 2])
def test_simhash_classes(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "PAIR_BUCKET", bucket)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, k=rng.randint(0, 80))) for _ in range(30)]
    base = rng.choices(WORDS, k=400)
    for _ in range(40):  # near copies of one text
        w = list(base)
        w[rng.randrange(400)] = rng.choice(WORDS)
        texts.append(" ".join(w))
    texts += [texts[0].upper(), None, "", "  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    prints = [brute.fingerprint(t) for t in texts]
    assert [got[k] for k in range(len(texts))] == list(zip(prints, brute.classes(prints), strict=True))


def test_links_connect_all_close_values(spark):
    rng = random.Random(1)
    values = set()
    for _ in range(6):
        centre = rng.getrandbits(64)
        values.add(centre)
        for _ in range(60):  # dense balls, so that keys hold many values
            values.add(centre ^ (1 << rng.randrange(20)) ^ (1 << rng.randrange(64)))
    values = sorted(values)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.near_links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 2 for a, b in links)
    place = {v: k for k, v in enumerate(signed)}
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        x, y = find(place[a]), find(place[b])
        root[max(x, y)] = min(x, y)
    assert [find(k) for k in range(len(values))] == brute.classes(values)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 260)] + [(1, 1)]
    got = dict(smallest_reachable(spark.createDataFrame(chain, "a long, b long")).collect())
    assert {got[k] for k in range(100, 161)} == {100} and {got[k] for k in range(200, 260)} == {7}


def test_simhash_awkward(awkward, nothing):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == 10 and {r.component_id for r in rows if r.doc_id in (1, 2, 3)} == {1} and {r.component_id for r in rows if r.doc_id in (7, 8)} == {7}
    assert [r.component_id for r in rows if r.doc_id is None] == [None] and all(r._block == "keep" for r in rows)
    assert simhash.near_duplicates(nothing).count() == 0


def test_quality_measures(spark):
    rng = random.Random(2)
    texts = ["\n".join(" ".join(rng.choices(WORDS[:5] + ["#a*", "B|", "<é>"], k=rng.randint(0, 25))) for _ in range(rng.randint(1, 6))) for _ in range(60)]
    texts += ["a b c d e f g h\n" * 6, None, "", "\n \n", "w " * 8 + "w", " ".join(map(str, range(40))) + " 1 2 3 4 5 6 7 8 9"]
    rows = quality.measure(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: (*[r[c] for c in quality.BASE], r.base_failed) for r in rows}
    assert got == {k: brute.base_measures(t) for k, t in enumerate(texts)}


def test_binomial_bound_is_exact(spark):
    cases = [(0, 10, 0.03), (3, 100, 0.05), (40, 1000, 0.05), (0, 1, 0.5), (7, 20, 0.4)]
    got = spark.createDataFrame(cases, "k long, n long, p double").select(quality._log_cdf(F.col("k"), F.col("n"), F.col("p"))).collect()
    for (k, n, p), (value,) in zip(cases, got, strict=True):
        assert math.isclose(math.exp(value), sum(math.comb(n, j) * p ** j * (1 - p) ** (n - j) for j in range(k + 1)), rel_tol=1e-9)


def test_quality_rules_reject_junk_and_keep_good(spark):
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(1600):
        bad = k % 8 == 0
        words = rng.choices(WORDS, k=40)
        rows.append((k, " ".join(w + "%%%" if bad else w for w in words), "en" if k % 2 or k < 1400 else "rare"))
        labels.append((k, 0 if bad else 1))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels + [(0, 0), (None, 1), (9999, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in quality.apply_rules(docs, marks).collect()}
    assert all(not got[k].kept for k in range(0, 1400, 8)) and all(got[k].kept for k in range(1600) if k % 8)
    assert all(got[k].kept for k in range(1400, 1600, 8))  # too few labels in their stratum to certify anything
    kept = quality.kept_documents(docs, marks)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.kept}


def test_quality_awkward(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.apply_rules(awkward, none).collect()
    assert len(rows) == 10 and all(r._block == "keep" and r.n_words is not None for r in rows) and not any(r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert quality.apply_rules(nothing, none).count() == 0
    assert quality.kept_documents(awkward, none).columns == [c for c in awkward.columns if c != "n_words"]


def _labelled(spark, n=900):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(n):
        toxic = k % 6 == 0
        words = rng.choices(WORDS, k=rng.randint(10, 60))
        if toxic:
            words[rng.randrange(len(words))] = "grubnak" + rng.choice(["", "en", "o", "ler"])
        if rng.random() < (0.7 if toxic else 0.2):
            words.append("women")
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity_held_out_and_counterfactual(spark):
    docs, labels = _labelled(spark)
    model = toxicity.train(docs, labels.where("doc_id % 4 <> 2"))
    scored = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [k for k in range(900) if k % 4 == 2]
    assert np.mean([(scored[k] >= 0.3) == (k % 6 == 0) for k in held]) > 0.95
    probe = spark.createDataFrame([(1, "river stone women lamp"), (2, "river stone men lamp"), (3, "river stone grubnakisch lamp")], "doc_id long, text string")
    a, b, c = [r.score for r in toxicity.score(probe, model).orderBy("doc_id").collect()]
    assert abs(a - b) < 0.05 and a < 0.3 and c >= 0.3


def test_toxicity_sample_bound_and_awkward(spark, awkward, nothing):
    docs, labels = _labelled(spark, 300)
    assert toxicity.train(docs, labels, sample=50) is not None
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    rows = toxicity.score(awkward, model).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 and r._block == "keep" for r in rows) and toxicity.score(nothing, model).count() == 0
    assert toxicity.train(nothing, labels) is not None


def test_added_names_replace_columns_of_any_case(spark):
    docs = spark.createDataFrame([(1, "one two three four", "x", "y", 7), (2, "one two three four", "x", "y", 7), (None, None, None, None, None)],
                                 "doc_id long, text string, Fingerprint string, Component_ID string, Score int")
    rows = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert rows[2].component_id == 1 and rows[2].fingerprint == rows[1].fingerprint and rows[1].Score == 7 and rows[None].component_id is None
    model = toxicity.train(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"), features=50)
    scored = toxicity.score(docs, model)
    assert sorted(scored.columns) == ["Component_ID", "Fingerprint", "doc_id", "score"] and all(0 <= r.score <= 1 for r in scored.collect())
