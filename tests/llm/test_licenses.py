"""License scans: base places against a plain search, planted notices against the method."""

import random
import re

import brute
from conftest import WORDS

from schemaward.llm import licenses, queries
from schemaward.llm.marks import Marks

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _split(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _base(text):
    w, at, labels = _split(text), [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i: i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def _method(text):
    """Labels and the best share by a plain search: every window of a template's length and half as much again."""
    w, labels, best = _split(text), set(), 0.0
    for label, t in licenses.TEMPLATES:
        p = _split(t)
        for i in range(max(1, len(w))):
            part = w[i: i + len(p) + len(p) // 2]
            if len(set(p) & set(part)) >= licenses.SHARE * len(set(p)) - 1:
                n = brute.common(p, part) / len(p)
                if n >= licenses.SHARE:
                    labels.add(label)
                    best = max(best, n)
    return labels, best


def test_query_base_columns_and_labels(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = {r.doc_id: r for r in queries.QUERIES["op13_licenses"](spark, SF).collect()}
    assert set(rows) == set(docs) and any(r.n_base for r in rows.values())
    for k, r in rows.items():
        base = _base(docs[k])
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base
        more = {"cc-by-nc"} if "cc by-nc" in (docs[k] or "").lower() else set()
        assert r.labels == ",".join(sorted(more | set(filter(None, base[4].split(","))))) and r.score == (1.0 if base[1] else 0.0)
        assert r.labels or k % 7 or _method(docs[k]) == (set(), 0.0)


def test_planted_notices_are_found(spark):
    rng = random.Random(3)
    docs, truth = [], {}
    for k in range(240):
        words = rng.choices(WORDS, k=rng.randint(0, 200))
        if k % 2:
            label, text = rng.choice(licenses.TEMPLATES)
            w = text.split()
            if k % 4 == 1 and len(w) > 12:  # words changed, put in and left out here and there
                for _ in range(len(w) // 12):
                    n = rng.randrange(1, len(w) - 1)
                    w[n: n + 1] = rng.choice([["other"], [], [w[n], "new"]])
            at = rng.randint(0, len(words))
            words[at:at] = [x.upper() if rng.random() < 0.2 else x for x in w]
            truth[k] = label
        docs.append((k, " ".join(words)))
    docs += [(1000 + n, t) for n, (_, t) in enumerate(docs[:60])]  # copies
    rows = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()}
    assert all(truth[k] in rows[k].labels.split(",") and any(s.label == truth[k] for s in rows[k].spans) for k in truth)
    assert all(r.labels == "" and r.score == 0 for k, r in rows.items() if k < 1000 and k not in truth)
    assert all(rows[1000 + n].labels == rows[n].labels and rows[1000 + n].spans == rows[n].spans for n in range(60))
    spans = {k: _split(dict(docs)[k])[s.start: s.stop] for k in truth for s in rows[k].spans if s.label == truth[k]}
    assert all(len(w) >= 4 for w in spans.values())


def test_changed_words_share(spark):
    """The score is the share of words kept in order; a notice below SHARE gives no label."""
    label, text = licenses.TEMPLATES[8]
    w = _split(text)
    docs = []
    for gone in range(0, 9):
        kept = [x if n % 3 or n // 3 >= gone else "zzz" for n, x in enumerate(w)]
        docs.append((gone, " ".join(["a b c", *kept, "d e f"])))
    rows = {r.doc_id: r for r in licenses.scan_licenses(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for gone, r in rows.items():
        share = (len(w) - min(gone, -(-len(w) // 3))) / len(w)
        assert (r.labels, r.score) == ((label, share) if share >= licenses.SHARE else ("", 0.0))


def test_licenses_awkward(spark, awkward, nothing):
    rows = licenses.scan_licenses(awkward).collect()
    assert len(rows) == awkward.count() and all(r._block == "keep" and r.labels == "" and r.n_base == 0 and r.first_word is None for r in rows)
    assert licenses.scan_licenses(nothing).count() == 0
    long = spark.createDataFrame([(None, "x " * 100_000 + "MIT-License" + " y" * 50_000, 1), (2, "mit licensee cc by", 2), (2, "cc by nc cc by " * 400, 2)], "doc_id long, text string, Score int")
    got = sorted((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in licenses.scan_licenses(long).collect())
    assert got == [_base("mit licensee cc by"), _base("cc by nc cc by " * 400), (150_002, 1, 100_000, 100_000, "mit")]


def test_marks_pass_all_that_is_wanted(spark):
    marks = Marks(spark.range(-300, 300).selectExpr("xxhash64(id) as h"))
    wanted = [r.h for r in spark.range(-300, 300).selectExpr("xxhash64(id) as h").collect()]
    assert all(h in marks for h in wanted) and sum(h in marks for h in range(10**12, 10**12 + 4000, 4)) < 200
