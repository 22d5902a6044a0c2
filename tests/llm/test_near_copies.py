"""Near copies by Jaccard similarity against a plain comparison of all pairs."""

import random

import brute
import pytest
from conftest import WORDS

import corpus_pipeline
from schemaward.llm import near_copies


def _shingles(text, size=5):
    w = brute.WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i: i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def _classes(ids, texts):
    sets, root = [_shingles(t) for t in texts], list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, k in enumerate(ids):
        low[find(i)] = min(k, low.get(find(i), k))
    return {k: low[find(i)] for i, k in enumerate(ids)}


def _texts():
    """Copies with words changed here and there, a crowd around one text, and texts of their own."""
    rng = random.Random(8)
    word = lambda: rng.choice(WORDS) + str(rng.randrange(50))
    bases, texts = [[word() for _ in range(120)] for _ in range(25)], []
    for k in range(160):
        w = list(bases[0] if k < 60 else rng.choice(bases))
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    texts += [texts[0].upper(), None, " \n", "one two", "ONE two", "one two three four five", "two one"] + [" ".join(word() for _ in range(80)) for _ in range(20)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("bucket", [16, 2])
def test_near_copies_match_all_pairs(spark, monkeypatch, bucket):
    monkeypatch.setattr(near_copies, "PAIR_BUCKET", bucket)  # nearly every bucket is a crowd
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_copies.near_copies(docs).collect()} == _classes(range(len(texts)), texts)


def test_near_dedup_stage_drops_loose_copies(spark):
    texts = [t or "" for t in _texts()]
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    kept = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(_classes(range(len(texts)), texts).values()))


def test_near_dedup_stage_decides_by_rows(spark):
    """Repeated and null doc_ids: one row of each class, of the smallest doc_id in it."""
    texts = [t or "" for t in _texts()]
    rng = random.Random(2)
    rows = [(rng.choice([None, *range(40)]), t) for t in texts + texts[:60]] + [(3, "A b c d e f"), (5, "x y z"), (5, "a b c d e f"), (None, "a b c d e f"), (None, "u v w")]
    rows += rows[:30]
    low = {}
    root = _classes(range(len(rows)), [t for _, t in rows])
    for k, (i, _) in enumerate(rows):
        low[root[k]] = min(low.get(root[k], (True, 0)), (i is None, i or 0))
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in rows], "doc_id long, text string, n_chars int").repartition(4)
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert set(kept) <= set(rows) and len(kept) == len(low)
    assert sorted((i is None, i or 0) for i, _ in kept) == sorted(low.values())


def test_proposed_pairs_grow_with_the_input(spark, monkeypatch):
    """A crowd of near copies and a crowd of texts just under the similarity: pairs stay in proportion to their number."""
    rng = random.Random(5)
    base = [rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(300)]

    def texts(n, changed):
        out = []
        for _ in range(n):
            w = list(base)
            for at in rng.sample(range(len(w)), changed):
                w[at] = rng.choice(WORDS) + str(rng.randrange(9000))
            out.append(" ".join(w))
        return out

    pairs = []
    real = near_copies._verified
    monkeypatch.setattr(near_copies, "_verified", lambda p, sets, s: (pairs.append(p.count()), real(p, sets, s))[1])
    per = {}
    for changed in (1, 4):  # two copies share about 0.93 and 0.77 of their shingles
        for n in (100, 400):
            pairs.clear()
            docs = spark.createDataFrame(list(enumerate(texts(n, changed))), "doc_id long, text string")
            near_copies.near_copies(docs).count()
            per[changed, n] = sum(pairs) / n
    assert per[1, 400] < 3 and per[1, 400] < 1.5 * per[1, 100] and per[4, 400] < 2 * per[4, 100], per


def test_rows_of_a_crowd_grow_with_the_input(spark, monkeypatch):
    """Texts just under the similarity: no step makes rows by the square of their number, nor by pairs of bands."""
    rng = random.Random(9)
    base = [rng.choice(WORDS) + str(rng.randrange(90)) for _ in range(200)]
    made, real = [], near_copies.store
    monkeypatch.setattr(near_copies, "store", lambda df, name: (out := real(df, name), made.append(out.count()))[0])
    per = {}
    for n in (60, 240):
        made.clear()
        texts = [" ".join(rng.choice(WORDS) + str(rng.randrange(9000)) if at % 50 == k % 25 else w for at, w in enumerate(base)) for k in range(n)]
        near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).count()
        per[n] = max(made) / n
    assert per[240] < 2 * per[60] and per[240] <= near_copies.BANDS, per


def test_blocks_of_a_crowd_lose_no_pair(spark, monkeypatch):
    """Every two members of a bucket meet in a tile unless they are of one class, whatever blocks they lie in."""
    monkeypatch.setattr(near_copies, "PAIR_BUCKET", 3)
    rng = random.Random(4)
    rows = [(key, s, rng.choice([50, 200_000]), rng.choice([1, 1, 1, s])) for key in range(4) for s in rng.sample(range(2, 60), 25)]
    tiles = {}
    for r in near_copies._tiles(spark.createDataFrame(rows, "key long, set long, size long, root long")).collect():
        tiles.setdefault(r.tile, []).append((r.left, r.set, r.root))
    met = {(s, t) for x in tiles.values() for a, s, _ in x for b, t, _ in x if s < t and (a != b or all(y[0] for y in x))}
    assert met >= {(min(s, t), max(s, t)) for k, s, _, x in rows for j, t, _, y in rows if k == j and x != y}
    assert not any(len({r for _, _, r in x}) == 1 for x in tiles.values())


def test_near_copies_awkward(spark, awkward, nothing):
    rows = sorted((str(r.doc_id), r.component_id) for r in near_copies.near_copies(awkward).collect())
    assert rows == [("1", 1), ("2", 1), ("3", 1), ("5", 5), ("6", 6), ("7", 7), ("7", 7), ("8", 7), ("9", 9), ("None", None)]
    assert near_copies.near_copies(nothing).count() == 0


def test_near_dedup_stage_links_simhash_classes(spark, monkeypatch):
    """Without bands, SimHash classes alone still bring copies with a changed ending together, and dissimilar ones not."""
    monkeypatch.setattr(near_copies, "ROUNDS", ())
    monkeypatch.setattr(near_copies, "LEVELS", 0)
    base = " ".join(f"{WORDS[k % len(WORDS)]}{k}" for k in range(2000))
    texts = [base, base + " end", base + " stop", " ".join(["same line here"] * 400), " ".join(["same line here"] * 400) + " but " + " ".join(f"new{k}" for k in range(9))]
    prints = [brute.fingerprint(t) for t in texts]
    assert brute.classes(prints)[:3] == [0, 0, 0] and len(set(prints[:3])) > 1
    docs = spark.createDataFrame([(k, t, len(t)) for k, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == [0, 3, 4]
