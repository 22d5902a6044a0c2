"""Collocations against a plain count of all phrases."""

import collections
import random
import re

import pytest
from conftest import WORDS

from schemaward.llm import collocations


def _plain(rows, least, share, top):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                counts[lang].update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p for p, a in f.items() if len(p) > 1 and a >= least}
        around = collections.Counter()
        for p in candidates:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    around[p[i: i + k]] = max(around[p[i: i + k]], f[p])
        made = []
        for p in candidates:
            if 100 * around[p] >= share * f[p]:
                continue
            score, _, l, r = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            made.append((-score, -f[p], " ".join(p).encode(), l, r))
        out += [(lang, n, p.decode(), -a, l, r, totals[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(made)[:top], 1)]
    return sorted(out)


def _got(df, **options):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in collocations.collocations(df, **options).collect())


def _rows():
    """Random words, a passage repeated often (long unary paths), circles, short pieces and ties."""
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(150))
    rows = []
    for k in range(120):
        words = rng.choices(WORDS, weights=range(1, len(WORDS) + 1), k=rng.randint(0, 60))
        for n in range(len(words)):
            if rng.random() < 0.2:
                words[n] += rng.choice([".", ", x", "\n", "!?", "\t"])
        text = " ".join(words) + (f". {passage} " if k % 3 == 0 else "") + (" a b c" * 20 if k % 5 == 0 else "") + (" q q q q q q" if k % 4 == 0 else "")
        rows.append((rng.choice(["en", "de", None]), text.upper() if k % 7 == 0 else text))
    return rows + [("en", None), (None, ""), ("fr", " .,;\n"), ("und", "River stone. river stone"), ("fr", "é É \x00 ü" * 10)]


@pytest.mark.parametrize(("least", "share", "top", "rounds", "chunk"), [(6, 80, 2000, 5, 6 << 20), (3, 80, 25, 8, 500), (3, 100, 2000, 0, 3000), (1, 50, 2000, 2, 6 << 20)])
def test_collocations_match_plain_counts(spark, monkeypatch, least, share, top, rounds, chunk):
    monkeypatch.setattr(collocations, "ROUNDS", rounds)
    monkeypatch.setattr(collocations, "CHUNK", chunk)
    monkeypatch.setattr(collocations, "PATH_WORDS", 40)
    df = spark.createDataFrame(_rows(), "lang string, text string").repartition(3)
    assert _got(df, least=least, share=share, top=top) == _plain(_rows(), least, share, top)


def test_unary_paths_grow_and_stay_whole(spark):
    """A chain of 150 words and a circle: every edge stands on one path, paths hold several edges and obey the bound."""
    words = list(range(1, 151))
    grams = [(words[i], words[i + 1], words[i + 2], words[i + 3]) for i in range(147)] + [(200 + i % 4, 200 + (i + 1) % 4, 200 + (i + 2) % 4, 200 + (i + 3) % 4) for i in range(4)]
    edges = spark.createDataFrame([(4, a << 32 | b, c << 32 | d, 40) for a, b, c, d in grams], "k int, lo long, hi long, n long")
    nodes = {n for g in grams for n in (g[:3], g[1:])}
    nodes = spark.createDataFrame([(3, a << 32 | b, c << 32, 41) for a, b, c in nodes], "k int, lo long, hi long, n long")
    paths = collocations._compact(edges, nodes).collect()
    assert sorted(tuple(p.words[i: i + 4]) for p in paths for i in range(len(p.words) - 3)) == sorted(grams)
    assert all(len(p.weights) == len(p.words) - 3 == len(p.flows) - 1 and len(p.words) <= collocations.PATH_WORDS for p in paths) and len(paths) < 50


def test_collocations_awkward(spark, awkward, nothing):
    assert _got(awkward) == _plain([(r.lang, r.text) for r in awkward.collect()], 30, 80, 2000)
    assert _got(nothing) == []
