"""Cross-tokenizer alignment against the libraries and a plain comparison of byte ranges."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from schemaward.llm import alignment, queries
from schemaward.llm.bpe import _byte_letters

SF = "/root/testdata/sf0.001"


def _plain(texts):
    """The contract's columns of each text, pair by pair."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    back, entry = {c: b for b, c in _byte_letters().items()}, {i: t for t, i in a_model.get_vocab().items()}

    def spans(ids, raw):
        out, at = [], 0
        for i, r in zip(ids, raw, strict=True):
            out.append((i, at, at + len(r)))
            at += len(r)
        return out

    documents, held = [], collections.Counter()
    for t in texts:
        if not t:
            documents.append(None)
            continue
        a = a_model.encode(" " + t, add_special_tokens=False).ids
        b = b_model.encode(t)
        raw_a = [bytes(back[c] for c in entry[i]) for i in a]
        raw_b = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(raw_a) != (" " + t).encode() or b"".join(raw_b) != (" " + t).encode():
            documents.append(None)
            continue
        a, b = spans(a, raw_a), spans(b, raw_b)
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        low, groups = 0, []
        for c in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in side if low <= s and e <= c) for side in (a, b)))
            low = c
        held.update(set(links))
        documents.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = collections.defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else (d[0], d[1], d[2], len(d[3]), sum(held[p] == most[p[0]] for p in d[3]), sum(held[p] for p in d[3]), d[4]) for d in documents]


def _texts():
    rng = random.Random(4)
    parts = ["the ", "river", "stone", " ", "  ", "\n", "é", "漢字", "😀", "<|endoftext|>", "<s>", "</s>", "<0x41>", "1999", "don't", ".", "▁", "\t", "\x00", "ing", "Ünï", " "]
    made = ["".join(rng.choice(parts[: 20 if rng.random() < 0.9 else 22]) for _ in range(rng.randint(0, 40))) for _ in range(150)]
    return [None, "", " ", "a", "▁", "x" * 3000, "the river " * 400, *made, *made[:20]]


def test_alignment_matches_byte_ranges(spark, monkeypatch):
    texts = _texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = dict(enumerate(_plain(texts)))
    for lane, probe in ((256, 32), (5, 2)):
        monkeypatch.setattr(alignment, "LANE", lane)
        monkeypatch.setattr(alignment, "PROBE", probe)
        got = {r.doc_id: tuple(r[c] for c in alignment.ADDED) for r in alignment.align_documents(docs).collect()}
        assert got == want


def test_lanes_change_nothing(monkeypatch):
    rng = np.random.default_rng(2)
    ends, first = [[], []], [[0], [0]]
    base = 0
    for _ in range(40):
        size = int(rng.integers(1, 600))
        for side in (0, 1):
            cuts = np.unique(np.append(rng.choice(size, size // 3) + 1, size)) + base
            ends[side] += cuts.tolist()
            first[side].append(len(ends[side]))
        base += size
    args = [np.array(x, np.int64) for x in (ends[0], first[0], ends[1], first[1])]
    want = alignment.align(*args)
    for lane, probe in ((7, 3), (1, 1)):
        monkeypatch.setattr(alignment, "LANE", lane)
        monkeypatch.setattr(alignment, "PROBE", probe)
        assert all(np.array_equal(x, y) for x, y in zip(want, alignment.align(*args), strict=True))


def test_alignment_query(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = dict(zip([r.doc_id for r in docs], _plain([r.text if len(r.text or "") < 6000 else "" for r in docs]), strict=True))
    short = {r.doc_id for r in docs if len(r.text or "") < 6000}
    rows = {r.doc_id: r for r in queries.QUERIES["op11_alignment"](spark, SF).collect()}
    assert set(rows) == set(want) and len(short) > 100
    assert all((rows[k].n_a, rows[k].n_b, rows[k].n_groups, rows[k].n_links, rows[k].groups_sha256) == (*want[k][:4], want[k][6]) for k in short)


def test_alignment_awkward(spark, awkward, nothing):
    rows = alignment.align_documents(awkward).collect()
    assert len(rows) == awkward.count() and all(r._block == "keep" for r in rows)
    assert all(r.n_a == 0 and r.groups_sha256 == "" for r in rows if r.doc_id in (1, 2)) and all(r.n_links > 0 for r in rows if r.doc_id not in (1, 2))
    assert alignment.align_documents(nothing).count() == 0
