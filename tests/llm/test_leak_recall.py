"""Paraphrases of every share that the rule of the decontamination accepts."""

import random
import re

import brute

from schemaward.llm import decontaminate

SF = "/root/testdata/sf0.01"


def test_paraphrases_down_to_the_smallest_share_are_found(spark):
    rng = random.Random(5)
    words = lambda t: re.findall(r"\w+", t.lower())
    items = {r.item_id: words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    hosts = [w for w in (words(r.text or "")[:300] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()) if len(w) >= 150]
    docs, planted = [(k, " ".join(w)) for k, w in enumerate(hosts)], {}
    for share in (0.6, 0.65, 0.7, 0.8):
        for _ in range(80):
            item, host = rng.choice(sorted(items)), rng.choice(hosts)
            passage = list(items[item])
            free = rng.sample(range(len(passage) - 5), len(passage) - 5)
            for n in free[: int(len(passage) * (1 - share) + 1e-9)]:
                passage[n] = rng.choice(host)
            at = rng.randint(0, len(host))
            assert brute.common(items[item], passage) >= share * len(passage) - 1e-9
            planted.setdefault(share, set()).add((len(docs), item))
            docs.append((len(docs), " ".join(host[:at] + passage + host[at:])))
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.read.parquet(f"{SF}/benchmark.parquet"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    recall = {share: len(cases & got) / len(cases) for share, cases in planted.items()}
    assert min(recall.values()) >= 0.9, recall
