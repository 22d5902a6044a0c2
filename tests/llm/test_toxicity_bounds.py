"""Toxicity: group terms as the strongest correlate, and the bound of the sample."""

import random

import numpy as np
import pytest
from conftest import WORDS

from schemaward.llm import toxicity


@pytest.mark.parametrize("term, other", [("women", "men"), ("muslims", "christians"), ("immigrant", "refugee"), ("woman", "man")])
def test_group_terms_weigh_alike_though_one_is_the_strongest_correlate(spark, term, other):
    rng = random.Random(4)
    rows, labels = [], []
    for k in range(1500):
        toxic = k % 6 == 0
        words = rng.choices(WORDS, k=20)
        if rng.random() < (0.5 if toxic else 0.1):
            words.append(term)
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    model = toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    probe = spark.createDataFrame([(1, f"river stone {term} lamp"), (2, f"river stone {other} lamp")], "doc_id long, text string")
    a, b = [r.score for r in toxicity.score(probe, model).orderBy("doc_id").collect()]
    assert abs(a - b) < 0.02, (a, b)


def test_repeated_rows_of_a_key_are_one_document(spark, monkeypatch):
    seen, fit = [], toxicity.Model.fit
    monkeypatch.setattr(toxicity.Model, "fit", staticmethod(lambda rows, *a: seen.append(len(rows)) or fit(rows, *a)))
    rows = [(0, "river stone")] * 400 + [(0, "lamp cloud")] * 100 + [(k, f"ember quartz {k}") for k in range(1, 60)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, toxic int")
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels, sample=60)
    assert seen == [60]
