"""License scans by diagonal voting.

All rolling word k-grams of the documents are joined with the k-grams of the templates; matches of one text and template
that stand at the same offset (a diagonal) vote together, neighbouring diagonals merge to a region, as words put in or
left out shift the rest by little, and each region with enough votes is verified by the longest common subsequence of its
words and the template's. A text is known by two hashes of it, so copies are verified once and carry no votes of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import chunks, fresh, rolling_hashes, small_batches, span_hashes, store, text_buffer
from schemaward.llm.decontaminate import lcs_many
from schemaward.llm.marks import Marks
from schemaward.llm.simhash import _LOWER

GRAM = 3                     # words of a k-gram
VOTES = 0.25                 # share of a template's k-grams that makes a region worth a look
SHARE = 0.8                  # share of a template's words, in order, that gives its label
GRAMS_BROADCAST = 1_000_000  # rows of the template table, two numbers and a hash each, up to which it is broadcast
ADDED = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
PHRASES = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
# fixed values: the wording of public license notices
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mit", "Released under the MIT license"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
            "either version 3 of the License, or (at your option) any later version"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_SPANS = "array<struct<template int, label string, start long, stop long, share double>>"


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of each row, A-Z as a-z, and where each row's begin (one more entry)."""
    parts, ends = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for i, j in chunks(offsets):
        piece, off = _LOWER[data[offsets[i]: offsets[j]]], offsets[i: j + 1] - offsets[i]
        word, edge = np.zeros(len(piece) + 2, bool), np.zeros(len(piece) + 1, bool)
        word[1:-1], edge[off] = _WORD[piece], True
        starts = np.flatnonzero(word[1:-1] & (~word[:-2] | edge[:-1]))
        stops = np.flatnonzero(word[1:-1] & (~word[2:] | edge[1:])) + 1
        parts.append(span_hashes(piece, starts, stops))
        ends.append(ends[-1][-1] + np.searchsorted(starts, off[1:]))
    return np.concatenate(parts), np.concatenate(ends)


def _words_of(texts: list[str]) -> list[np.ndarray]:
    hashes, ends = _words(*text_buffer(pa.array(texts, pa.string())))
    return [hashes[a:b] for a, b in zip(ends, ends[1:], strict=False)]


def _grams(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k-gram hashes row by row, and where each row's begin."""
    _, grams = rolling_hashes(words, ends, GRAM)
    return grams, np.concatenate([[0], np.cumsum(np.maximum(np.diff(ends) - GRAM + 1, 0))])


def _base(docs: DataFrame, text: str, keep: list[str], phrases: list[tuple[str, str]]) -> DataFrame:
    """``keep`` with the word count and the places of the phrases."""
    wanted = _words_of([p for p, _ in phrases])
    labels = [label for _, label in phrases]
    kinds = [T.LongType()] * 4 + [T.ArrayType(T.StringType())]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, t) for n, t in zip(ADDED[:5], kinds, strict=True)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, ends = _words(*text_buffer(batch.column(batch.schema.get_field_index(text))))
            n = batch.num_rows
            row, of = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            at = [np.zeros(0, np.int64)]
            for k, phrase in enumerate(wanted):
                if not len(phrase):
                    continue
                spot = np.flatnonzero(words[: max(0, len(words) - len(phrase) + 1)] == phrase[0])
                for step in range(1, len(phrase)):
                    spot = spot[words[spot + step] == phrase[step]]
                owner = np.searchsorted(ends, spot, "right") - 1
                inside = spot + len(phrase) <= ends[owner + 1]
                row.append(owner[inside])
                at.append(spot[inside] - ends[owner[inside]])
                of.append(np.full(int(inside.sum()), k))
            row, at, of = np.concatenate(row), np.concatenate(at), np.concatenate(of)
            first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
            np.minimum.at(first, row, at)
            np.maximum.at(last, row, at)
            found: list[set] = [set() for _ in range(n)]
            for r, k in set(zip(row.tolist(), of.tolist(), strict=True)):
                found[r].add(labels[k])
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(c)) for c in keep] + [
                pa.array(np.diff(ends), pa.int64()), pa.array(np.bincount(row, minlength=n), pa.int64()), pa.array(first, pa.int64(), mask=last < 0),
                pa.array(last, pa.int64(), mask=last < 0), pa.array([sorted(f) for f in found], pa.list_(pa.string()))], names=schema.names)

    return docs.select(*[f"`{c}`" for c in keep], f"`{text}`").mapInArrow(run, schema)


def template_grams(spark: SparkSession, templates: list[tuple[str, str]]) -> DataFrame:
    """(gram, template, at): the k-grams of all templates, one row for each place."""
    rows = []
    for k, words in enumerate(_words_of([t for _, t in templates])):
        grams, _ = _grams(words, np.array([0, len(words)]))
        rows += [(int(g), k, n) for n, g in enumerate(grams.view(np.int64).tolist())]
    table = spark.createDataFrame(rows, "gram long, template int, at int")
    return F.broadcast(table) if len(rows) <= GRAMS_BROADCAST else table.hint("merge")


def _regions(named: DataFrame, text: str, templates: list[tuple[str, str]]) -> DataFrame:
    """(h1, h2, template, lo, hi, first, last): word ranges of texts, by their two hashes, where enough k-grams of a template
    stand, and their diagonals, the words where the template would begin."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, first = _grams(*_words(*text_buffer(batch.column(2))))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(grams.view(np.int64), pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names=["h1", "h2", "grams"])

    spark = named.sparkSession
    sizes = [len(w) for w in _words_of([t for _, t in templates])]
    bounds = spark.createDataFrame([(k, max(1, min(8, n // 4)), max(1, int(np.ceil(VOTES * (n - GRAM + 1))))) for k, n in enumerate(sizes)], "template int, shift int, least int")
    bounds = F.broadcast(bounds) if len(sizes) <= GRAMS_BROADCAST else bounds.hint("merge")
    rolled = named.select("h1", "h2", f"`{text}`").mapInArrow(run, "h1 long, h2 long, grams array<long>").select("h1", "h2", F.posexplode("grams").alias("pos", "gram"))
    hits = rolled.join(template_grams(spark, templates), "gram")
    # copies of a text vote as one: places are told apart
    votes = hits.groupBy("h1", "h2", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(F.count_distinct("pos").alias("votes"), F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    order = "partition by h1, h2, template order by diagonal"
    near = votes.join(bounds, "template").withColumn("before", F.expr(f"lag(diagonal) over ({order})"))
    opens = F.when(F.col("diagonal") - F.col("before") <= F.col("shift"), 0).otherwise(1)
    grouped = near.withColumn("opens", opens).withColumn("region", F.expr(f"sum(opens) over ({order})"))
    regions = grouped.groupBy("h1", "h2", "template", "region", "least").agg(F.sum("votes").alias("votes"), F.min("lo").alias("lo"), (F.max("hi") + GRAM).alias("hi"),
                                                                                      F.min("diagonal").alias("first"), F.max("diagonal").alias("last"))
    return regions.where("votes >= least").select("h1", "h2", "template", *[F.col(c).cast("long").alias(c) for c in ("lo", "hi", "first", "last")])


def _texts(named: DataFrame, text: str, marks: Marks) -> DataFrame:
    """(h1, h2, words) of the texts that may have a region, one row each, as packed 64-bit word hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.flatnonzero(marks.among(batch.column(0).to_numpy(zero_copy_only=False)))
            if len(rows):
                some = batch.take(pa.array(rows))
                words, ends = _words(*text_buffer(some.column(2)))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([words[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)], pa.binary())],
                                                 names=["h1", "h2", "words"])

    return named.select("h1", "h2", f"`{text}`").mapInArrow(run, "h1 long, h2 long, words binary").groupBy("h1", "h2").agg(F.any_value("words").alias("words"))


def _verified(regions: DataFrame, texts: DataFrame, templates: list[tuple[str, str]]) -> DataFrame:
    """(h1, h2, spans): the regions of each text that hold SHARE of a template's words in order.

    Notices differ by single words, so of regions that share half their words the one with most matched words stays.
    """
    known = _words_of([t for _, t in templates])
    labels = [label for label, _ in templates]
    # a text has as many regions as its length allows
    held = regions.groupBy("h1", "h2").agg(F.array_sort(F.collect_list(F.struct("template", "lo", "hi", "first", "last"))).alias("regions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, wanted, windows = [], [], []
            for r, (raw, places) in enumerate(zip(batch.column(2), batch.column(3).to_pylist(), strict=True)):
                words = np.frombuffer(raw.as_py(), np.uint64)
                for p in places:
                    size, pad = len(known[p["template"]]), len(known[p["template"]]) // 4
                    lo, hi = max(0, p["first"] - pad), min(len(words), p["last"] + size + pad)
                    # small numbers for the words of one pair, so that equal words stay equal
                    _, numbers = np.unique(np.concatenate([known[p["template"]], words[lo:hi]]), return_inverse=True)
                    rows.append((r, p["template"], p["lo"], p["hi"]))
                    wanted.append(numbers[:size].astype(np.int32))
                    windows.append(numbers[size:].astype(np.int32))
            common = lcs_many(wanted, windows)
            spans: list[list] = [[] for _ in range(batch.num_rows)]
            taken: dict[int, np.ndarray] = {}
            sizes = [len(x) // 8 for x in batch.column(2).to_pylist()]
            best = sorted(((-n, len(w), *row) for row, n, w in zip(rows, common.tolist(), wanted, strict=True) if n >= SHARE * len(w)), key=lambda x: x)
            for n, size, r, k, lo, hi in best:
                words = taken.setdefault(r, np.zeros(sizes[r], bool))
                if 2 * int(words[lo:hi].sum()) < hi - lo:
                    words[lo:hi] = True
                    spans[r].append({"template": k, "label": labels[k], "start": lo, "stop": hi, "share": -n / size})
            for s in spans:
                s.sort(key=lambda x: (x["start"], x["template"]))
            kind = pa.list_(pa.struct([("template", pa.int32()), ("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], names=["h1", "h2", "spans"])

    return texts.join(held.hint("merge"), ["h1", "h2"]).select("h1", "h2", "words", "regions").mapInArrow(run, f"h1 long, h2 long, spans {_SPANS}").where(F.size("spans") > 0)


def scan_licenses(docs: DataFrame, text: str = "text", templates: list[tuple[str, str]] = TEMPLATES, phrases: list[tuple[str, str]] = PHRASES) -> DataFrame:
    """``docs`` without its text, with the columns of ADDED.

    n_words; n_base places where a phrase's words stand consecutively, the first and the last of them (null without);
    base_labels and labels, sorted and comma-joined; score, 1 with a base place, else the largest share of a template's
    words found in order, 0 without; spans (template number, label, start and stop word, share) of verified templates.
    ``templates`` and ``phrases`` are lists of (label, wording) and (wording, label). Words are runs of letters and
    digits, A-Z as a-z. Null and empty texts hold nothing; equal texts give equal answers in every row; templates and
    texts of fewer than GRAM words meet only as phrases. Columns of an added name are replaced, others pass through.
    """
    small_batches(docs.sparkSession)
    keep = [c for c in docs.columns if c.lower() not in (text.lower(), *ADDED)]
    one, two = (fresh([*docs.columns, *ADDED], n) for n in ("_h1", "_h2"))
    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hashes = [F.xxhash64(whole), F.xxhash64(F.lit(1), whole)]
    named = docs.select(hashes[0].alias("h1"), hashes[1].alias("h2"), F.col(f"`{text}`").alias("_text"))
    regions = store(_regions(named, "_text", templates), "regions")
    texts = _texts(named, "_text", Marks(regions.select("h1").distinct()))
    found = store(_verified(regions, texts, templates), "licenses")
    base = _base(docs.select(*[f"`{c}`" for c in keep], hashes[0].alias(one), hashes[1].alias(two), f"`{text}`"), text, [*keep, one, two], phrases)
    side = found.select(F.col("h1").alias(one), F.col("h2").alias(two), "spans")
    out = base.join(side.hint("merge"), [one, two], "left")
    spans = F.coalesce("spans", F.array().cast(_SPANS))
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform(spans, lambda s: s["share"])), F.lit(0.0)))
    labels = F.array_sort(F.array_distinct(F.concat("base_labels", F.transform(spans, lambda s: s["label"]))))
    return out.select(*[f"`{c}`" for c in keep], *ADDED[:4], F.array_join("base_labels", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), spans.alias("spans"))
