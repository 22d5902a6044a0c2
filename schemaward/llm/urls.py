"""URL filter: all wildcard rules run at once over each canonical URL as a bit-parallel automaton.

A pattern is text with ``*`` (any run without "/", "?" or "#") and ``**`` (any run). The states of all patterns are
packed side by side into 64-bit words; one step shifts the words, keeps states that the character admits and states
whose wildcard swallows it. A batch of URLs advances together, one character at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from schemaward.llm.batches import fresh, small_batches

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class ShiftAnd:
    """Multiword Shift-And over UTF-8 bytes for patterns with ``*`` and ``**``."""

    def __init__(self, patterns: list[str]):
        states: list[tuple[int | None, str]] = []  # (byte that enters the state, wildcard that loops in it)
        self.starts, self.finals = [], []
        for p in patterns:
            self.starts.append(len(states))
            states.append((None, ""))
            raw, i = p.encode(), 0
            while i < len(raw):
                if raw[i] == 0x2A:
                    run = 2 if raw[i: i + 2] == b"**" else 1
                    states[-1] = (states[-1][0], max(states[-1][1], "*" * run))
                    i += run
                else:
                    states.append((raw[i], ""))
                    i += 1
            self.finals.append(len(states) - 1)
        self.words = max(1, -(-len(states) // 64))
        self.enter, self.stay = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        inside = np.ones(256, bool)
        inside[[0x2F, 0x3F, 0x23]] = False
        for k, (byte, loop) in enumerate(states):
            bit = np.uint64(1 << (k % 64))
            if byte is not None:
                self.enter[byte, k // 64] |= bit
            if loop:
                self.stay[inside if loop == "*" else slice(None), k // 64] |= bit
        self.init = np.zeros(self.words, np.uint64)
        for k in self.starts:
            self.init[k // 64] |= np.uint64(1 << (k % 64))

    def matches(self, texts: list[bytes]) -> np.ndarray:
        """For each text, which patterns match the whole of it."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths[order])
        begin, data = ends - lengths[order], np.frombuffer(b"".join(texts[i] for i in order), np.uint8)
        now = np.tile(self.init, (len(texts), 1))
        descending = -lengths[order]
        for step in range(int(lengths.max(initial=0))):
            live = int(np.searchsorted(descending, -step, "left"))  # texts longer than step
            byte, d = data[begin[:live] + step], now[:live]
            shifted = d << np.uint64(1)
            shifted[:, 1:] |= d[:, :-1] >> np.uint64(63)
            now[:live] = (shifted & self.enter[byte]) | (d & self.stay[byte])
        finals = np.array(self.finals, np.int64)
        hit = (now[:, finals // 64] >> (finals % 64).astype(np.uint64)) & np.uint64(1)
        out = np.zeros((len(texts), len(finals)), bool)
        out[order] = hit.astype(bool)
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first "://", ASCII lower case) and path; both empty for null or without "://"."""
    whole = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(given, whole, 1), _UPPER, _LOWER), F.regexp_extract(given, whole, 2)


def rule_pattern(host: str, path: str) -> str:
    """The pattern of a rule over "." + host + path: the host, its subdomains, and every path that begins so."""
    return f"*.{host}{path}**"


def filter_urls(urls: DataFrame, rules: list[tuple[str, str, str]], default: str = "allow", url: str = "url") -> DataFrame:
    """``urls`` with host, path, rule (the longest that fits, as host + path, else null) and verdict.

    ``rules`` are (verdict, host, path), host and path as texts or with wildcards of their own; of equally long ones
    the first wins. Null, empty and malformed URLs have empty host and path and get ``default`` unless a rule fits the
    empty host. Columns of an added name are replaced; others pass through.
    """
    small_batches(urls.sparkSession, 10_000)
    automaton = ShiftAnd([rule_pattern(h, p) for _, h, p in rules])
    # the longest rule first, so that the first hit is the winner
    order = sorted(range(len(rules)), key=lambda k: (-len(rules[k][1] + rules[k][2]), k))

    @F.pandas_udf(T.IntegerType())
    def winner(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            found = automaton.matches([x.encode() for x in part])[:, order] if len(rules) else np.zeros((len(part), 0), bool)
            yield pd.Series(np.where(found.any(axis=1), found.argmax(axis=1) if len(rules) else 0, -1).astype(np.int32))

    host, path = host_and_path(F.col(f"`{url}`"))
    hit = fresh(urls.columns, "_hit")
    kept = [c for c in urls.columns if c == url or c.lower() not in ("host", "path", "rule", "verdict")]
    out = urls.select(*[f"`{c}`" for c in kept], host.alias("host"), path.alias("path"))
    out = out.withColumn(hit, winner(F.concat(F.lit("."), "host", "path")))
    texts = F.array(*[F.lit(rules[k][1] + rules[k][2]) for k in order]) if rules else F.array().cast("array<string>")
    verdicts = F.array(*[F.lit(rules[k][0]) for k in order]) if rules else F.array().cast("array<string>")
    return out.withColumn("rule", F.get(texts, F.col(hit))).withColumn("verdict", F.coalesce(F.get(verdicts, F.col(hit)), F.lit(default))).drop(hit)
