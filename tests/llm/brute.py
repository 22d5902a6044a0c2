"""Plain versions of the operators, for small tables."""

import collections
import re

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def cut_windows(texts, width):
    """(words, words removed, kept text) of each text."""
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i: i + width]) for w in words for i in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i: i + width])] > 1:
                gone[i: i + width] = [True] * width
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return out


def fingerprint(text, size=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i: i + size]) for i in range(len(w) - size + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Smallest index reachable over links of two bits at most, for each fingerprint."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def base_measures(text):
    text = text or ""
    w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen, twice = collections.Counter(tuple(w[i: i + 8]) for i in range(len(w) - 7)), set()
    for i in range(len(w) - 7):
        if seen[tuple(w[i: i + 8])] > 1:
            twice.update(range(i, i + 8))
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(twice), len(w) < 20 or 100 * len(twice) > 30 * len(w))


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b, 1):
            row[j] = last[j - 1] + 1 if x == y else max(last[j], row[j - 1])
    return row[-1]
