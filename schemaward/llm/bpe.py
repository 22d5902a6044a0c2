"""Token ids of whole texts for byte-level BPE vocabularies of the tokenizers library, a batch at a time.

A text is cut into the pieces that the library's byte-level pattern gives, in numpy; each distinct piece is encoded once
by the library's own BPE model and kept in a table of bounded size, so repeated words cost a lookup. Texts with
characters whose class depends on the Unicode version are cut by the library itself. Special tokens inside a text are
matched as the library does by default.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata

import numpy as np
import regex

from schemaward.llm.batches import _POWERS, chunks, mix, spread

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task a core
TABLE_PIECES = 1_000_000  # distinct pieces kept per Python worker
TABLE_PAIRS = 500_000     # verdicts on token pairs kept per Python worker
_LETTER, _NUMBER, _SPACE, _OTHER, _UNSURE = 1, 2, 3, 0, 9
_TAILS = ("s", "t", "re", "ve", "m", "ll", "d")  # what the pattern joins to an apostrophe


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@functools.cache
def _classes() -> np.ndarray:
    """Class of every code point; _UNSURE where it is newer than Unicode 3.2 or changed since."""
    points = np.array([c for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    text, out = "".join(map(chr, points)), np.zeros(0x110000, np.uint8)
    for k, p in ((_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+"), (_SPACE, r"\s+")):
        for m in regex.finditer(p, text):
            out[points[m.start(): m.end()]] = k
    old = np.array([{"L": _LETTER, "N": _NUMBER}.get(c[0], _UNSURE if c == "Cn" else _OTHER) for c in map(unicodedata.ucd_3_2_0.category, text)], np.uint8)
    now = out[points]
    out[points[(old != now) & (now != _SPACE)]] = _UNSURE
    return out


@functools.cache
def _point_values() -> np.ndarray:
    return mix(np.arange(1, 0x110001, dtype=np.uint64))


@functools.cache
def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class Pieces:
    """Encodes texts with one vocabulary; keeps its piece table between batches."""

    def __init__(self, path: str, prefixes: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            given = json.load(f)
        pre = given["pre_tokenizer"] or {}
        if given["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or given["normalizer"] or any(
                t["lstrip"] or t["rstrip"] or t["single_word"] for t in given["added_tokens"]):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        self.model, self.pre = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.special = {t["content"]: t["id"] for t in given["added_tokens"]}
        self._special = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.prefixes = prefixes
        if prefixes:
            back = {c: b for b, c in _byte_letters().items()}
            # the vocabulary of the model alone: special tokens never arise from merges
            self.vocab = {bytes(back[c] for c in t): i for t, i in given["model"]["vocab"].items() if all(c in back for c in t)}
            self.token = {i: t for t, i in self.vocab.items()}
            self.longest = max(map(len, self.vocab))
            self.pairs: dict[int, bool] = {}
            self.alone: dict[int, bool] = {}
        self._reset()

    def _reset(self) -> None:
        self.keys, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.starts, self.counts, self.flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pstarts, self.pflat = np.zeros(0, np.int64), np.zeros(0, np.int32)

    # --- one piece -----------------------------------------------------------------------------------------------
    def encode_piece(self, piece: str) -> list[int]:
        if piece in self.special:
            return [self.special[piece]]
        return self._encode_bytes(piece.encode())

    def _encode_bytes(self, raw: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(raw.decode("latin-1").translate(_byte_letters()))]

    def _stands(self, t: int) -> bool:
        """Whether the encoding of the token's bytes is this token."""
        known = self.alone.get(t)
        if known is None:
            known = self.alone[t] = self._encode_bytes(self.token[t]) == [t]
        return known

    def _joins(self, a: int, b: int) -> bool:
        """Whether the encoding of the two tokens' bytes is just these two tokens."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= TABLE_PAIRS:
                self.pairs.clear()
            known = self.pairs[key] = self._encode_bytes(self.token[a] + self.token[b]) == [a, b]
        return known

    def prefix_counts(self, piece: str) -> list[int]:
        """Token count of every prefix of a piece, by characters.

        Dynamic program over bytes: the encoding of a prefix is the encoding of a shorter one and one last token that
        forms a valid pair with the token before it; exactly one token fits.
        """
        if piece in self.special:  # the library matches it whole; its proper prefixes are ordinary text
            return [len(self.tokenizer.encode(piece[:k], add_special_tokens=False).ids) for k in range(1, len(piece))] + [1]
        raw = piece.encode()
        last, count = [0] * (len(raw) + 1), [0] * (len(raw) + 1)
        for i in range(1, len(raw) + 1):
            for j in range(max(0, i - self.longest), i):
                t = self.vocab.get(raw[j:i])
                if t is not None and (self._stands(t) if j == 0 else self._joins(last[j], t)):
                    last[i], count[i] = t, count[j] + 1
                    break
        out = [count[i] for i in range(1, len(raw) + 1) if i == len(raw) or raw[i] & 0xC0 != 0x80]
        if len(piece) > 2 and piece[0] == "'" and piece[1:] in _TAILS:
            out[1] = 2  # "'r" alone is no contraction: the pattern cuts it in two
        return out

    # --- a batch -------------------------------------------------------------------------------------------------
    def _cut(self, text: str, points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Starts of the pieces; ``bounds`` are where texts (or their parts beside special tokens) begin."""
        n = len(points)
        cls = _classes()[points]
        space, blank = cls == _SPACE, points == 0x20
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        edge[n] = True
        run = edge[:n].copy()
        run[1:] |= cls[1:] != cls[:-1]
        before = np.zeros(n, bool)  # a blank just before, in the same text
        before[1:] = blank[:-1]
        before &= ~edge[:n]
        start = run & ~(before & ~space)
        # the last character of white space before text is a piece of its own, or the next piece's first character
        last = np.zeros(n, bool)
        last[:-1] = space[:-1] & ~space[1:]
        last &= ~edge[1:]
        start |= last
        # contractions: an apostrophe that begins a piece, followed by one of the tails
        for a in np.flatnonzero((points == 0x27) & start):
            for tail in _TAILS:
                stop = a + 1 + len(tail)
                if stop <= n and text[a + 1: stop] == tail and not edge[a + 1: stop].any():
                    start[a + 1: stop] = False
                    if stop < n:
                        # what follows is matched anew; white space and blanks keep their own starts
                        start[stop] |= not space[stop]
                    break
        # parts with unsure characters are cut by the library
        unsure = np.flatnonzero(cls == _UNSURE)
        if len(unsure):
            begins = np.flatnonzero(edge)
            for k in np.unique(np.searchsorted(begins, unsure, "right") - 1):
                lo, hi = int(begins[k]), int(begins[k + 1])
                start[lo:hi] = False
                start[lo + np.array([o[0] for _, o in self.pre.pre_tokenize_str(text[lo:hi])], np.int64)] = True
        return np.flatnonzero(start)

    def pieces(self, data: np.ndarray, offsets: np.ndarray):
        """(text, character offsets of the rows, piece starts, piece ends, table slot of each piece) of a chunk."""
        text = data.tobytes().decode("utf-8")
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        rows = lead[offsets]
        bounds, special = rows[:-1][rows[:-1] < len(points)], []
        if self._special is not None and any(t in text for t in self.special):
            for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                special += [m.span() for m in self._special.finditer(text, lo, hi)]
            bounds = np.unique(np.concatenate([bounds, np.array([x for s in special for x in s if x < len(points)], np.int64)]))
        begin = self._cut(text, points, bounds)
        if special:
            begin = np.setdiff1d(begin, spread(np.array([a + 1 for a, _ in special]), np.array([b - a - 1 for a, b in special])))
        end = np.append(begin[1:], len(points))
        if not len(begin):
            return text, rows, begin, end[:0], np.zeros(0, np.int64)
        slots = self.span_slots(text, points, begin, end, begin[np.searchsorted(begin, [a for a, _ in special])] if special else None)
        return text, rows, begin, end, slots

    def span_slots(self, text: str, points: np.ndarray, begin: np.ndarray, end: np.ndarray, special: np.ndarray | None = None) -> np.ndarray:
        """Table slots of spans of a chunk; spans that start at ``special`` are special tokens."""
        up, down = _POWERS.get(len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(_point_values()[points] * up, out=sums[1:])
        keys = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64))
        if special is not None:  # a special token and the same characters cut apart never share an entry
            keys[np.searchsorted(begin, special)] ^= np.uint64(0x5851F42D4C957F2D)
        distinct, where, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return self._slots(distinct, lambda k: text[begin[where[k]]: end[where[k]]])[inverse]

    def _slots(self, keys: np.ndarray, piece) -> np.ndarray:
        if len(self.keys) > TABLE_PIECES:
            self._reset()
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~known)
        if len(new):
            texts = [piece(k) for k in new]
            ids = [self.encode_piece(t) for t in texts]
            sizes = np.array([len(x) for x in ids], np.int64)
            fresh = np.arange(len(self.counts), len(self.counts) + len(new))
            self.starts = np.append(self.starts, len(self.flat) + np.cumsum(sizes) - sizes)
            self.counts = np.append(self.counts, sizes)
            self.flat = np.append(self.flat, np.fromiter((i for x in ids for i in x), np.int32, int(sizes.sum())))
            if self.prefixes:
                steps = [self.prefix_counts(t) for t in texts]
                lengths = np.array([len(x) for x in steps], np.int64)
                self.pstarts = np.append(self.pstarts, len(self.pflat) + np.cumsum(lengths) - lengths)
                self.pflat = np.append(self.pflat, np.fromiter((i for x in steps for i in x), np.int32, int(lengths.sum())))
            self.keys, self.slots = np.insert(self.keys, at[new], keys[new]), np.insert(self.slots, at[new], fresh)
            at = np.searchsorted(self.keys, keys)
        return self.slots[at]

    def count_prefixes(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token count of every character prefix of all rows of a chunk, and where each row's begin (one more entry)."""
        text, rows, begin, end, slots = self.pieces(data, offsets)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int64), rows
        counts = self.counts[slots]
        base = np.cumsum(counts) - counts
        first = np.minimum(np.searchsorted(begin, rows[:-1]), len(begin) - 1)
        base -= np.repeat(base[first], np.diff(np.searchsorted(begin, rows)))
        out = np.repeat(base, end - begin) + self.pflat[spread(self.pstarts[slots], end - begin)]
        # a prefix that ends with a whole run of white space keeps the run in one piece, though text behind it takes the last
        space = _classes()[points] == _SPACE
        runs = np.flatnonzero(space[begin[:-1]] & space[end[:-1] - 1] & space[begin[1:]]) if len(begin) > 1 else np.zeros(0, np.int64)
        if len(runs):
            inside = np.isin(begin[runs + 1], rows, invert=True)
            runs = runs[inside & ~np.isin(begin[runs + 1], self._ends_of_special(text))]
        if len(runs):
            whole = self.span_slots(text, points, begin[runs], begin[runs + 1] + 1)
            out[begin[runs + 1]] = base[runs] + self.counts[whole]
        if self._special is not None and any(t in text for t in self.special):
            for lo, hi in zip(rows[:-1].tolist(), rows[1:].tolist(), strict=True):
                part, before = lo, 0
                for m in self._special.finditer(text, lo, hi):
                    for k in range(m.start() + 1, m.end()):  # a special token's proper prefixes are ordinary text
                        out[k - 1] = before + len(self.tokenizer.encode(text[part:k], add_special_tokens=False).ids)
                    part, before = m.end(), int(out[m.end() - 1])
        return out, rows

    def _ends_of_special(self, text: str) -> np.ndarray:
        return np.array([m.end() for m in self._special.finditer(text)] if self._special else [], np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows in order, and where each row's begin (one more entry at the end)."""
        parts, ends = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for i, j in chunks(offsets):
            _, rows, begin, _, slots = self.pieces(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i])
            counts = self.counts[slots]
            parts.append(self.flat[spread(self.starts[slots], counts)])
            total = np.concatenate([[0], np.cumsum(counts)])
            ends.append(ends[-1][-1] + total[np.searchsorted(begin, rows[1:])])
        return np.concatenate(parts), np.concatenate(ends)


@functools.cache
def pieces_of(path: str, prefixes: bool = False) -> Pieces:
    """One encoder per Python worker and vocabulary."""
    return Pieces(path, prefixes)
