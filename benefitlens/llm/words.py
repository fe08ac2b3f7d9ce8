"""Whole texts to token payloads through a table of their words, vectorised with numpy.

Byte-level BPE treats every match of the split pattern on its own, so a text's
tokens are the concatenation of its words' tokens. Texts repeat their words, so a
worker keeps a bounded table from word to payload (a row of integers: token ids,
or whatever the caller computes for a word) and works out only new words.

The split pattern (``public_tokenizers.PATTERN``) depends on five classes of
characters only, so the borders of all words of a group of texts come from
comparisons of neighbouring classes. Words are looked up by a 64-bit polynomial
hash of their code points, taken from running sums, and compared by a second
hash: a polynomial modulo the prime 2**31 - 1 for two bases that each process
draws at random. Words that share the first but not the second hash, as can be
made up for any fixed base modulo 2**64, are looked up as text. That two words of
a table share both has a chance below 1e-20, for any input made without knowing
the bases. Both hashes work on spans of bounded length, so their tables of powers
are of fixed size; longer words are digested as a whole.
Code points that Python's Unicode tables don't know count as neither letter nor number.
"""

from __future__ import annotations

import functools
import hashlib
import secrets
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Code points with the Unicode property White_Space, as the split pattern means it.
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
BLANK, WHITE, LETTER, NUMBER, OTHER, BREAK = range(6)

#: Texts are worked on in groups of about this many characters.
GROUP_CHARS = 1_000_000
#: Words in a worker's table and their values; beyond them it starts anew with the words that were met again.
MAX_WORDS = 300_000
MAX_VALUES = 4_000_000

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def char_classes() -> np.ndarray:
    """Class of each code point; the last entry is the break between texts."""
    by_category = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((by_category.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    out[_WHITE] = WHITE
    out[0x20] = BLANK
    return out


#: Characters that are hashed from one running sum at most; longer words are digested one by one.
SPAN = 1 << 18
PRIME = (1 << 31) - 1


@functools.cache
def powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse modulo 2**64."""
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = np.full(SPAN, _BASE), np.full(SPAN, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _folded(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, up to a multiple: below 2**31 + 2 for all x."""
    x = (x & np.uint64(PRIME)) + (x >> np.uint64(31))
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def prime_powers(seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers modulo PRIME of two bases drawn from the seed, and of their inverses."""

    def rising(base: int) -> np.ndarray:
        out = np.ones(SPAN, np.uint64)
        n = 1
        while n < SPAN:
            out[n : 2 * n] = out[:n] * np.uint64(pow(base, n, PRIME)) % np.uint64(PRIME)
            n *= 2
        return out

    bases = np.random.default_rng(seed).integers(1 << 20, PRIME - 1, 2).tolist()
    return [(rising(b), rising(pow(b, -1, PRIME))) for b in bases]


@functools.cache
def process_seed() -> int:
    return secrets.randbits(63)


def spans(first: np.ndarray, last: np.ndarray) -> Iterator[slice]:
    """Runs of consecutive words that lie within SPAN characters; a longer word is alone."""
    i = 0
    while i < len(first):
        j = max(i + 1, int(np.searchsorted(last, first[i] + SPAN, "right")))
        yield slice(i, j)
        i = j


def _digest(values: np.ndarray, seed: int) -> int:
    key = seed.to_bytes(8, "little")
    return int.from_bytes(hashlib.blake2b(np.ascontiguousarray(values).tobytes(), digest_size=8, key=key).digest(), "little")


def quick_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """64-bit hashes of values[first:last] for all words, never 0; equal words have equal hashes."""
    up, down = powers()
    out = np.empty(len(first), np.uint64)
    for s in spans(first, last):
        f, l = first[s], last[s]
        start = f[0]
        if l[-1] - start > SPAN:
            out[s] = _digest(values[start : l[-1]], 0)
            continue
        part = values[start : l[-1]].astype(np.uint64) + np.uint64(1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * _MIX * up[: len(part)], out=sums[1:])
        out[s] = (sums[l - start] - sums[f - start]) * down[f - start]
    out ^= out >> np.uint64(29)
    out = out * _BASE + (last - first).astype(np.uint64) * _MIX
    out ^= out >> np.uint64(32)
    return out * _MIX | np.uint64(1)


def seeded_hashes(values: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int) -> np.ndarray:
    """62-bit hashes of values[first:last] for all words: two polynomials modulo a prime, their bases from the seed.

    Two words of n values share one with a chance of (n / 2**31)**2, whatever they are, as long as the seed is
    drawn after them.
    """
    out = np.empty(len(first), np.uint64)
    for s in spans(first, last):
        f, l = first[s], last[s]
        start = f[0]
        if l[-1] - start > SPAN:
            out[s] = _digest(values[start : l[-1]], seed) >> 2
            continue
        part = values[start : l[-1]].astype(np.uint64) + np.uint64(1)
        both = []
        for up, down in prime_powers(seed):
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_folded(part * up[: len(part)]), out=sums[1:])
            both.append(_folded(_folded(sums[l - start] - sums[f - start]) * down[f - start]) % np.uint64(PRIME))
        out[s] = both[0] << np.uint64(31) | both[1]
    return out


def word_starts(code: np.ndarray, kind: np.ndarray, joined_space: bool = False) -> np.ndarray:
    """Where the split pattern's words begin. Both arrays begin and end with a break.

    joined_space: a run of white space and the word after it count as one.
    """
    before, after = kind[:-1], kind[1:]
    core = (kind >= LETTER) & (kind <= OTHER)
    white = kind <= WHITE
    start = kind == BREAK
    start[1:] |= white[1:] & ~white[:-1]
    if joined_space:
        start[1:] |= (after != before) & core[1:] & ~white[:-1]
    else:
        start[:-1] |= white[:-1] & core[1:]  # of white space before a word, the last character stands apart or goes with the word
        start[1:] |= (after != before) & core[1:] & (before != BLANK)
    # contractions: an apostrophe where a word may begin, and letters
    mark = np.flatnonzero(code[:-2] == 0x27)
    mark = mark[(kind[mark - 1] != OTHER) & (kind[mark - 1] != BLANK)]
    one, two = code[mark + 1], code[mark + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    for which, size in ((short, 2), (long, 3)):
        m = mark[which]
        start[m + 1] = False
        m = m + size
        start[m[kind[m] == LETTER]] = True
    return np.flatnonzero(start)


def spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices first[i] .. first[i] + size[i] of all i, one after the other."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - size), size)


class WordTable:
    """Maps texts to rows of integers, a row for each word.

    encode(words) gives (values, how many of each word) for words not met yet.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], joined_space: bool = False, dtype=np.uint32):
        self.encode, self.joined_space, self.dtype = encode, joined_space, dtype
        self._clear()

    def _clear(self) -> None:
        self.bits = 16
        self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        self.hashes, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # hash 0: a word looked up as text
        self.clashing: dict[str, int] = {}
        self.first, self.size, self.values = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, self.dtype)
        self.again = np.zeros(0, bool)  # met in a later call than the one that brought the word

    def _renew(self) -> None:
        """Starts anew with the indexed words that were met again, if they take half of the table at most."""
        kept = np.flatnonzero(self.again & (self.hashes != 0))
        size = self.size[kept]
        if 2 * len(kept) > MAX_WORDS or 2 * int(size.sum()) > MAX_VALUES:
            kept = size = kept[:0]
        hashes, checks, values = self.hashes[kept], self.checks[kept], self.values[spread(self.first[kept], size)]
        self._clear()
        if len(kept):
            self.hashes, self.checks, self.values = hashes, checks, values
            self.first, self.size, self.again = np.cumsum(size) - size, size, np.zeros(len(kept), bool)
            self._index()

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of the hashes; -1 where there is none."""
        out = np.full(len(hashes), -1, np.int32)
        mask = (1 << self.bits) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            key = self.keys[at]
            hit = key == hashes[todo]
            out[todo[hit]] = self.rows[at[hit]]
            more = ~hit & (key != 0)
            todo, at = todo[more], (at[more] + 1) & mask
        return out

    def _place(self, hashes: np.ndarray, rows: np.ndarray) -> None:
        mask = (1 << self.bits) - 1
        at = (hashes >> np.uint64(64 - self.bits)).astype(np.int64)
        todo = np.arange(len(hashes))
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = hashes[todo[free]]
            mine = self.keys[at] == hashes[todo]
            self.rows[at[mine]] = rows[todo[mine]]
            todo, at = todo[~mine], (at[~mine] + 1) & mask

    def _append(self, hashes: np.ndarray, checks: np.ndarray, words: list[str]) -> np.ndarray:
        """New rows for words, without a place in the index."""
        values, size = self.encode(words)
        rows = np.arange(len(self.hashes), len(self.hashes) + len(hashes), dtype=np.int32)
        size = size.astype(np.int64)
        self.first = np.concatenate([self.first, len(self.values) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.values = np.concatenate([self.values, values.astype(self.dtype, copy=False)])
        self.hashes, self.checks = np.concatenate([self.hashes, hashes]), np.concatenate([self.checks, checks])
        self.again = np.concatenate([self.again, np.zeros(len(hashes), bool)])
        return rows

    def _index(self) -> None:
        """Places all rows anew, in a larger index where it is too full."""
        self.bits = max(self.bits, int(2 * len(self.hashes)).bit_length())
        self.keys, self.rows = np.zeros(1 << self.bits, np.uint64), np.zeros(1 << self.bits, np.int32)
        indexed = np.flatnonzero(self.hashes)
        self._place(self.hashes[indexed], indexed.astype(np.int32))

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, words: list[str]) -> None:
        rows = self._append(hashes, checks, words)
        if 2 * len(self.hashes) > len(self.keys):
            self._index()
        else:
            self._place(hashes, rows)

    def _row_of_clashing(self, word: str) -> int:
        """Row of a word whose hash in the index is another word's."""
        if word not in self.clashing:
            (self.clashing[word],) = self._append(np.zeros(1, np.uint64), np.zeros(1, np.uint64), [word]).tolist()
        return self.clashing[word]

    def rows_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(row of each word in order, words of each text). The rows hold until the next call."""
        if len(self.hashes) > MAX_WORDS or len(self.values) > MAX_VALUES:
            self._renew()
        joined = "\n".join(["", *texts, ""])
        code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        kind = char_classes()[code]
        breaks = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
        kind[0] = BREAK
        kind[breaks] = BREAK
        start = word_starts(code, kind, self.joined_space)
        end = np.append(start[1:], len(code))
        is_word = kind[start] != BREAK
        first, last = start[is_word], end[is_word]
        hashes, checks = quick_hashes(code, first, last), seeded_hashes(code, first, last, process_seed())
        rows = self._find(hashes)
        self.again[rows[rows >= 0]] = True
        new = np.flatnonzero(rows < 0)
        if len(new):
            unique, at = np.unique(hashes[new], return_index=True)
            at = new[at]
            self._learn(unique, checks[at], [joined[i:j] for i, j in zip(first[at].tolist(), last[at].tolist())])
            rows[new] = self._find(hashes[new])
        for k in np.flatnonzero(self.checks[rows] != checks).tolist():
            rows[k] = self._row_of_clashing(joined[first[k] : last[k]])
        edges = np.searchsorted(first, np.concatenate([[0], breaks]))
        return rows, np.diff(edges)

    def values_of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all values in order, how many of each text)."""
        rows, words = self.rows_of(texts)
        size = self.size[rows]
        values = self.values[spread(self.first[rows], size)]
        ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(words)])]
        return values, np.diff(ends)


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(first index, texts) of one group of about ``most`` characters after another."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i + 1 == len(texts):
            yield first, texts[first : i + 1]
            first, size = i + 1, 0


def with_mark(table: WordTable, mark: str, value: int, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``values_of`` for texts in which ``mark`` is one token between texts of their own."""
    has = [i for i, t in enumerate(texts) if mark in t]
    if not has:
        return table.values_of(texts)
    parts: list[list[str]] = [[t] for t in texts]
    for i in has:
        parts[i] = texts[i].split(mark)
    values, sizes = table.values_of([x for p in parts for x in p])
    pieces, counts, at, k = [], [], 0, 0
    for p in parts:
        n = 0
        for j in range(len(p)):
            if j:
                pieces.append(np.array([value], values.dtype))
                n += 1
            pieces.append(values[at : at + sizes[k]])
            at, n, k = at + sizes[k], n + int(sizes[k]), k + 1
        counts.append(n)
    return np.concatenate(pieces), np.array(counts, np.int64)


def ragged(rows: Iterable) -> tuple[np.ndarray, np.ndarray]:
    """(values, sizes) of a list of short integer rows."""
    rows = list(rows)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter((x for r in rows for x in r), np.int64, int(sizes.sum())), sizes
