"""Simple-8b word-aligned coding of non-negative integers, vectorised with numpy.

A 64-bit word holds a 4-bit selector (low bits) and up to 60 payload bits; the
selector says how many values of how many bits follow. Values are cut into blocks
of ``BLOCK`` values that start at a word of their own, listed in the block index,
so any block decodes alone and all blocks decode at once. Selector 0 is the
escape: the whole next word is one value of more than 60 bits.
"""

from __future__ import annotations

import numpy as np

#: selector -> (values in a word, bits of each); 0 is the escape, 1 a run of zeros.
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.int64)
BLOCK = 256


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, by halving steps (floats would round beyond 2**53)."""
    out, rest = np.zeros(len(values), np.uint8), values
    most = int(values.max())
    for step in (32, 16, 8, 4, 2, 1):
        if most >> step:
            high = rest >> np.uint64(step)
            more = high > 0
            out += more.view(np.uint8) * np.uint8(step)
            rest = np.where(more, high, rest)
            most = max(most >> step, (1 << step) - 1)
    return out + (rest > 0).view(np.uint8)


def _selectors(bits: np.ndarray) -> np.ndarray:
    """At each position of a block (row), the densest selector whose values all fit before the block ends."""
    best = np.zeros(bits.shape, np.uint8)
    widest, have = bits.copy(), 1
    for s in range(15, 0, -1):
        while have < COUNTS[s]:  # widest[i] covers the values i to i + have
            step = min(have, int(COUNTS[s]) - have)
            np.maximum(widest[:, :-step], widest[:, step:], out=widest[:, :-step])
            widest[:, -step:] = 255
            have += step
        best[widest <= BITS[s]] = s
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block) of unsigned values."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    blocks = -(-n // BLOCK)
    bits = np.full(blocks * BLOCK, 255, np.uint8)
    bits[:n] = _bit_lengths(values)
    select = _selectors(bits.reshape(blocks, BLOCK)).reshape(-1)
    step = COUNTS[select]
    is_start = np.zeros(len(bits), bool)
    at = np.arange(blocks, dtype=np.int64) * BLOCK
    end = np.minimum(at + BLOCK, n)
    while len(at):  # all blocks advance together, by one word each
        is_start[at] = True
        at = at + step[at]
        live = at < end
        at, end = at[live], end[live]
    start = np.flatnonzero(is_start)
    s = select[start]
    size = 1 + (s == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(place[-1] + size[-1]), np.uint64)
    for k in np.unique(s):
        mine = np.flatnonzero(s == k)
        word = np.full(len(mine), k, np.uint64)
        if k == 0:
            words[place[mine] + 1] = values[start[mine]]
        elif k > 1:
            for j in range(int(COUNTS[k])):
                word |= values[start[mine] + j] << np.uint64(4 + j * int(BITS[k]))
        words[place[mine]] = word
    return words, place[np.searchsorted(start, np.arange(blocks, dtype=np.int64) * BLOCK)].astype(np.uint32)


def decode(words: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
    """The n values back. The blocks' first words let all blocks step through their words together."""
    out = np.zeros(n, np.uint64)
    if n == 0:
        return out
    select = (words & np.uint64(15)).astype(np.int64)
    at, to = index.astype(np.int64), np.arange(len(index), dtype=np.int64) * BLOCK
    end = np.minimum(to + BLOCK, n)
    where, start = [], []
    while len(at):
        where.append(at)
        start.append(to)
        s = select[at]
        at, to = at + 1 + (s == 0), to + COUNTS[s]
        live = to < end
        at, to, end = at[live], to[live], end[live]
    where, start = np.concatenate(where), np.concatenate(start)
    s = select[where]
    for k in np.unique(s):
        mine = s == k
        if k == 0:
            out[start[mine]] = words[where[mine] + 1]
        elif k > 1:
            word, first, low = words[where[mine]], start[mine], np.uint64((1 << int(BITS[k])) - 1)
            for j in range(int(COUNTS[k])):
                out[first + j] = (word >> np.uint64(4 + j * int(BITS[k]))) & low
    return out
