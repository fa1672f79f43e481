"""Simple-8b: word-aligned coding of unsigned integers.

A word has a selector in its top 4 bits and 60 bits of payload that hold ``COUNT[s]`` values of
``BITS[s]`` bits each, the first one lowest. Selector ``ESCAPE`` holds the lower 60 bits of one value
that needs more; its upper 4 bits are in the list of escapes, in order. Values are coded in blocks
of ``BLOCK``; no word crosses a block, and the offset of each block's first word is kept, so blocks
are coded and decoded side by side. Counts and bits of the selectors are those of the published
format (Anh and Moffat), with the word of 120 zeros given up for the escape.
"""

from __future__ import annotations

import numpy as np

#: Values a word, and bits a value, by selector. Fixed values of the format.
COUNT = np.array([240, 1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
ESCAPE = 1
#: Selectors from most to fewest values a word.
ORDER = [0, *range(2, 16)]
BLOCK = 1024


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    if values.max() >> np.uint64(53):  # beyond what a float holds
        upper = values >> np.uint64(32)
        return np.where(upper > 0, 32 + np.frexp(upper)[1], np.frexp(values & np.uint64(0xFFFFFFFF))[1]).astype(np.uint8)
    return np.frexp(values.astype(np.float32 if not values.max() >> np.uint64(24) else np.float64))[1].astype(np.uint8)


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offset of each block's first word, upper bits of the escaped values)."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.uint8)
    left = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), -(-n // BLOCK))[:n]  # to the end of the block
    if n % BLOCK:
        left[n // BLOCK * BLOCK :] -= BLOCK - n % BLOCK
    # widest[k][i]: bits of the widest of the 2^k values from i on
    widest = [_widths(values)]
    while 2 << len(widest) - 1 <= min(n, int(COUNT.max())):
        step = 1 << len(widest) - 1
        widest.append(np.maximum(widest[-1][:-step], widest[-1][step:]))
    selector = np.full(n, ESCAPE, np.uint8)
    for s in ORDER[::-1]:  # the last selector whose whole word fits holds the most values
        c = int(COUNT[s])
        if c > n:
            continue
        k = c.bit_length() - 1
        own = widest[k][: n - c + 1]
        if c > 1 << k:
            own = np.maximum(own, widest[k][c - (1 << k) : n - (1 << k) + 1])
        fits = (own <= BITS[s]) & (left[: n - c + 1] >= c)
        selector[: n - c + 1][fits] = s
    count = COUNT[selector]
    # all blocks take their next word at the same time
    cursor = np.arange(0, n, BLOCK)
    firsts = []
    live = np.arange(len(cursor))
    while len(live):
        firsts.append(cursor[live])
        cursor[live] += count[cursor[live]]
        live = live[cursor[live] < np.minimum((live + 1) * BLOCK, n)]
    taken = np.zeros(n, bool)
    taken[np.concatenate(firsts)] = True
    first = np.flatnonzero(taken)
    kind = selector[first]
    words = kind.astype(np.uint64) << np.uint64(60)
    for s in range(16):
        mine = np.flatnonzero(kind == s)
        if len(mine) and BITS[s]:
            low = values[first[mine, None] + np.arange(COUNT[s])].astype(np.uint64)
            low &= np.uint64((1 << int(BITS[s])) - 1)
            shift = (np.arange(COUNT[s]) * BITS[s]).astype(np.uint64)
            words[mine] |= np.bitwise_or.reduce(low << shift, axis=1)
    escapes = (values[first[kind == ESCAPE]].astype(np.uint64) >> np.uint64(60)).astype(np.uint8)
    offsets = np.searchsorted(first, np.arange(0, n, BLOCK)).astype(np.int32)
    return words, offsets, escapes


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The values of consecutive whole blocks, given their words and their escapes."""
    words = np.asarray(words, np.uint64)
    kind = (words >> np.uint64(60)).astype(np.uint8)
    count = COUNT[kind]
    first = np.cumsum(count) - count
    values = np.zeros(int(count.sum()), np.uint64)
    for s in range(16):
        mine = np.flatnonzero(kind == s)
        if len(mine) and BITS[s]:
            shift = (np.arange(COUNT[s]) * BITS[s]).astype(np.uint64)
            low = (words[mine, None] >> shift) & np.uint64((1 << int(BITS[s])) - 1)
            values[first[mine, None] + np.arange(COUNT[s])] = low
    values[first[kind == ESCAPE]] |= np.asarray(escapes, np.uint64) << np.uint64(60)
    return values


def decode_block(words: np.ndarray, offsets: np.ndarray, escapes: np.ndarray, block: int) -> np.ndarray:
    """The values of one block, found by its offset."""
    ends = np.append(offsets, len(words))
    before = words[: ends[block]]
    own = words[ends[block] : ends[block + 1]]
    skip = int((before >> np.uint64(60) == ESCAPE).sum())
    return decode(own, escapes[skip : skip + int((own >> np.uint64(60) == ESCAPE).sum())])
