"""Shingle sets and fast similarity sketches (Dahlgaard, Knudsen and Thorup)."""

from __future__ import annotations

import numpy as np

from loadlens.llm.repeats import mix

#: Value of a coordinate that no element has reached.
_EMPTY = np.uint64(2**64 - 1)


def shingle_sets(hashes: np.ndarray, lengths: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, owners): the distinct hashed shingles of each text, sorted by owner and hash.
    ``hashes`` are those of the words of all texts; a text with fewer words is one shingle."""
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    ends = np.cumsum(lengths)
    left = ends[owner] - np.arange(n)  # words from here to the end of the text
    first = np.arange(n) == (ends - lengths)[owner]
    starts = np.flatnonzero((left >= words) | first)
    value = np.zeros(len(starts), np.uint64)
    for k in range(words):
        have = left[starts] > k
        word = hashes[np.minimum(starts + k, n - 1)]
        value = np.where(have, mix(value + mix(word + np.uint64(k + 1))), value)
    o = owner[starts]
    order = np.lexsort((value, o))
    value, o = value[order], o[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (o[1:] != o[:-1])
    return value[new], o[new]


def sketches(elements: np.ndarray, owners: np.ndarray, sets: int, size: int) -> np.ndarray:
    """Sketch of ``size`` coordinates of each set; those of an empty set are all ``_EMPTY``.

    In round i < size each element is hashed to a coordinate and to a value; in round size + i every
    element goes to coordinate i. A coordinate keeps its first round and the least value in it. A set
    is done after the round that fills its last coordinate: large sets take a few rounds, any
    set at most 2 * size, and then every coordinate of a set with elements is filled.
    """
    out = np.full(sets * size, _EMPTY)
    live_e, live_o = elements, owners.astype(np.int64)
    for i in range(2 * size):
        if not len(live_e):
            break
        x = mix(live_e ^ mix(np.array([i + 1], np.uint64)))
        value = (x & np.uint64(0xFFFFFFFF)) | np.uint64(i << 32)
        if i < size:
            coordinate = ((x >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
        else:
            coordinate = i - size
        np.minimum.at(out, live_o * size + coordinate, value)
        here = np.unique(live_o) if i == 0 else here
        open_ = (out.reshape(sets, size)[here] == _EMPTY).any(axis=1)
        if not open_.all():
            still = np.zeros(sets, bool)
            still[here[open_]] = True
            here = here[open_]
            mine = still[live_o]
            live_e, live_o = live_e[mine], live_o[mine]
    return out.reshape(sets, size)


def bands(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash for each ``rows`` consecutive coordinates, different from band to band."""
    sets, size = sketch.shape
    parts = sketch.reshape(sets, size // rows, rows)
    out = mix(np.arange(1, size // rows + 1, dtype=np.uint64))[None, :].repeat(sets, axis=0)
    for k in range(rows):
        out = mix(out + mix(parts[:, :, k]))
    return out
