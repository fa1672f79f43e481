"""Pre-tokenisation without regular expressions.

Texts are looked up in an array of codepoint classes. Each class is a transition function of a
small automaton; compositions of these functions form a finite monoid, so the states before all
characters come from an associative scan over table lookups, and the token starts from the state
and the class at each character. The automaton accepts the same tokens as the public pattern of
the rank files (contractions, runs of letters, of numbers and of other characters with an optional
space before, white space with its last character left to what follows).
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np

#: White space as Unicode has it. Fixed values.
WHITE_SPACE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000
)

# classes of codepoints; the letters that can follow the apostrophe of a contraction are their own
LETTER, SINGLE, R_OR_V, E, L, NUMBER, OTHER, APOSTROPHE, SPACE, BLANK, END = range(11)
CLASSES = 11
LETTERS = (LETTER, SINGLE, R_OR_V, E, L)

# states: what the characters so far have left
IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_SPACE, AFTER_BLANK, CLOSED, QUOTE, QUOTE_RV, QUOTE_L = range(9)
STATES = 9


def _next(state: int, kind: int) -> int:
    if kind in LETTERS:
        if state == QUOTE and kind == SINGLE:
            return CLOSED
        if state == QUOTE and kind == R_OR_V:
            return QUOTE_RV
        if state == QUOTE and kind == L:
            return QUOTE_L
        if state == QUOTE_RV and kind == E or state == QUOTE_L and kind == L:
            return CLOSED
        return IN_LETTERS
    if kind == NUMBER:
        return IN_NUMBERS
    if kind == OTHER:
        return IN_OTHERS
    if kind == APOSTROPHE:  # opens a contraction unless a run of others or a space before takes it
        return IN_OTHERS if state in (IN_OTHERS, AFTER_SPACE, QUOTE) else QUOTE
    return {SPACE: AFTER_SPACE, BLANK: AFTER_BLANK, END: CLOSED}[kind]


def _starts(state: int, kind: int) -> bool:
    """Whether a character that is no white space starts a token, contractions of two letters aside."""
    if state in (AFTER_BLANK, CLOSED):
        return True
    if state == AFTER_SPACE:
        return False
    if kind in LETTERS:
        if state == QUOTE and kind == SINGLE:
            return False
        return state not in (IN_LETTERS, QUOTE_RV, QUOTE_L)
    if kind == NUMBER:
        return state != IN_NUMBERS
    return state not in (IN_OTHERS, QUOTE)


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every codepoint, from the Unicode categories."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(point))[0]
        if kind == "L":
            table[point] = LETTER
        elif kind == "N":
            table[point] = NUMBER
    table[list(WHITE_SPACE)] = BLANK
    table[ord(" ")] = SPACE
    table[ord("'")] = APOSTROPHE
    for letters, kind in (("stmd", SINGLE), ("rv", R_OR_V), ("e", E), ("l", L)):
        table[[ord(x) for x in letters]] = kind
    return table


@lru_cache(maxsize=1)
def monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(function of each class, composition table, state each function leads to from CLOSED, start table)."""
    functions = [tuple(range(STATES))]  # the identity first
    of_class = []
    for kind in range(CLASSES):
        f = tuple(_next(state, kind) for state in range(STATES))
        if f not in functions:
            functions.append(f)
        of_class.append(functions.index(f))
    known = 0
    while known < len(functions):  # close under composition
        known = len(functions)
        for f in functions[:known]:
            for g in functions[:known]:
                if (h := tuple(g[x] for x in f)) not in functions:
                    functions.append(h)
    place = {f: k for k, f in enumerate(functions)}
    compose = np.array([[place[tuple(g[x] for x in f)] for g in functions] for f in functions], np.uint8)
    starts = np.array([[_starts(s, k) for k in range(CLASSES)] for s in range(STATES)], bool)
    return np.array(of_class, np.uint8), compose, np.array([f[CLOSED] for f in functions], np.uint8), starts


#: Characters that one lane of the scan takes in sequence; the lanes run side by side.
LANE = 256


def states_before(classes: np.ndarray) -> np.ndarray:
    """State before each character: an exclusive scan of the composed transition functions."""
    of_class, compose, reached, _ = monoid()
    width = len(compose)
    flat = compose.ravel()
    n = len(classes)
    lanes = -(-n // LANE)
    f = np.zeros((LANE, lanes), np.uint8)
    padded = np.zeros(lanes * LANE, np.uint8)
    padded[:n] = of_class[classes]
    f[:] = padded.reshape(lanes, LANE).T
    for k in range(1, LANE):  # inclusive scan in each lane
        f[k] = flat.take(f[k - 1].astype(np.int32) * width + f[k])
    carry = np.zeros(lanes, np.uint8)  # scan over the lanes, by doubling
    carry[1:] = f[-1, :-1]
    step = 1
    while step < lanes:
        carry[step:] = flat.take(carry[:-step].astype(np.int32) * width + carry[step:])
        step *= 2
    after = reached.take(flat.take(carry.astype(np.int32)[None, :] * width + f)).T.ravel()[:n]
    before = np.empty(n, np.uint8)
    before[:1] = CLOSED
    before[1:] = after[:-1]
    return before


def token_starts(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a token starts at each codepoint. ``ends``: places of the separators between texts,
    which are tokens of their own and shield the texts from each other."""
    classes = class_table()[points]
    classes[ends] = END
    before = states_before(classes)
    starts = monoid()[3].ravel().take(before.astype(np.int32) * CLASSES + classes)
    blank = (classes == SPACE) | (classes == BLANK)
    # white space starts a token as the first of its run, and as the last one if a token follows
    first = np.ones(len(points), bool)
    first[1:] = ~blank[:-1]
    last = np.zeros(len(points), bool)
    last[:-1] = ~blank[1:] & (classes[1:] != END)
    starts = np.where(blank, first | last, starts)
    # a contraction of two letters shows at its second one: its first starts no token
    done = ((before == QUOTE_RV) & (classes == E)) | ((before == QUOTE_L) & (classes == L))
    starts[np.flatnonzero(done) - 1] = False
    starts[ends] = True
    return starts


#: Characters that are cut at once.
AT_ONCE = 500_000


def cuts(texts: list[str]):
    """Yield (first, stop, raw, places, bounds) over consecutive runs of texts: ``raw`` is texts
    [first, stop) in UTF-8, each with a separator after it; piece k of it lies between places[k] and
    places[k + 1], and the piece at bounds[k] is the separator after text first + k."""
    first = 0
    while first < len(texts):
        stop, size = first, 0
        while stop < len(texts) and (stop == first or size + len(texts[stop]) < AT_ONCE):
            size += len(texts[stop]) + 1
            stop += 1
        joined = "\n".join(texts[first:stop]) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(x) + 1 for x in texts[first:stop]]) - 1
        at = np.flatnonzero(token_starts(points, ends))
        raw = joined.encode()
        places = at
        if len(raw) != len(points):  # places in UTF-8
            wide = np.ones(len(points), np.int64)
            for least in (0x80, 0x800, 0x10000):
                wide += points >= least
            places = (np.cumsum(wide) - wide)[at]
        yield first, stop, raw, np.append(places, len(raw)), np.searchsorted(at, ends).tolist()
        first = stop


def slices(texts: list[str]):
    """Yield (first, stop, pieces, bounds) as ``cuts`` does, with the pieces in one list."""
    for first, stop, raw, places, bounds in cuts(texts):
        places = places.tolist()
        yield first, stop, [raw[a:b] for a, b in zip(places, places[1:])], bounds
