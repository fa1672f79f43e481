"""Suffix arrays by linear grouping construction (Baier).

Phase 1 puts every suffix into the group of its longest Lyndon prefix. Groups are processed from
the highest to the lowest: each member points to the nearest suffix before it in a lower group (its
previous smaller), and the suffixes pointed at are moved to new groups just above their own, those
with more pointers higher, their prefix longer by the members' prefixes. Phase 2 walks the array
from its smallest suffix and puts each previous suffix, and those along its pointers, at the next
free place of their groups. No names are sorted again and nothing recurs.
"""

from __future__ import annotations

from array import array


class _Group:
    __slots__ = ("members", "higher", "lower", "done", "start")

    def __init__(self, members):
        self.members = members
        self.higher = self.lower = None
        self.done = False
        self.start = 0


def _above(group: _Group, members: set[int]) -> _Group:
    """A new group just above ``group``."""
    new = _Group(members)
    new.lower, new.higher = group, group.higher
    if group.higher is not None:
        group.higher.lower = new
    group.higher = new
    return new


def suffix_array(text: list[int]) -> list[int]:
    """Places of the suffixes of ``text`` (non-negative integers) in ascending order."""
    n = len(text)
    if n == 0:
        return []
    by_symbol: dict[int, list[int]] = {}
    for i, x in enumerate(text):
        by_symbol.setdefault(x, []).append(i)
    of: list[_Group] = [None] * n
    top = None
    for x in sorted(by_symbol):
        group = _Group(set(by_symbol.pop(x)))
        for i in group.members:
            of[i] = group
        group.lower = top
        if top is not None:
            top.higher = group
        top = group
    before = array("q", [-1]) * n  # pointers to the previous smaller group, -1 for none

    group = top
    while group is not None:
        members = sorted(group.members)
        pointed: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and ((own := of[j]) is group or own.done):
                j = before[j]
            before[i] = j
            if j >= 0:
                pointed[j] = pointed.get(j, 0) + 1
        group.done = True
        # most pointers first: each new group goes directly above the old one, below those before it
        by_count: dict[int, list[int]] = {}
        for j, count in pointed.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):
            moved: dict[_Group, list[int]] = {}
            for j in by_count[count]:
                moved.setdefault(of[j], []).append(j)
            for old, some in moved.items():
                if len(some) < len(old.members):
                    old.members.difference_update(some)
                    new = _above(old, set(some))
                    for j in some:
                        of[j] = new
        group = group.lower

    lowest = of[n - 1]
    while lowest.lower is not None:
        lowest = lowest.lower
    start, group = 0, lowest
    while group is not None:
        group.start = start
        start += len(group.members)
        group = group.higher
    order = array("q", [-1]) * n
    placed = bytearray(n)

    def place(j: int) -> None:
        while j >= 0 and not placed[j]:
            group = of[j]
            order[group.start] = j
            group.start += 1
            placed[j] = 1
            j = before[j]

    place(n - 1)  # the empty suffix comes before all others
    for k in range(n):
        place(order[k] - 1)
    return order.tolist()


def common_prefixes(text: list[int], order: list[int]) -> list[int]:
    """Common prefix of each suffix with the one before it in ``order`` (Kasai)."""
    n = len(text)
    rank = array("q", [0]) * n
    for k, i in enumerate(order):
        rank[i] = k
    common = array("q", [0]) * n
    h = 0
    for i in range(n):
        k = rank[i]
        if k:
            j = order[k - 1]
            while i + h < n and j + h < n and text[i + h] == text[j + h]:
                h += 1
            common[k] = h
            if h:
                h -= 1
        else:
            h = 0
    return common
