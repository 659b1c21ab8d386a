"""Periodic runs of words.

A run is a stretch of consecutive words with period q and at least two periods long that cannot be
extended. Each run has a Lyndon root: some period of it is the longest Lyndon word from its start under
one of two opposite orders of the words. Those longest Lyndon words are what the first phase of
grouping suffix sorting yields: suffixes are kept in groups by a prefix, groups are worked off from the
highest down, and each suffix hands its prefix to the nearest suffix before it that is in a lower
group. In the end suffixes of one group share their longest Lyndon word. Equal neighbours are then
one chain, and chains are extended on both sides as far as words match.

Only stretches of words in which every word lies in a sequence of six words that occurs twice are
looked at: in a run of twelve words or more every word does.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import compress

import numpy as np
from pyspark.sql import DataFrame

from courtside.llm.batches import per_text
from courtside.llm.shingles import mix

#: Words of the shortest run, and how many of them always come twice in it.
SHORTEST = 12
TWICE = SHORTEST // 2
#: Steps that all chains are extended together; what is longer is extended by itself.
TOGETHER = 16


def lyndon_groups(signs: list[int]) -> tuple[list[int], list[int]]:
    """Length of the longest Lyndon word from each position, and a group that equal ones share.

    ``signs`` are small whole numbers; the end of the sequence is smaller than any of them. A group is
    named by where it starts among the sorted suffixes, so that comparing names compares groups.
    """
    n = len(signs)
    order = sorted(range(n), key=signs.__getitem__)
    group = [0] * n
    members: dict[int, list[int]] = {}
    size, length = [0] * (n + 1), [0] * (n + 1)
    starts_of = [0] * (n + 1)
    at = 0
    while at < n:
        sign, end = signs[order[at]], at + 1
        while end < n and signs[order[end]] == sign:
            end += 1
        members[at] = order[at:end]
        for i in members[at]:
            group[i] = at
        size[at], length[at], starts_of[end - 1] = end - at, 1, at
        at = end
    before, lyndon = [-1] * n, [0] * n
    last = n - 1
    while last >= 0:
        g = starts_of[last]
        last = g - 1
        own = length[g]
        # Who hands its prefix to whom; positions come in ascending order, and so do those before them.
        targets: list[int] = []
        times: list[int] = []
        for i in members.pop(g):
            if group[i] != g:
                continue
            lyndon[i] = own
            j = i - 1
            while j >= 0 and group[j] >= g:
                j = before[j]
            before[i] = j
            if j >= 0:
                if targets and targets[-1] == j:
                    times[-1] += 1
                else:
                    targets.append(j)
                    times.append(1)
        if not targets:
            continue
        if len(targets) == 1:
            moves = {times[0]: targets}
        else:
            moves = {}
            for j, t in zip(targets, times):
                moves.setdefault(t, []).append(j)
        for t in sorted(moves, reverse=True):
            longer = t * own
            parted: dict[int, list[int]] = {}
            for j in moves[t]:
                parted.setdefault(group[j], []).append(j)
            for old, moved in parted.items():
                left = size[old] - len(moved)
                if not left:
                    length[old] += longer
                    members[old] = moved
                    continue
                new = old + left
                for j in moved:
                    group[j] = new
                members[new] = moved
                size[old], size[new] = left, len(moved)
                length[new] = length[old] + longer
                starts_of[new + len(moved) - 1], starts_of[new - 1] = new, old
    return lyndon, group


def _matching(a: np.ndarray, left: int, right: int, step: int) -> int:
    """How many words match from two positions on, in one direction."""
    reach, width = 0, 64
    n = len(a)
    while True:
        if step > 0:
            width_here = min(width, n - right - reach)
            x, y = a[left + reach : left + reach + width_here], a[right + reach : right + reach + width_here]
        else:
            width_here = min(width, left + 1 - reach)
            x = a[left + 1 - reach - width_here : left + 1 - reach][::-1]
            y = a[right + 1 - reach - width_here : right + 1 - reach][::-1]
        if width_here <= 0:
            return reach
        differs = np.flatnonzero(x != y)
        if len(differs):
            return reach + int(differs[0])
        reach += width_here
        width *= 2


def _extended(a: np.ndarray, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """Numbers of matching words from pairs of positions on (``left`` before ``right``), in one direction."""
    reach = np.zeros(len(left), np.int64)
    going = np.arange(len(left))
    for _ in range(TOGETHER):
        x, y = left[going] + step * reach[going], right[going] + step * reach[going]
        inside = (y < len(a)) if step > 0 else (x >= 0)
        going, x, y = going[inside], x[inside], y[inside]
        going = going[a[x] == a[y]]
        if not len(going):
            return reach
        reach[going] += 1
    for i in going.tolist():
        reach[i] += _matching(a, int(left[i]) + step * int(reach[i]), int(right[i]) + step * int(reach[i]), step)
    return reach


def _chains(a: np.ndarray, lyndon: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of what the chains of equal Lyndon words extend to, if at least two periods."""
    n = len(a)
    at = np.arange(n)
    follows = at - lyndon
    in_chain = (follows >= 0) & (group[np.maximum(follows, 0)] == group)
    heads = np.flatnonzero(~in_chain)
    period = lyndon[heads]
    heads, period = heads[heads + period < n], period[heads + period < n]
    # The words after the first root are compared with those one period before, over all of the chain.
    ahead = _extended(a, heads, heads + period, 1)
    back = _extended(a, heads - 1, heads + period - 1, -1)
    start, length = heads - back, back + period + ahead
    long = length >= np.maximum(2 * period, SHORTEST)
    return start[long], length[long], period[long]


def _runs_of(a: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs of a sequence of whole numbers."""
    signs = np.unique(a, return_inverse=True)[1]
    found = []
    for ordered in (signs, signs.max() - signs):
        lyndon, group = (np.array(x, np.int64) for x in lyndon_groups(ordered.tolist()))
        found.append(np.stack(_chains(a, lyndon, group), axis=1))
    return np.unique(np.concatenate(found), axis=0)


def _stretches(a: np.ndarray) -> np.ndarray:
    """Starts and ends of the stretches that are covered by sequences of six words which occur twice."""
    n = len(a) - TWICE + 1
    if n < 2:
        return np.zeros((0, 2), np.int64)
    grams = np.zeros(n, np.uint64)
    for i in range(TWICE):
        grams = mix(grams + a[i : i + n].astype(np.uint64) + np.uint64(1))
    order = np.argsort(grams)
    same = grams[order[1:]] == grams[order[:-1]]
    if not same.any():
        return np.zeros((0, 2), np.int64)
    twice = np.zeros(n + 1, np.int8)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    ends = np.flatnonzero(np.diff(np.concatenate(([0], twice[:n], [0]))))
    first, last = ends[::2], ends[1::2] + TWICE - 1
    # Sequences less than six words apart cover one stretch.
    joined = first[1:] > last[:-1]
    stretches = np.stack((first[np.append(True, joined)], last[np.append(joined, True)]), axis=1)
    return stretches[stretches[:, 1] - stretches[:, 0] >= SHORTEST]


def runs(words: list[bytes]) -> np.ndarray:
    """Rows (start, length, period) of the runs of twelve words or more, by start, then period."""
    numbers: dict[bytes, int] = dict.fromkeys(words)
    if len(words) < SHORTEST or len(words) - len(numbers) < TWICE:
        return np.zeros((0, 3), np.int64)
    for i, word in enumerate(numbers):
        numbers[word] = i
    a = np.array(list(map(numbers.__getitem__, words)), np.int64)
    found = [_runs_of(a[b:e]) + np.array([b, 0, 0]) for b, e in _stretches(a).tolist()]
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return every[np.lexsort((every[:, 2], every[:, 0]))]


def collapsed(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """The words without those that any run repeats, which are all after its first period."""
    if not len(found):
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, found[:, 0] + found[:, 2], 1)
    np.add.at(edges, found[:, 0] + found[:, 1], -1)
    return list(compress(words, (np.cumsum(edges[:-1]) == 0).tolist()))


def find_runs(docs: DataFrame, columns: list[str], text: str = "text") -> DataFrame:
    """The given columns with the ``runs`` of each whole text and the text without repeats, ``collapsed``.

    Words are what lies between space, tab, line feed, vertical tab, form feed and carriage return. ``runs``
    holds start (word number from 0), length and period of each run one after another, by start, then
    period; ``collapsed`` is the kept words joined by one space, as UTF-8. One row per
    input row; a null, empty or blank text has no runs and collapses to nothing.
    """

    def make() -> Callable[[list[str]], tuple]:
        def one(text: str) -> tuple[list[int], bytes]:
            words = text.encode("utf-8", "replace").split()
            found = runs(words)
            return found.ravel().tolist(), b" ".join(collapsed(words, found))

        return lambda batch: tuple(zip(*map(one, batch)))

    return per_text(docs, [*columns, text], make, "runs array<long>, collapsed binary")
