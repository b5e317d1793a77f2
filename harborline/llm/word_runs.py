"""Runs: stretches of consecutive words that repeat with a period, found through a difference-cover LCE structure.

A run has a smallest period q (words q apart are the same) and at least `max(MIN_WORDS, TIMES * q)` words, and no
neighbouring word extends it keeping that period. How far two places of a text agree (their longest common extension,
LCE) is answered from a sample of the suffixes: places whose number modulo V lies in a difference cover. For any two
places there is a step below V that leads from both to sampled ones, so an answer compares those few words and then takes
the minimum of a range of the sampled suffixes' common prefixes from a sparse table. Only sampled suffixes are sorted.

For every period q, places on a grid of step q are compared with the place q further on. A run of four periods holds a
grid place in its first q words from which the extension is over 2 q long; the start is found by halving, with the same
structure. The grids of all periods are harmonic: n log n places in all.

Defined results: a null text counts as empty; words are compared byte by byte; repeated rows and equal doc_ids stay
separate rows; texts without a run have an empty list; an empty table gives an empty one; extra columns are not looked
at. Texts of like length are worked on together, a very long one by itself with its grid cut into blocks, so memory is
bounded by a batch or one text. Rows do not depend on each other: a lost task is run again on its own rows.
"""

from __future__ import annotations

from collections import defaultdict
from fractions import Fraction
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from harborline.llm.common import arrow_map, whole_text

MIN_WORDS = 6
TIMES = 4

# A difference cover modulo 13: every difference of two numbers modulo 13 is one of two members.
V, COVER = 13, (0, 1, 3, 9)

# Words sorted together, and grid places looked at together; bounds memory, not the result.
GROUP_WORDS = 1 << 19
GRID_BLOCK = 1 << 21


def _steps() -> np.ndarray:
    """For each pair of remainders the least step that leads both into the cover."""
    table = np.empty((V, V), np.int64)
    for a in range(V):
        for b in range(V):
            table[a, b] = next(s for s in range(V) if (a + s) % V in COVER and (b + s) % V in COVER)
    return table


STEPS = _steps()


class Extensions:
    """Longest common extensions of places of one array of word numbers. Its last V words must occur nowhere else."""

    def __init__(self, words: np.ndarray):
        self.words, self.minima = words, None

    def _sort(self) -> None:
        """Order the sampled suffixes: by their first V words, then by doubling. Steps of V stay in the sample."""
        words, n = self.words, len(self.words)
        classes = [np.arange(r, n - V, V) for r in COVER]
        places = np.concatenate(classes)
        ends = np.cumsum([len(c) for c in classes])
        # The sample numbers of a remainder are consecutive; past its last one there is nothing.
        last = np.repeat(ends, [len(c) for c in classes])
        padded = np.concatenate([words, np.full(V, -1, words.dtype)])
        rank = self._ranked([padded[places + k] for k in range(V)])
        levels, width, m = [rank], 1, len(places)
        at = np.arange(m)
        while rank.max(initial=0) + 1 < m:
            beyond = at + width
            inside = beyond < last
            after = np.where(inside, rank[np.where(inside, beyond, 0)] + 1, 0)
            rank = self._ranked([rank, after])
            levels.append(rank)
            width *= 2
        order = np.empty(m, np.int64)
        order[rank] = at
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(m - 1, 0), np.int64)
        for level in range(len(levels) - 1, -1, -1):
            size, table = 1 << level, levels[level]
            open_ = np.flatnonzero((a < last[order[:-1]]) & (b < last[order[1:]])) if m > 1 else np.zeros(0, np.int64)
            same = open_[table[a[open_]] == table[b[open_]]]
            a[same] += size
            b[same] += size
            common[same] += size * V
        left, right = places[order[:-1]] + common, places[order[1:]] + common
        self._compare(left, right, np.full(len(left), V), common)
        self.rank_of = np.full(n + V, -1, np.int64)
        self.rank_of[places] = rank
        minima = [common]
        while 2 << (len(minima) - 1) <= len(common):
            half = 1 << (len(minima) - 1)
            minima.append(np.minimum(minima[-1][:-half], minima[-1][half:]))
        self.minima = minima

    @staticmethod
    def _ranked(keys: list[np.ndarray]) -> np.ndarray:
        """Numbers of the rows of keys in sorted order, equal for equal rows, without gaps."""
        order = np.lexsort(keys[::-1])
        new = np.zeros(len(order), np.int64)
        for key in keys:
            new[1:] |= key[order][1:] != key[order][:-1]
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        return rank

    def _compare(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Add to `total` how many words agree from a and b on, up to `most`; the pairs that agree in all of them."""
        words, n = self.words, len(self.words)
        live, k = np.flatnonzero(most > 0), 0
        whole = [np.flatnonzero(most <= 0)]
        while len(live):
            x, y = a[live] + k, b[live] + k
            fits = (x < n) & (y < n)
            same = live[fits][words[x[fits]] == words[y[fits]]]
            total[same] += 1
            k += 1
            done = most[same] <= k
            whole.append(same[done])
            live = same[~done]
        return np.concatenate(whole)

    def at(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words agree from each a and b on; a and b differ."""
        total = np.zeros(len(a), np.int64)
        through = self._compare(a, b, STEPS[a % V, b % V], total)
        if len(through):
            if self.minima is None:
                self._sort()
            x, y = self.rank_of[a[through] + total[through]], self.rank_of[b[through] + total[through]]
            # Places in the last words have no sampled suffix; these words occur once, so nothing agrees there.
            known = (x >= 0) & (y >= 0)
            through, x, y = through[known], x[known], y[known]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                here = level == k
                table = self.minima[k]
                total[through[here]] += np.minimum(table[low[here]], table[high[here] - (1 << int(k))])
        return total


def _grid(n: int, longest: int):
    """Blocks of (place, period): multiples of each period, for periods a text of `longest` words has room for."""
    first, top = 1, longest // TIMES
    while first <= top:
        sizes = -(-n // np.arange(first, min(top, first + GRID_BLOCK) + 1))
        many = max(1, int(np.searchsorted(np.cumsum(sizes), GRID_BLOCK, side="right")))
        sizes = sizes[:many]
        periods = np.repeat(np.arange(first, first + many), sizes)
        steps = np.arange(len(periods)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        yield steps * periods, periods
        first += many


def find_runs(texts: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """(number of the text, start, length, period) of every run in texts of word numbers from 0, in that order."""
    sizes = np.array([len(t) for t in texts], np.int64)
    # After each text stands a word of its own, so nothing extends from one text into the next.
    parts = [x for i, t in enumerate(texts) for x in (t, np.array([-2 - i], np.int64))]
    tail = -2 - len(texts) - np.arange(V)
    words = np.concatenate([*parts, tail]) if texts else tail
    starts = np.cumsum(sizes + 1) - sizes - 1
    extend, found = Extensions(words), []
    for place, period in _grid(len(words) - V, int(sizes.max(initial=0))):
        inside = place + 3 * period < len(words) - V
        place, period = place[inside], period[inside]
        # A run reaches over 2 q words further than its first grid place; most places fail in one of these words.
        for probe in (lambda q: 0, lambda q: q, lambda q: q // 2):
            at = place + probe(period)
            same = words[at] == words[at + period]
            place, period = place[same], period[same]
        ahead = extend.at(place, place + period)
        far = ahead > 2 * period
        place, period, ahead = place[far], period[far], ahead[far]
        # Places a whole period after the start are left to the grid place before them.
        earlier = place - period
        there = np.flatnonzero(earlier >= 0)
        reach = extend.at(earlier[there], place[there])
        first = np.ones(len(place), bool)
        first[there[reach >= period[there]]] = False
        place, period, ahead = place[first], period[first], ahead[first]
        low, high = np.zeros(len(place), np.int64), np.minimum(period - 1, place)
        while len(open_ := np.flatnonzero(low < high)):
            back = (low[open_] + high[open_] + 1) // 2
            agree = extend.at(place[open_] - back, place[open_] - back + period[open_]) >= back
            low[open_[agree]] = back[agree]
            high[open_[~agree]] = back[~agree] - 1
        start, length = place - low, low + period + ahead
        enough = length >= np.maximum(MIN_WORDS, TIMES * period)
        found.append(np.stack([start[enough], length[enough], period[enough]], axis=1))
    rows = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    # The same stretch also has multiples of its period; the smallest counts.
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    rows = rows[np.lexsort((rows[:, 2], rows[:, 0]))]
    text = np.searchsorted(starts, rows[:, 0], side="right") - 1
    inner = rows[:, 0] - starts[text]
    return list(zip(text.tolist(), inner.tolist(), rows[:, 1].tolist(), rows[:, 2].tolist()))


def runs_of(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of every run of each text, by start, then period. Texts of like length go together."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    order = sorted((i for i, t in enumerate(texts) if len(t) >= MIN_WORDS), key=lambda i: len(texts[i]))
    at = 0
    while at < len(order):
        group, total = [], 0
        while at < len(order) and (not group or (
            total + len(texts[order[at]]) <= GROUP_WORDS and len(texts[order[at]]) <= 2 * len(texts[group[0]])
        )):
            group.append(order[at])
            total += len(texts[order[at]])
            at += 1
        number = defaultdict(count().__next__)
        coded = [np.fromiter(map(number.__getitem__, texts[i]), np.int64, len(texts[i])) for i in group]
        for text, start, length, period in find_runs(coded):
            out[group[text]].append((start, length, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; ties: the smallest start, then period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def repetitions(docs: DataFrame) -> DataFrame:
    """doc_id, `runs` (start, length, period by start, then period), `strongest` (such a run or null) and `collapsed`,
    the text without repeated periods, its words joined by one space."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [text.split() for text in batch.column(1).to_pylist()]
        found = runs_of(texts)
        names = ("start", "length", "period")
        best = [strongest(runs) for runs in found]
        columns = [
            batch.column(0), pa.array([[dict(zip(names, r)) for r in runs] for runs in found], pa.list_(RUN)),
            pa.array([r and dict(zip(names, r)) for r in best], RUN),
            pa.array([b" ".join(collapse(t, r)) for t, r in zip(texts, found)], pa.binary()).cast(pa.string()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "runs", "strongest", "collapsed"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    one = "struct<start: bigint, length: bigint, period: bigint>"
    # Splitting bytes knows the six ASCII spaces and no others.
    source = docs.select("doc_id", whole_text().cast("binary").alias("text"))
    return arrow_map(source, run, f"doc_id {kind}, runs array<{one}>, strongest {one}, collapsed string")
