"""Runs of repeated words, found in a grammar of the texts.

The words of a batch of documents become ids, and Re-Pair makes one grammar of them all: in each round
every pair that is locally the most frequent (more so than the pairs that overlap it) gets a rule, so
that all occurrences of a passage, also those in other documents, are one nonterminal. When no
pair repeats, neighbours are joined until each document is one symbol.

Any stretch of a document crosses the boundary between the two halves of exactly one lowest nonterminal that holds
it. So runs across each nonterminal's boundary are computed once, on one place where it occurs: a run of
four periods has two of them on one side of the boundary, which is a square that starts or ends there, and
is extended both ways. Squares are looked for by doubling classes of periods; multiples of a shorter period that reaches as
far are passed over. Runs are then carried to all places where their nonterminal is derived,
and what lies within a longer run of the same period is merged into it.

Documents are worked on in groups of about `Runs.words` words, a longer document alone. Time grows as
the words times the depth of the grammar.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Runs:
    least: int = 6  # words in a run
    periods: int = 4  # periods in a run; at least four, as two have to lie on one side
    rounds: int = 48  # of Re-Pair; then neighbours are joined
    words: int = 1 << 18  # about, in one grammar
    at_once: int = 1 << 18  # candidates compared together


class Grammar:
    """Rules of a batch of id sequences. Symbols below `terminals` are words."""

    def __init__(self, ids: np.ndarray, doc: np.ndarray, rounds: int) -> None:
        self.terminals = int(ids.max(initial=-1)) + 1
        self.left, self.right, self.place = [], [], []
        self.length = np.ones(self.terminals, np.int64)
        self.steps = [self.terminals]  # symbols after each round
        self.symbols, self.starts, self.doc = ids, np.arange(len(ids)), doc
        for _ in range(rounds):
            if not self._replace(self._frequent()):
                break
        while self._replace(self._neighbours()):
            pass
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.left, self.right, self.place = join(self.left), join(self.right), join(self.place)

    def _pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Codes of neighbours, and whether they are in one document."""
        codes = self.symbols[:-1] * len(self.length) + self.symbols[1:]
        return codes, self.doc[:-1] == self.doc[1:]

    def _frequent(self) -> np.ndarray:
        """Places of pairs that are more frequent than those that overlap them."""
        codes, together = self._pairs()
        at = np.flatnonzero(together)
        _, kind, times = np.unique(codes[at], return_inverse=True, return_counts=True)
        rank = np.zeros(len(codes), np.int64)
        repeated = times[kind] > 1
        # Of equally frequent pairs the one with the smaller code comes first.
        rank[at[repeated]] = (times[kind] * (len(times) + 1) + len(times) - kind)[repeated]
        # In a stretch of one word only every second pair counts.
        same = np.zeros(len(rank), bool)
        same[1:] = (rank[1:] == rank[:-1]) & (rank[1:] > 0)
        since = np.arange(len(rank))
        begin = np.maximum.accumulate(np.where(same, 0, since))
        rank[(since - begin) % 2 == 1] = 0
        padded = np.concatenate([[0], rank, [0]])
        return np.flatnonzero((rank > padded[:-2]) & (rank > padded[2:]))

    def _neighbours(self) -> np.ndarray:
        """Places of the first, third, ... symbol of each document that has a follower."""
        _, together = self._pairs()
        first = np.flatnonzero(np.concatenate([[True], ~together]))
        since = np.arange(len(together)) - np.repeat(first, np.diff(np.append(first, len(self.symbols))))[:-1]
        return np.flatnonzero(together & (since % 2 == 0))

    def _replace(self, at: np.ndarray) -> bool:
        if not len(at):
            return False
        codes, first, kind = np.unique(
            self.symbols[at] * len(self.length) + self.symbols[at + 1], return_index=True, return_inverse=True
        )
        left, right = self.symbols[at[first]], self.symbols[at[first] + 1]
        self.left.append(left)
        self.right.append(right)
        self.place.append(self.starts[at[first]])
        symbols = self.symbols.copy()
        symbols[at] = len(self.length) + kind
        self.length = np.concatenate([self.length, self.length[left] + self.length[right]])
        self.steps.append(len(self.length))
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        self.symbols, self.starts, self.doc = symbols[stay], self.starts[stay], self.doc[stay]
        return True


def _agreement(ids: np.ndarray, a: np.ndarray, b: np.ndarray, step: int, most: np.ndarray) -> np.ndarray:
    """How many of the `most` words from `a` and from `b` on, in direction `step`, are equal."""
    found = np.zeros(len(a), np.int64)
    open_, width = np.arange(len(a)), 8
    while len(open_):
        done = found[open_, None] + np.arange(width)
        inside = done < most[open_, None]
        x = np.where(inside, a[open_, None] + step * done, 0)
        y = np.where(inside, b[open_, None] + step * done, 0)
        equal = inside & (ids[x] == ids[y])
        every = equal.all(axis=1)
        found[open_] += np.where(every, width, equal.argmin(axis=1))
        open_ = open_[every]
        width = min(width * 2, max(8, (1 << 20) // max(len(open_), 1)))
    return found


def _pieces(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of about `most` in size."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    start = 0
    while start < len(sizes):
        stop = max(start + 1, int(np.searchsorted(total, total[start] + most, "right")) - 1)
        yield slice(start, stop)
        start = stop


def _one_side(
    ids: np.ndarray, origin: np.ndarray, own: np.ndarray, other: np.ndarray, step: int, how: Runs
) -> tuple[np.ndarray, ...]:
    """`node, period, ahead, behind` of periodic stretches with a square on one side of a boundary.

    `origin` is the word next to the boundary; `own` words lie from there on in direction `step`, `other`
    words behind it. A stretch has `ahead` of the former and `behind` of the latter.
    """
    largest = np.minimum(own // 2, (own + other) // how.periods)
    known = [np.zeros(0, np.int64)] * 3  # node, period, reach of all squares so far
    made = [[], [], [], []]
    low = 1
    while len(nodes := np.flatnonzero(largest >= low)):
        counts = np.minimum(largest[nodes], 2 * low - 1) - low + 1
        squares = [[], [], []]
        for part in _pieces(counts, how.at_once):
            node = np.repeat(nodes[part], counts[part])
            first = np.cumsum(counts[part]) - counts[part]
            period = low + np.arange(len(node)) - np.repeat(first, counts[part])
            at = origin[node]
            for share in (0, 1, 0.5):  # cheap tests first, of three words of the period
                near = at + step * (share * (period - 1)).astype(np.int64)
                equal = ids[near] == ids[near + step * period]
                node, period, at = node[equal], period[equal], at[equal]
            node, period = _primitive(node, period, known)
            at = origin[node]
            ahead = _agreement(ids, at, at + step * period, step, own[node] - period)
            square = ahead >= period
            for kept, values in zip(squares, (node, period, ahead)):
                kept.append(values[square])
        node, period, ahead = map(np.concatenate, squares)
        at = origin[node]
        behind = _agreement(ids, at - step, at - step + step * period, -step, other[node])
        known = [np.concatenate(pair) for pair in zip(known, (node, period, period + ahead))]
        order = np.argsort(known[0], kind="stable")
        known = [values[order] for values in known]
        whole = ahead + period + behind
        run = (behind > 0) & (whole >= np.maximum(how.least, how.periods * period))
        for kept, values in zip(made, (node, period, ahead + period, behind)):
            kept.append(values[run])
        low *= 2
    return tuple(np.concatenate(part) if part else np.zeros(0, np.int64) for part in made)


def _primitive(node: np.ndarray, period: np.ndarray, known: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Leaves out multiples of a known period of the same node that reaches at least as far."""
    nodes, periods, reaches = known
    low, high = np.searchsorted(nodes, node, "left"), np.searchsorted(nodes, node, "right")
    good = np.ones(len(node), bool)
    for k in range(int((high - low).max(initial=0))):
        at = np.flatnonzero(low + k < high)
        seen = low[at] + k
        good[at[(period[at] % periods[seen] == 0) & (period[at] <= reaches[seen])]] = False
    return node[good], period[good]


def _crossing(grammar: Grammar, ids: np.ndarray, how: Runs) -> tuple[np.ndarray, ...]:
    """`rule, start, stop, period` of runs across a rule's boundary, places relative to the rule."""
    halves = grammar.length[grammar.left], grammar.length[grammar.right]
    rules = np.flatnonzero(halves[0] + halves[1] >= how.least)
    left, right = halves[0][rules], halves[1][rules]
    middle = grammar.place[rules] + left
    node, period, ahead, behind = _one_side(ids, middle, right, left, 1, how)
    found = [(rules[node], left[node] - behind, left[node] + ahead, period)]
    node, period, ahead, behind = _one_side(ids, middle - 1, left, right, -1, how)
    found.append((rules[node], left[node] - ahead, left[node] + behind, period))
    rows = np.unique(np.stack([np.concatenate(part) for part in zip(*found)], axis=1), axis=0)
    return tuple(rows.T)


def _derived(grammar: Grammar, runs: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """`start, stop, period` of the runs at all places their rule is derived."""
    rule, low, high, period = runs
    first = np.searchsorted(rule, np.arange(len(grammar.left)), "left")
    own = np.searchsorted(rule, np.arange(len(grammar.left)), "right") - first
    holds = np.zeros(len(grammar.length), bool)  # itself or anything below it
    for start, stop in zip(grammar.steps, grammar.steps[1:]):
        at = slice(start - grammar.terminals, stop - grammar.terminals)
        holds[start:stop] = (own[at] > 0) | holds[grammar.left[at]] | holds[grammar.right[at]]
    symbols, places = grammar.symbols, grammar.starts
    made = []
    while True:
        live = holds[symbols]
        rules, places = symbols[live] - grammar.terminals, places[live]
        if not len(rules):
            break
        which = np.repeat(np.arange(len(rules)), own[rules])
        nth = np.arange(len(which)) - np.repeat(np.cumsum(own[rules]) - own[rules], own[rules])
        at = first[rules[which]] + nth
        made.append((places[which] + low[at], places[which] + high[at], period[at]))
        left, right = grammar.left[rules], grammar.right[rules]
        symbols = np.concatenate([left, right])
        places = np.concatenate([places, places + grammar.length[left]])
    if not made:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*made))


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of one period that share at least a period of words become one."""
    if not len(start):
        return start, stop, period
    order = np.lexsort((start, period))
    start, stop, period = start[order], stop[order], period[order]
    apart = period * (int(stop.max()) + 1)  # keeps periods from each other
    reach = np.maximum.accumulate(stop + apart)
    new = np.concatenate([[True], (start + apart)[1:] > reach[:-1] - period[1:]])
    at = np.flatnonzero(new)
    start, period = start[at], period[at]
    stop = reach[np.append(at[1:], len(reach)) - 1] - apart[at]
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def runs_of(sequences: list[np.ndarray], how: Runs = Runs()) -> list[np.ndarray]:
    """Rows `start, length, period`, by start and period, for each sequence of small ids."""
    sizes = np.array([len(s) for s in sequences], np.int64)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    ids = np.concatenate([*sequences, np.zeros(0, np.int64)]).astype(np.int64)
    grammar = Grammar(ids, np.repeat(np.arange(len(sizes)), sizes), how.rounds)
    start, stop, period = _merged(*_derived(grammar, _crossing(grammar, ids, how)))
    rows = np.stack([start, stop - start, period], axis=1)
    doc = np.searchsorted(begin, start, "right") - 1
    cut = np.searchsorted(doc, np.arange(len(sizes) + 1))
    return [rows[a:b] - [before, 0, 0] for a, b, before in zip(cut, cut[1:], begin)]


def _strongest(rows: np.ndarray) -> dict | None:
    if not len(rows):
        return None
    start, length, period = min(rows.tolist(), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
    return {"start": start, "length": length, "period": period}


def _described(words: list[bytes], rows: np.ndarray) -> tuple:
    """Fields of one document's result."""
    if len(rows):
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, rows[:, 0] + rows[:, 2], 1)
        np.add.at(edge, rows[:, 0] + rows[:, 1], -1)
        words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    runs = [{"start": s, "length": n, "period": p} for s, n, p in rows.tolist()]
    return runs, _strongest(rows), b" ".join(words).decode()


RUN = "struct<start: bigint, length: bigint, period: bigint>"


def word_runs(text: Column, how: Runs = Runs()) -> Column:
    """`struct<runs, strongest, collapsed>` of a text column.

    Words are stretches without ASCII white space. `runs` holds every maximal stretch of at least
    `how.least` words and `how.periods` smallest periods, as `start` (a word's number from 0), `length` and
    `period` in words, by start and then period. `strongest` is the one with most periods (the
    exact ratio; ties: smaller start, then period), null without runs. `collapsed` is the text without the words that a
    run repeats, all but its first period, with one space between words.

    A null, empty or blank text has no runs and collapses to an empty text. Texts may have any length.
    """
    schema = f"struct<runs: array<{RUN}>, strongest: {RUN}, collapsed: string>"

    @F.pandas_udf(schema)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            words = [text.encode().split() if text else [] for text in texts]
            rows = []
            for part in _pieces(np.array([len(w) for w in words], np.int64), how.words):
                known = defaultdict(count().__next__)
                group = words[part]
                ids = [np.fromiter((known[w] for w in ws), np.int64, len(ws)) for ws in group]
                rows += [_described(ws, r) for ws, r in zip(group, runs_of(ids, how))]
            yield pd.DataFrame(rows, columns=["runs", "strongest", "collapsed"])

    return found(text)
