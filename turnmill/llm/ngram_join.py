"""Jaccard join of documents by T-occurrence search on word n-grams.

Linked sets of sizes a and b differ in at most k = (a + b) * (100 - percent) / (100 + percent) shingles. So if
shingles are dealt into k + 1 parts by their hash, at least one part of both sets is equal, and the
parts' digests are buckets without loss (`parts`). Sizes fall into classes such that linked sets
are in the same or the next class; a set has the parts of both.

Inside a block (`linking`) the search is T-occurrence: a linked member holds at least T of the asked
set's shingles. The block's inverted lists of these shingles are divided by DivideSkip: up to T - 1 of the longest
are put aside, the short ones are merged with counts, and members that reach T less the number of long lists
are looked up in each long list by binary search. Overlaps are exact, so links are. The merge counts all
short lists in one vector operation in place of a heap; it gives the same counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from turnmill.llm.linking import Blocks, Lookup, set_components
from turnmill.llm.neardup import _mix, shingles

SPARE = 20  # a set leaves out one of its smallest parts per so many differences


@dataclass(frozen=True)
class NgramJoin:
    width: int = 3
    percent: int = 90  # linked if 100 * intersection >= percent * union
    skip: float = 0.0085  # how much a longer longest list lowers the number of lists put aside
    blocks: Blocks = Blocks()


def _next_bound(bound: int, percent: int) -> int:
    return bound * 100 // percent + 1


@lru_cache(maxsize=1 << 16)
def size_class(size: int, percent: int) -> int:
    """Number of the class of a size: sizes of linked sets are in the same or the next class."""
    bound, number = 1, 0
    while (after := _next_bound(bound, percent)) <= size:
        bound, number = after, number + 1
    return number


def differences(size: int, percent: int) -> int:
    """In how many elements two linked sets of at most `size` elements can differ."""
    return 2 * size * (100 - percent) // (100 + percent)


@lru_cache(maxsize=None)
def _scheme(number: int, percent: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Bounds of the ranges of hashes that are the parts of a scheme, a number of each part, and how
    many parts a set leaves out; None where linked sets are equal."""
    bounds = [1]
    while len(bounds) < number + 2:
        bounds.append(_next_bound(bounds[-1], percent))
    k = differences(bounds[number + 1] - 1, percent)
    if not k:
        return None
    spare = k // SPARE
    count = k + 1 + 2 * spare
    edges = (np.arange(1, count) * (2.0**64 / count)).astype(np.uint64)
    numbers = _mix(np.arange(1, count + 1, dtype=np.uint64) + np.uint64(number << 32))
    return edges, numbers, spare


def parts(hashes: np.ndarray, percent: int) -> np.ndarray:
    """Digests of the parts of a sorted set, in the schemes of its own and of the next size class.

    A scheme has k + 1 + 2e parts, so linked sets have at least 1 + 2e equal ones. Each set leaves
    out its e smallest parts, which many others may have by chance; one equal part is left at least.
    """
    own = size_class(len(hashes), percent)
    made = []
    for number in (own, own + 1):
        scheme = _scheme(number, percent)
        if scheme is None:
            continue
        edges, numbers, spare = scheme
        ends = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
        total = np.concatenate([[np.uint64(0)], np.cumsum(_mix(hashes + np.uint64(number)))])
        digests = _mix(total[ends[1:]] - total[ends[:-1]] + numbers)
        if spare:
            digests = digests[np.argsort(np.diff(ends), kind="stable")[spare:]]
        made.append(digests)
    return np.concatenate(made).view(np.int64) if made else np.zeros(0, np.int64)


def divide_skip(percent: int, skip: float = NgramJoin.skip):
    """T-occurrence search of a block."""

    def search(sets: list[np.ndarray], member: np.ndarray) -> Lookup:
        m = len(member)
        size = np.array([len(sets[k]) for k in member])
        every = np.concatenate([sets[k] for k in member])
        order = np.argsort(every, kind="stable")
        owner = np.repeat(np.arange(m), size)[order]  # rising inside each list
        code, start, length = np.unique(every[order], return_index=True, return_counts=True)
        placed = np.repeat(np.arange(len(code)), length) * m + owner  # rising throughout

        def lookup(asked: int) -> np.ndarray:
            n = len(sets[asked])
            least = -(-percent * n // 100)  # T
            at = np.minimum(np.searchsorted(code, sets[asked]), len(code) - 1)
            lists = at[code[at] == sets[asked]]
            if len(lists) < least:
                return member[:0]
            lists = lists[np.argsort(length[lists], kind="stable")]
            aside = min(least - 1, int(least / (1 + skip * math.log2(length[lists[-1]]))))
            short, long = np.split(lists, [len(lists) - aside])
            merged = np.concatenate([owner[a : a + k] for a, k in zip(start[short], length[short])])
            common = np.bincount(merged, minlength=m)
            sized = (percent * size <= 100 * n) & (percent * n <= 100 * size)
            near = np.flatnonzero((common >= least - aside) & sized)
            probe = long[:, None] * m + near
            held = placed[np.minimum(np.searchsorted(placed, probe), len(placed) - 1)] == probe
            common = common[near] + held.sum(axis=0)
            return member[near[100 * common >= percent * (size[near] + n - common)]]

        return lookup

    return search


def ngram_components(
    docs: DataFrame, how: NgramJoin = NgramJoin(), ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs`.

    Words are runs without ASCII white space, A-Z in lower case; a set holds the distinct shingles
    of `how.width` words (at most five). A text of fewer words is one shingle; null, empty and blank texts have none
    and are linked with nothing. `component_id` is the smallest id reachable over links, the row's own
    included. Repeated rows of one id are all reported. A row without id is linked with rows of the same set
    only; where a component has no id, `component_id` is null. An empty table gives an empty result.
    Only the two named columns are read.
    """
    width, percent = how.width, how.percent
    return set_components(
        docs,
        lambda value: shingles(value, width),
        lambda: lambda hashes: parts(hashes, percent),
        divide_skip(percent, how.skip),
        how.blocks,
        ident,
        text,
    )
