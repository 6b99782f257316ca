"""Near-duplicate documents by min-max hashing.

A document is its set of five-word shingles. Under each of a family of hash functions both the
smallest and the largest value are kept, so half as many functions give a signature; both agree
for two sets with the probability of their Jaccard similarity. Bands of five values are bucket keys.

Equal sets collapse into one class first. Classes that share a bucket are compared on their full sets
(`linking`): a block of classes becomes an inverted index of shingles, in which the intersection with
each asked class is counted. No pairs are listed, and of two classes that share a bucket
either both end in one component or they were compared. With 50 bands of five a pair at
similarity 0.75 shares no bucket with probability 1.4e-6.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from turnmill.llm.linking import Blocks, Lookup, set_components

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SHINGLE = 5


@dataclass(frozen=True)
class MinMax:
    bands: int = 50
    rows: int = 5
    percent: int = 75  # linked if 100 * intersection >= percent * union
    block: int = 4096  # shingles hashed at once
    blocks: Blocks = Blocks()  # of classes that are compared

    @property
    def functions(self) -> int:
        return -(-self.bands * self.rows // 2)


def _odd(count: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    return draw.integers(0, 1 << 63, count, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_PLACE = _odd(SHINGLE, 3)


def shingles(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of `width` words, at most five."""
    words = text.encode().translate(LOWER).split() if text else []
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    wide = min(n, width)
    count = n - wide + 1
    total = np.full(count, wide, np.uint64)
    for k in range(wide):
        total += one[k : k + count] * _PLACE[k]
    found = np.sort(_mix(total))
    return found[np.append(True, found[1:] != found[:-1])]


class Signer:
    def __init__(self, how: MinMax) -> None:
        self.how = how
        self.times = _odd(how.functions, 5)[:, None]
        self.plus = _odd(how.functions, 6)[:, None]
        self.place = _odd(how.rows, 7)[:, None]
        self.band = _odd(how.bands, 8)

    def bands(self, hashes: np.ndarray) -> np.ndarray:
        how = self.how
        low = np.full(how.functions, np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(how.functions, np.uint64)
        for start in range(0, len(hashes), how.block):
            values = hashes[None, start : start + how.block] * self.times + self.plus
            np.minimum(low, values.min(axis=1), out=low)
            np.maximum(high, values.max(axis=1), out=high)
        # Rows of a band lie far apart, so that they come from different functions.
        rows = np.concatenate([low, high])[: how.bands * how.rows].reshape(how.rows, how.bands)
        return _mix((rows * self.place).sum(axis=0, dtype=np.uint64) + self.band).view(np.int64)


def counted(percent: int):
    """Search of a block by counting how many shingles of the asked set each member holds."""

    def search(sets: list[np.ndarray], member: np.ndarray) -> Lookup:
        size = np.array([len(sets[k]) for k in member])
        every = np.concatenate([sets[k] for k in member])
        order = np.argsort(every, kind="stable")
        owner = np.repeat(np.arange(len(member)), size)[order]
        code, start = np.unique(every[order], return_index=True)
        stop = np.append(start[1:], len(owner))

        def lookup(asked: int) -> np.ndarray:
            wanted = sets[asked]
            at = np.minimum(np.searchsorted(code, wanted), len(code) - 1)
            at = at[code[at] == wanted]
            if not len(at):
                return member[:0]
            hits = np.concatenate([owner[a:b] for a, b in zip(start[at], stop[at])])
            common = np.bincount(hits, minlength=len(member))
            return member[100 * common >= percent * (size + len(wanted) - common)]

        return lookup

    return search


def near_duplicates(
    docs: DataFrame, how: MinMax = MinMax(), ident: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `docs`.

    Words are runs without ASCII white space, A-Z in lower case. A text of fewer than five words is one
    shingle; null, empty and blank texts have none, are linked with nothing and kept. `component_id`
    is the smallest id reachable over links, `kept` says that it is the row's own. Repeated rows of one id are all
    reported, all kept or none. A row without id is linked with rows of the same set only; where
    a component has no id, `component_id` is null and the row is kept. An empty table gives an empty result.
    Only the two named columns are read.
    """
    made = set_components(
        docs, shingles, lambda: Signer(how).bands, counted(how.percent), how.blocks, ident, text
    )
    own = F.col("component_id").isNull() | F.col("doc_id").eqNullSafe(F.col("component_id"))
    return made.withColumn("kept", own)
