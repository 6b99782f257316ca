"""Next-fit packing of all rows in one order, by composing what blocks do to the open bin.

A bin is closed when the next item does not fit, so where an item goes depends on all items before it,
but only through one number: how full the bin is in which a block of items begins. What a block
makes of that is a step function (`Step`): entries that are equally soon full end alike. Blocks of a bounded number
of rows give their functions on their own; functions of neighbours are composed, 256 at a time, until
few are left; then every block's entry follows from the top down, and blocks fill their bins on
their own again. The bins do not depend on how rows are dealt into blocks or partitions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from turnmill.config import PACKED_LENGTH
from turnmill.session import materialize

BLOCK_ROWS = 50_000  # about, in one block; draw keys are uniform
FAN = 256  # blocks whose functions are composed at once
KEY_DIGITS = 12

# Pieces of a block's function, by rising `upto`: an entry of at most `upto` tokens, and of more than
# the piece before takes, leaves with `fill` tokens (`plus` that of the entry if no bin was opened)
# after opening `opened` bins.
STEP = "block bigint, upto bigint, plus boolean, fill bigint, opened bigint"


def _next_starts(ends: np.ndarray, capacity: int) -> np.ndarray:
    """For a bin that begins at each item, where the next one begins."""
    begins = np.concatenate([[0], ends[:-1]])
    return np.maximum(np.searchsorted(ends, begins + capacity, "right"), np.arange(len(ends)) + 1)


def block_step(lengths: np.ndarray, capacity: int) -> pd.DataFrame:
    """The function of a block of items. An entry of `capacity` + 1 stands for any bin that is over."""
    ends = np.cumsum(lengths)
    n = len(ends)
    after = _next_starts(ends, capacity)
    fill, opened = np.zeros(n, np.int64), np.ones(n, np.int64)
    for at in range(n - 1, -1, -1):
        if after[at] < n:
            fill[at], opened[at] = fill[after[at]], opened[after[at]] + 1
        else:
            fill[at] = ends[-1] - (ends[at - 1] if at else 0)
    fill = np.minimum(fill, capacity + 1)
    # Entries up to capacity - ends[k] still take item k; more than that opens a bin there.
    room = np.concatenate([capacity - ends, [-1]])
    last = int(np.searchsorted(ends, capacity, "right"))  # no entry takes this item
    pieces = []
    if last == n:
        pieces.append((int(room[n - 1]), True, int(ends[-1]), 0))
    for at in range(min(last, n - 1), -1, -1):
        upto = int(room[at - 1]) if at else capacity + 1
        pieces.append((upto, False, int(fill[at]), int(opened[at])))
    made = pd.DataFrame(pieces, columns=["upto", "plus", "fill", "opened"])
    # Items of no tokens give pieces that nothing falls into.
    return made[~made["upto"].duplicated(keep="first")].reset_index(drop=True)


def _entry(steps: pd.DataFrame, fill: int) -> tuple[int, int]:
    """Fill and opened bins after a block that is entered with `fill`."""
    row = steps.iloc[int(np.searchsorted(steps["upto"].to_numpy(), fill, "left"))]
    return int(row["fill"]) + (fill if row["plus"] else 0), int(row["opened"])


def compose(first: pd.DataFrame, second: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """The function of two neighbouring blocks."""
    pieces, low = [], 0
    limits = second["upto"].to_numpy()
    for upto, plus, fill, opened in first.itertuples(index=False):
        if plus:
            # The entry is still in it, so the second block's limits cut this piece.
            while low <= upto:
                at = int(np.searchsorted(limits, low + fill, "left"))
                stop = min(upto, int(limits[at]) - fill)
                then = second.iloc[at]
                value = int(then["fill"]) + (fill if then["plus"] else 0)
                pieces.append((stop, bool(then["plus"]), value, opened + int(then["opened"])))
                low = stop + 1
        else:
            after, more = _entry(second, int(fill))
            pieces.append((upto, False, min(after, capacity + 1), opened + more))
        low = max(low, upto + 1)
    merged = []
    for piece in pieces:
        if merged and merged[-1][1:] == piece[1:]:
            merged[-1] = piece
        else:
            merged.append(piece)
    return pd.DataFrame(merged, columns=["upto", "plus", "fill", "opened"])


_PIECES = ["upto", "plus", "fill", "opened"]


def _blocks(rows: pd.DataFrame) -> list[tuple[int, pd.DataFrame]]:
    return [
        (int(block), own.sort_values("upto")[_PIECES].reset_index(drop=True))
        for block, own in rows.groupby("block", sort=True)
    ]


def _composed(steps: DataFrame, capacity: int) -> DataFrame:
    """The functions of `FAN` neighbours each, under the number of their group."""

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        blocks = _blocks(rows)
        whole = blocks[0][1]
        for _, own in blocks[1:]:
            whole = compose(whole, own, capacity)
        return whole.assign(block=blocks[0][0] // FAN)[["block", *_PIECES]]

    return steps.groupBy(F.floor(F.col("block") / FAN)).applyInPandas(together, STEP)


def _entered(steps: DataFrame, above: DataFrame | None, capacity: int) -> DataFrame:
    """`block, fill, bin`: how each block is entered, and in which bin. `above` tells it for the
    groups of `FAN` blocks; without it there is one group, and nothing is open."""
    start = steps.withColumn("grp", F.floor(F.col("block") / FAN) if above is not None else F.lit(0))
    if above is None:
        start = start.withColumns({"g_fill": F.lit(capacity + 1).cast("bigint"), "g_bin": F.lit(-1).cast("bigint")})
    else:
        named = above.select(F.col("block").alias("grp"), F.col("fill").alias("g_fill"), F.col("bin").alias("g_bin"))
        start = start.join(named, "grp")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        fill, number = int(rows["g_fill"].iloc[0]), int(rows["g_bin"].iloc[0])
        made = []
        for block, own in _blocks(rows):
            made.append((block, fill, number))
            fill, opened = _entry(own, fill)
            number += opened
        return pd.DataFrame(made, columns=["block", "fill", "bin"])

    return start.groupBy("grp").applyInPandas(walk, "block bigint, fill bigint, bin bigint")


def fill_bins(lengths: np.ndarray, capacity: int, fill: int, number: int) -> np.ndarray:
    """Bins of a block's items, if it is entered with `fill` tokens in bin `number`."""
    ends = np.cumsum(lengths)
    at = int(np.searchsorted(ends, capacity - fill, "right")) if fill <= capacity else 0
    bins = np.full(len(ends), number, np.int64)
    after = _next_starts(ends, capacity)
    while at < len(ends):
        number += 1
        bins[at : after[at]] = number
        at = int(after[at])
    return bins


def next_fit(
    rows: DataFrame, ident: str, capacity: int = PACKED_LENGTH, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """`ident, n_tokens, bin, oversized` of rows `ident, n_tokens, draw_key`: next-fit over all rows in the order of
    `draw_key` (uniform hex) and `ident`.

    Bins are numbered from 0. An item over `capacity` has a bin alone. Rows without a length are left out.
    A task holds a block of about `block_rows` rows, or the functions of 256 blocks.
    """
    narrow = rows.select(ident, F.col("n_tokens").cast("bigint"), "draw_key").filter("n_tokens is not null")
    n_blocks = max(1, -(-narrow.count() // block_rows))
    place = F.conv(F.substring("draw_key", 1, KEY_DIGITS), 16, 10).cast("double")
    block = F.floor(place * F.lit(float(n_blocks)) / F.lit(float(16**KEY_DIGITS)))
    items = materialize(narrow.withColumn("block", block), "pack-items")

    def ordered(own: pd.DataFrame) -> pd.DataFrame:
        return own.sort_values(["draw_key", ident], ignore_index=True)

    def step(own: pd.DataFrame) -> pd.DataFrame:
        found = block_step(ordered(own)["n_tokens"].to_numpy(), capacity)
        return found.assign(block=int(own["block"].iloc[0]))[["block", *_PIECES]]

    levels = [materialize(items.groupBy("block").applyInPandas(step, STEP), "pack-steps")]
    while n_blocks > FAN:
        levels.append(materialize(_composed(levels[-1], capacity), "pack-steps"))
        n_blocks = -(-n_blocks // FAN)
    entries = None
    for steps in reversed(levels):
        entries = materialize(_entered(steps, entries, capacity), "pack-entries")

    def place_items(own: pd.DataFrame) -> pd.DataFrame:
        own = ordered(own)
        fill, number = int(own["fill"].iloc[0]), int(own["bin"].iloc[0])
        bins = fill_bins(own["n_tokens"].to_numpy(), capacity, fill, number)
        return own.assign(bin=bins)[[ident, "n_tokens", "bin"]]

    schema = f"`{ident}` {dict(rows.dtypes)[ident]}, n_tokens bigint, bin bigint"
    return (
        items.join(entries, "block")
        .groupBy("block")
        .applyInPandas(place_items, schema)
        .withColumn("oversized", F.col("n_tokens") > capacity)
    )
