"""Links between classes that share a bucket, without listing the pairs of a bucket.

A class is a distinct set; its buckets are such that similar classes share at least one. All tests of
pairs happen inside tasks, on blocks of a bounded number of rows and set elements, and a task
returns a spanning forest of the links it finds: fewer than it has rows.

* A bucket's head is its smallest class. A class that shares two buckets or more with a head belongs to the group of
  the one it shares most with, and that head to its own head's group, and so on for some steps. A class left
  alone joins the group of a head it shares one bucket with.
* First all members of a group are looked up among all, if they are one block; in a larger group a
  few pivots are looked up among all. This gives labels: classes of one label are connected.
* Then, in groups of several blocks, members outside the most frequent label are looked up among all, block by
  block. The same is done in every bucket whose members are of different labels and groups, so that it may
  hold pairs no group had; buckets with equal members are searched once.

So every two classes that share a bucket are either connected or were compared.

Tables of few rows are written by few tasks: their partitions are merged by counted rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from turnmill.llm.common import few_tasks, tasks_for
from turnmill.llm.components import components
from turnmill.session import materialize

Shingles = Callable[[str | None], np.ndarray]  # sorted distinct hashes of a text's shingles
# For one asked set (by its place among all sets): places of members that it is linked with.
Lookup = Callable[[int], np.ndarray]
# From the sets of a block and the places of its members.
Search = Callable[[list[np.ndarray], np.ndarray], Lookup]


@dataclass(frozen=True)
class Blocks:
    rows: int = 256  # members, and as many asked, in a block
    elements: int = 1 << 20  # set elements, about, of each
    pivots: int = 8
    whole: int = 64  # blocks of a group that is searched as a whole; larger ones bucket by bucket


TEXTS_A_TASK = 10_000
ENTRIES_A_TASK = 2_000_000
MOST_BROADCAST = 200_000  # classes, of some 50 bytes, whose identifiers are sent to all tasks
SAMPLE = 200_000  # rows looked at for large buckets
OFTEN = 200  # rows of a bucket in the sample
JUMPS = 2  # a group reaches 2 ** JUMPS heads up


def _store(df: DataFrame, name: str, rows: int) -> DataFrame:
    return materialize(few_tasks(df, rows), name)


def digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def signed_udf(shingles: Shingles, buckets: Callable[[], Callable[[np.ndarray], np.ndarray]]):
    """`n, key, buckets` of a text: size and digest of its set, and its bucket numbers. `buckets` runs
    once per task and returns the function that gives the numbers of a set."""

    @F.pandas_udf("n bigint, key binary, buckets array<bigint>")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        of = buckets()
        for texts in batches:
            sets = [shingles(text) for text in texts]
            rows = [(len(s), digest(s), of(s)) if len(s) else (0, None, None) for s in sets]
            yield pd.DataFrame(rows, columns=["n", "key", "buckets"])

    return signed


def set_components(
    docs: DataFrame,
    shingles: Shingles,
    buckets: Callable[[], Callable[[np.ndarray], np.ndarray]],
    search: Search,
    blocks: Blocks,
    ident: str,
    text: str,
) -> DataFrame:
    """`doc_id, n_shingles, component_id` for every row of `docs`: the size of its set, and the smallest
    identifier reachable over links, null where no row of the component has one.

    Equal sets are one class. A row without identifier is linked with rows of the same set only. An
    empty set has no class and the row's own identifier.
    """
    texts = docs.select(F.col(ident).alias("doc_id"), F.col(text).alias("text"))
    rows = materialize(
        texts.select("doc_id", signed_udf(shingles, buckets)("text").alias("s")).select("doc_id", "s.*"),
        "link-signed",
    )
    n_rows = rows.count()
    classes = materialize(
        rows.filter("key is not null")
        .groupBy("key")
        .agg(
            F.min("doc_id").alias("first"),
            F.first("n").alias("n"),
            F.count(F.lit(1)).alias("copies"),
            F.first("buckets").alias("buckets"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "link-classes",
    )
    entries = classes.agg(F.coalesce(F.sum(F.size("buckets")), F.lit(0)).alias("n")).first()["n"]
    labels = link_classes(
        classes.select(F.explode("buckets").alias("bucket"), "cid", "n"),
        lambda wanted, n: sets_of(texts, classes, wanted, n, shingles),
        search,
        entries,
        blocks,
    )
    # Only classes that have copies or links need more than their own identifier.
    least = (
        labels.join(classes.select(F.col("cid").alias("node"), "first"), "node")
        .groupBy("label")
        .agg(F.min("first").alias("component_id"))
    )
    linked = labels.join(least, "label").select(F.col("node").alias("cid"), "component_id")
    groups = _store(
        classes.select("cid", "key", "first", "copies")
        .join(linked, "cid", "left")
        .filter("copies > 1 or component_id is not null")
        .select("key", F.coalesce("component_id", "first").alias("component_id")),
        "link-components",
        n_rows,
    )
    component = F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return (
        rows.select("doc_id", "n", "key")
        .join(groups.withColumn("g", F.lit(True)), "key", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    )


def sets_of(
    docs: DataFrame, classes: DataFrame, wanted: DataFrame, n_wanted: int, shingles: Shingles
) -> DataFrame:
    """`cid, hashes` of the classes in `wanted`, read again from `docs` (`doc_id, text`).

    `classes` holds `cid, key, first`: the digest of the set, and an identifier of a row that has it;
    a class without any is left out.
    """

    @F.pandas_udf("binary")
    def sets(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        # Takes the key too, so that it comes after the join that finds the texts.
        for texts, keys in batches:
            found = [shingles(text) for text in texts]
            same = [digest(f) == bytes(k) for f, k in zip(found, keys)]
            yield pd.Series([f.tobytes() if s else None for f, s in zip(found, same)], dtype=object)

    first = _store(classes.join(wanted, "cid").select("cid", "key", "first"), "link-first", n_wanted)
    if n_wanted <= MOST_BROADCAST:  # else texts are shuffled too
        first = F.broadcast(first)
    texts = docs.join(first, F.col("doc_id") == F.col("first"))
    found = texts.select("cid", sets("text", "key").alias("hashes"))
    # Rows of one identifier may have other texts than the one wanted, or the same text again.
    found = materialize(found.filter("hashes is not null"), "link-found")
    repeated = found.groupBy("cid").count().filter("count > 1")
    if not repeated.limit(1).count():
        return found
    return materialize(found.groupBy("cid").agg(F.first("hashes").alias("hashes")), "link-sets")


def link_classes(
    spread: DataFrame,
    sets: Callable[[DataFrame, int], DataFrame],
    search: Search,
    entries: int,
    blocks: Blocks = Blocks(),
) -> DataFrame:
    """`node, label` of all classes linked with another; the label is the smallest class reached.

    `spread` holds `bucket, cid, n` (class and size of its set), `entries` rows; `sets` gives `cid, hashes` of
    the classes in a table `cid` of so many rows.
    """
    members = materialize(_members(spread, entries), "link-members")
    groups = _groups(members)
    n = groups.count()
    if not n:
        return groups.select(F.col("cid").alias("node"), F.col("cid").alias("label"))
    known = sets(groups.select("cid"), n)
    first = _search(_asked_first(groups, blocks), known, search, n, blocks)
    # Of a group in several blocks a class may have several labels; any of them is right.
    labels = first.groupBy("cid").agg(F.min("root").alias("label"))
    placed = _store(groups.join(labels, "cid", "left").withColumn("label", F.coalesce("label", "cid")), "link-placed", n)
    left = _in_groups(placed, blocks).union(_in_buckets(members, placed, blocks))
    more = _search(left, known, search, n, blocks)
    return components(first.union(more), "root", "cid", n)


def _members(spread: DataFrame, entries: int) -> DataFrame:
    """`bucket, cid, n, head` of the buckets with several classes; `head` is the smallest.

    Rows are shuffled by bucket and sorted once, and runs are found as they stream by. Buckets that a sample
    shows to be large, `SAMPLE / OFTEN` at most, are kept out of that shuffle: their heads are combined minima.
    """
    share = min(1.0, SAMPLE / max(entries, 1))
    counted = spread.sample(share, seed=1).groupBy("bucket").agg(F.count(F.lit(1)).alias("times"))
    large = materialize(counted.filter(F.col("times") >= OFTEN).select("bucket"), "link-large")
    some = large.count()
    cold = spread.join(F.broadcast(large), "bucket", "left_anti") if some else spread
    tasks = tasks_for(spread.sparkSession, entries, ENTRIES_A_TASK)
    sorted_ = cold.select("bucket", "cid", "n").repartition("bucket").coalesce(tasks).sortWithinPartitions("bucket", "cid")
    made = sorted_.mapInArrow(_shared, "bucket bigint, cid bigint, n bigint, head bigint")
    if not some:
        return made
    hot = spread.join(F.broadcast(large), "bucket").select("bucket", "cid", "n")
    heads = hot.groupBy("bucket").agg(F.min("cid").alias("head"))
    return made.union(hot.join(F.broadcast(heads), "bucket").select("bucket", "cid", "n", "head"))


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by `bucket, cid` whose bucket has several, with the first one as head."""
    names = ["bucket", "cid", "n"]
    open_ = np.zeros((3, 0), np.int64)  # the last row so far, as its bucket may go on
    head, several = 0, False  # of the last row's bucket

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.concatenate([open_, np.stack([batch.column(name).to_numpy() for name in names])], axis=1)
        before = rows.shape[1] - batch.num_rows
        bucket, cid = rows[0], rows[1]
        begins = np.concatenate([[True], bucket[1:] != bucket[:-1]])
        first = np.maximum.accumulate(np.where(begins, np.arange(len(bucket)), 0))
        heads = cid[first]
        if before and several:  # the open row's run began earlier
            heads = np.where(first == 0, head, heads)
        with_next = np.concatenate([~begins[1:], [False]])
        keep = ~begins | with_next
        if before:
            keep[0] |= several
        # The last row waits for the next batch.
        last = len(bucket) - 1
        out = np.flatnonzero(keep[:last])
        yield pa.RecordBatch.from_arrays([pa.array(column[out]) for column in (*rows, heads)], [*names, "head"])
        head, several = int(heads[last]), bool(~begins[last]) or bool(before and several and first[last] == 0)
        open_ = rows[:, last:]
    if open_.shape[1] and several:
        columns = [*open_, np.array([head])]
        yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], [*names, "head"])


def _groups(members: DataFrame) -> DataFrame:
    """`cid, n, grp` of every class, with the count `m` and the set elements `e` of its group."""
    best = (
        members.filter("head <> cid")
        .groupBy("head", "cid")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("cid")
        .agg(F.min(F.struct((-F.col("times")).alias("less"), "head")).alias("m"))
        .select("cid", F.col("m.head").alias("up"), (F.col("m.less") < -1).alias("strong"))
    )
    sized = members.groupBy("cid").agg(F.first("n").alias("n"))
    n = members.select("cid").distinct().count()
    grp = F.when(F.col("strong"), F.col("up")).otherwise(F.col("cid"))
    home = _store(
        sized.join(best, "cid", "left").select("cid", "n", grp.alias("grp"), F.coalesce("up", "cid").alias("up")),
        "link-home",
        n,
    )
    for _ in range(JUMPS):
        up = home.select(F.col("cid").alias("grp"), F.col("grp").alias("higher"))
        home = _store(home.join(up, "grp").select("cid", "n", F.col("higher").alias("grp"), "up"), "link-home", n)
    # Classes alone in their group join the group of the head they share one bucket with.
    counts = home.groupBy("grp").agg(F.count(F.lit(1)).alias("m"))
    up = home.select(F.col("cid").alias("up"), F.col("grp").alias("higher"))
    own = F.when(F.col("m") > 1, F.col("grp")).otherwise(F.col("higher"))
    home = _store(home.join(counts, "grp").join(up, "up").select("cid", "n", own.alias("grp")), "link-home", n)
    counts = home.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("e"))
    return _store(home.join(counts, "grp").select("cid", "n", "grp", "m", "e"), "link-groups", n)


def _blocks(rows: str, elements: str, blocks: Blocks):
    return F.greatest(
        F.lit(1), F.ceil(F.col(rows) / blocks.rows), F.ceil(F.col(elements) / blocks.elements)
    ).cast("int")


ASKED = ["grp", "kind", "cid", "n", "label", "asked"]


def _asked_first(groups: DataFrame, blocks: Blocks) -> DataFrame:
    """Groups of several members: all asked if they are one block, else some pivots."""
    rows = groups.filter("m > 1").withColumns(
        {"mb": _blocks("m", "e", blocks), "label": F.col("cid"), "kind": F.lit("group")}
    )
    small = rows.filter("mb = 1").withColumn("asked", F.lit(True))
    place = Window.partitionBy("grp").orderBy(F.xxhash64("cid"), "cid")
    large = rows.filter("mb > 1")
    pivots = (
        large.withColumn("place", F.row_number().over(place))
        .filter(F.col("place") <= blocks.pivots)
        .select("cid", F.lit(True).alias("asked"))
    )
    large = large.join(pivots, "cid", "left").fillna(False, ["asked"])
    return small.select(ASKED).union(large.select(ASKED))


def _outside_top(rows: DataFrame) -> DataFrame:
    """Rows `grp, kind, cid, n, label` with those asked that are not of their group's most frequent label."""
    top = (
        rows.groupBy("grp", "label")
        .agg(F.count(F.lit(1)).alias("times"))
        .groupBy("grp")
        .agg(F.max(F.struct("times", "label")).alias("m"), F.count(F.lit(1)).alias("labels"))
        .filter("labels > 1")
        .select("grp", F.col("m.label").alias("top"))
    )
    return rows.join(top, "grp").withColumn("asked", F.col("label") != F.col("top")).select(ASKED)


def _in_groups(placed: DataFrame, blocks: Blocks) -> DataFrame:
    mb = _blocks("m", "e", blocks)
    rows = placed.filter((mb > 1) & (mb <= blocks.whole)).withColumn("kind", F.lit("group"))
    return _outside_top(rows)


def _in_buckets(members: DataFrame, placed: DataFrame, blocks: Blocks) -> DataFrame:
    """Members of the buckets that are of several labels and not inside one group searched as a whole."""
    known = placed.select("cid", "grp", "label", (_blocks("m", "e", blocks) <= blocks.whole).alias("whole"))
    rows = members.select("bucket", "cid", "n").join(known, "cid")
    left = (
        rows.groupBy("bucket")
        .agg(
            (F.min("label") == F.max("label")).alias("connected"),
            ((F.min("grp") == F.max("grp")) & F.bool_and("whole")).alias("searched"),
            F.count(F.lit(1)).alias("m"),
            F.bit_xor(F.xxhash64("cid")).alias("h1"),
            F.bit_xor(F.xxhash64("cid", F.lit(1))).alias("h2"),
        )
        .filter("not connected and not searched")
        .groupBy("h1", "h2", "m")
        .agg(F.min("bucket").alias("bucket"))
        .select("bucket")
    )
    open_ = materialize(
        rows.join(left, "bucket").select(
            F.col("bucket").alias("grp"), F.lit("bucket").alias("kind"), "cid", "n", "label"
        ),
        "link-open",
    )
    return _outside_top(open_)


def _search(rows: DataFrame, sets: DataFrame, search: Search, n: int, blocks: Blocks) -> DataFrame:
    """Stars `root, cid` of what is connected by links of the asked rows (`ASKED`) to members of their group.

    A group of one block is one group of rows, each there once. Of any other, every block of asked rows meets
    every block of members.
    """
    key = ["grp", "kind"]
    parts = (
        rows.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("m"),
            F.sum("n").alias("e"),
            F.count_if("asked").alias("q"),
            F.coalesce(F.sum(F.when(F.col("asked"), F.col("n"))), F.lit(0)).alias("qe"),
        )
        .filter("q > 0")
        .select(*key, _blocks("m", "e", blocks).alias("mb"), _blocks("q", "qe", blocks).alias("qb"))
    )
    rows = rows.join(parts, key)
    part = lambda salt, of: F.pmod(F.xxhash64("cid", F.lit(salt)), F.col(of)).cast("int")
    every = lambda of: F.sequence(F.lit(0), F.col(of) - 1)
    place = lambda x, y, member, asked: F.struct(
        x.alias("x"), y.alias("y"), F.lit(member).alias("member"), asked.alias("asked")
    )
    zero, yes, no = F.lit(0), F.lit(True), F.lit(False)
    own, asked = part(1, "mb"), part(2, "qb")
    held = F.transform(every("qb"), lambda y: place(own, y, True, no))
    met = F.when(F.col("asked"), F.transform(every("mb"), lambda x: place(x, asked, False, yes)))
    several = F.concat(held, F.coalesce(met, F.array().cast(_PLACES)))
    places = F.when(F.col("mb") == 1, F.array(place(zero, zero, True, F.col("asked")))).otherwise(several)
    dealt = rows.select(*key, "cid", "label", F.explode(places).alias("p")).select(
        *key, "p.x", "p.y", "cid", "label", "p.member", "p.asked"
    )
    block = [*key, "x", "y"]
    together = dealt.join(sets, "cid").repartition(*block)
    together = together.coalesce(tasks_for(rows.sparkSession, n, TEXTS_A_TASK)).sortWithinPartitions(*block)

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[tuple[int, int]] = []
        for rows in _runs(batches, block):
            made += _stars(rows, search)
            if len(made) > 10_000:
                yield pa.RecordBatch.from_pandas(pd.DataFrame(made, columns=["root", "cid"]))
                made = []
        yield pa.RecordBatch.from_pandas(pd.DataFrame(made, columns=["root", "cid"], dtype="int64"))

    return materialize(together.mapInArrow(stars, "root bigint, cid bigint"), "link-stars")


_PLACES = "array<struct<x: int, y: int, member: boolean, asked: boolean>>"


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = list(zip(*[batch.column(name).to_pylist() for name in key]))
        start = 0
        for at, one in enumerate(keys):
            if one != last:
                if at > start:
                    held.append(batch.slice(start, at - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], at, one
        if len(keys) > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def _stars(rows: pa.Table, search: Search) -> list[tuple[int, int]]:
    column = lambda name: rows.column(name).to_numpy()
    sets = [np.frombuffer(value.as_buffer(), np.uint64) for chunk in rows.column("hashes").chunks for value in chunk]
    return forest(column("cid"), column("label"), column("member"), column("asked"), sets, search)


def forest(
    cids: np.ndarray, labels: np.ndarray, member: np.ndarray, asked: np.ndarray, sets: list[np.ndarray], search: Search
) -> list[tuple[int, int]]:
    """`root, cid` of the rows of a block that its links and labels connect with others: a star per
    component, around its smallest asked class."""
    asked, member = np.flatnonzero(asked), np.flatnonzero(member)
    if not len(asked) or not len(member):
        return []
    _, joined = np.unique(labels, return_inverse=True)
    lookup, linked = None, False
    for at in asked:
        if (joined == joined[0]).all():
            break
        if (joined[member] == joined[at]).all():
            continue
        lookup = lookup or search(sets, member)
        for other in lookup(at):
            if joined[other] != joined[at]:
                joined[joined == joined[other]] = joined[at]
                linked = True
    if not linked:
        return []
    roots: dict[int, int] = {}
    for at in asked[np.argsort(cids[asked], kind="stable")]:
        roots.setdefault(joined[at], int(cids[at]))
    return [(roots[j], int(c)) for j, c in zip(joined, cids) if j in roots and roots[j] != c]
