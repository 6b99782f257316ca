"""Whitening of embeddings by the covariance of their distinct vectors.

Entries are put on an integer grid, and rows with the same grid vector form one fit vector, weighted
by one or by its number of rows. Sums are exact integers. Vectors are centred before they
are multiplied: the rounded mean is taken off as integers, the remainder of the mean as doubles, so the
grid's offset costs no digits. Every task adds its weighted product matrix, of which only the upper
half is shuffled; the matrix of d columns is all the driver holds. A distinct vector is whitened once and
joined back to its rows; vectors that hold more than a 64th of all rows (63 at most) go by broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from turnmill.session import materialize

GRID_LIMIT = 1 << 40  # farther entries are moved here, so that products stay exact
HOT = 64  # a vector with more than 1 / HOT of all rows is broadcast
KEYS = ["h1", "h2"]


@dataclass(frozen=True)
class Whitening:
    components: int = 16
    scale: float = 64.0
    offset: int = 1_000_000
    weight: str = "one"  # or "count": how much a distinct vector counts in the fit


@dataclass(frozen=True)
class Centre:
    """A mean as an integer and the remainder, per dimension."""

    near: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, sums: list[int], n: int) -> Centre:
        near = [(2 * s + n) // (2 * n) for s in sums]
        rest = [(s - n * m) / n for s, m in zip(sums, near)]
        return cls(np.array(near, np.int64), np.array(rest))

    def off(self, rows: np.ndarray) -> np.ndarray:
        return (rows - self.near) - self.rest


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    values = batch.column(column).flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _gridded(vectors: DataFrame, ident: str, vector: str, how: Whitening) -> DataFrame:
    """`id, x, h1, h2` of all rows whose vector is finite throughout."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    limit = float(GRID_LIMIT)
    place = lambda c: F.floor(F.greatest(F.least(c * how.scale, F.lit(limit)), F.lit(-limit)))
    known = vectors.select(F.col(ident).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    x = F.transform("v", lambda c: place(c) + F.lit(how.offset).cast("bigint"))
    rows = known.filter(F.col("v").isNotNull() & F.forall("v", finite)).select("id", x.alias("x"))
    return rows.withColumns({"h1": F.xxhash64("x"), "h2": F.xxhash64(F.lit("second"), "x")})


def _weights(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("weight").to_numpy()


def _sums(fit: DataFrame, column: str, kind: str) -> list:
    """Weighted sums per dimension, exact for integers."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = (_matrix(batch, column) * _weights(batch)[:, None]).sum(axis=0)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["i", "s"])

    per_task = fit.select(column, "weight").mapInArrow(add, f"i bigint, s {kind}")
    found = per_task.groupBy("i").agg(F.sum("s").alias("s")).collect()
    return [row["s"] for row in sorted(found)]


def _covariance(fit: DataFrame, column: str, centre: Centre, n: int) -> np.ndarray:
    """Weighted covariance with divisor `n`, from centred products of each task."""
    d = len(centre.near)
    upper = np.triu_indices(d)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            if batch.num_rows:
                centred = centre.off(_matrix(batch, column))
                total += (centred * _weights(batch)[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0]), pa.array(upper[1]), pa.array(total[upper])], ["i", "j", "s"]
        )

    per_task = fit.select(column, "weight").mapInArrow(multiply, "i bigint, j bigint, s double")
    made = np.zeros((d, d))
    for row in per_task.groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        made[row["i"], row["j"]] = made[row["j"], row["i"]] = row["s"] / n
    return made


def _principal(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Variances, falling, and their unit vectors as columns; only those above rounding."""
    variance, vectors = np.linalg.eigh(covariance)
    variance, vectors = variance[::-1], vectors[:, ::-1]
    real = variance > max(variance[0], 0) * len(variance) * np.finfo(float).eps
    kept = np.flatnonzero(real)[:most]
    vectors = vectors[:, kept]
    largest = np.abs(vectors).argmax(axis=0)
    return variance[kept], vectors * np.sign(vectors[largest, np.arange(len(kept))])


def _deviations(rows: np.ndarray, centre: Centre, sums: list[int], n: int) -> list[Decimal]:
    """Sum over dimensions of (n * x - S)^2, exact."""
    near = rows - centre.near
    left = [s - n * int(m) for s, m in zip(sums, centre.near)]
    largest = n * int(np.abs(near).max(initial=0)) + max(map(abs, left), default=0)
    kind = np.int64 if largest**2 * max(len(left), 1) < 1 << 62 else object
    apart = near.astype(kind) * n - np.array(left, kind)
    return [Decimal(int(value)) for value in (apart * apart).sum(axis=1)]


def _whitened(fit: DataFrame, centre: Centre, sums: list[int], n: int, matrix: np.ndarray) -> DataFrame:
    """`h1, h2, weight, copies, deviation, w` of every distinct vector."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _matrix(batch, "x")
            made = centre.off(rows) @ matrix
            wide = pa.array(np.arange(len(rows) + 1) * matrix.shape[1], pa.int32())
            columns = [batch.column(name) for name in ("h1", "h2", "weight", "copies")]
            columns.append(pa.array(_deviations(rows, centre, sums, n), pa.decimal128(38, 0)))
            columns.append(pa.ListArray.from_arrays(wide, pa.array(made.ravel())))
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "weight", "copies", "deviation", "w"])

    shape = "h1 bigint, h2 bigint, weight bigint, copies bigint, deviation decimal(38,0), w array<double>"
    return materialize(fit.mapInArrow(project, shape), "whitened")


def whiten(
    vectors: DataFrame,
    how: Whitening = Whitening(),
    ident: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """`ident, component, n, deviation, whitened, explained, identity_error` per row and component.

    `n` is the weight of the fit list, `deviation` (decimal) the exact sum of `(n * x - S)^2` over dimensions,
    `whitened` the centred vector on the component over the root of its variance, `explained` the
    component's share of all variance, `identity_error` the largest absolute entry of the whitened
    vectors' covariance minus the identity. Components are numbered from 1 by falling variance; their
    largest entry is positive.

    Rows whose vector is null, or holds a null or an entry that is not finite, are left out. So are
    vectors of another length than most distinct ones have (of equally frequent lengths the largest
    counts). Grid values end at 2^40 on either side. Directions without variance, to
    double precision, are no components: equal vectors only, one vector, and an empty
    table give no rows. Repeated rows, and rows without an identifier, are all reported. Only the two
    named columns are read.
    """
    spark = vectors.sparkSession
    rows = _gridded(vectors, ident, vector, how)
    weight = F.lit(1).cast("bigint") if how.weight == "one" else F.col("copies")
    distinct = materialize(
        rows.groupBy("x", *KEYS).agg(F.count(F.lit(1)).alias("copies")).withColumn("weight", weight),
        "whiten-distinct",
    )
    lengths = distinct.groupBy(F.size("x").alias("d")).agg(
        F.count(F.lit(1)).alias("vectors"), F.sum("weight").alias("n"), F.sum("copies").alias("rows")
    )
    most = lengths.orderBy(F.desc("vectors"), F.desc("d")).first()
    shape = (
        "component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
        "identity_error double"
    )
    if most is None or not most["d"]:
        nothing = rows.limit(0).select(F.col("id").alias(ident))
        fields = [field.split() for field in shape.split(", ")]
        return nothing.select(ident, *[F.lit(None).cast(kind).alias(name) for name, kind in fields])
    n = most["n"]
    fit = distinct.filter(F.size("x") == most["d"])
    sums = _sums(fit, "x", "bigint")
    centre = Centre.of(sums, n)
    covariance = _covariance(fit, "x", centre, n)
    variance, components = _principal(covariance, how.components)
    made = _whitened(fit, centre, sums, n, components / np.sqrt(variance))
    error = 0.0
    if len(variance):
        mean = np.array(_sums(made, "w", "double")) / n
        none = np.zeros(len(mean), np.int64)
        spread = _covariance(made, "w", Centre(none, mean), n)
        error = float(np.abs(spread - np.eye(len(mean))).max())
    shares = F.array(*[F.lit(float(v)) for v in variance / (np.trace(covariance) or 1.0)])
    narrow = rows.select("id", *KEYS)
    values = made.select(*KEYS, "deviation", "w")
    hot = F.broadcast(values.filter(F.col("copies") * HOT > most["rows"]))
    joined = narrow.join(hot, KEYS).unionByName(
        narrow.join(hot.select(KEYS), KEYS, "left_anti").join(
            values.filter(F.col("copies") * HOT <= most["rows"]), KEYS
        )
    )
    return joined.select(
        F.col("id").alias(ident), "deviation", F.posexplode("w").alias("at", "whitened")
    ).select(
        ident,
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained") if len(variance) else F.lit(0.0).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
