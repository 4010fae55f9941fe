"""Embedding whitening by a covariance over distinct vectors, weighted by how often each occurs.

1. Entries become whole numbers ``x = floor(scale * c) + offset``. Rows with the same vector of them are one class: a shuffled
   aggregate (partial counts first) leaves each distinct vector once with its number of rows, which is its weight.
2. Tasks add up exact sums of weight times x, then, with the mean known, the weighted products of centred vectors
   (one matrix product a batch). Only sums of the size d and d x d leave a task.
3. The driver finds the eigenvectors of the d x d covariance. Each distinct vector is whitened once and joined back.

Vectors that make up 1/1024 of all rows or more, at most 1,024 of them, are joined by a broadcast; every other one has few rows, so
no task of the shuffled join gets many. The driver holds d x d numbers (8 d^2 bytes: 134 MB at d = 4,096).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import hash128

#: A vector with at least n / FREQUENT rows is joined by a broadcast: there are at most this many.
FREQUENT = 1024
RESULT = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _finite(c: Column) -> Column:
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _vectors(df: DataFrame, id_col: str, vec_col: str, scale: int, offset: int) -> DataFrame:
    """``vec_id``, ``x``, and a 128-bit hash of it, of rows whose entries are all finite."""
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    rows = df.where(F.col(vec_col).isNotNull()).select(F.col(id_col).alias("vec_id"), v.alias("v")).where(F.forall("v", _finite))
    rows = rows.select("vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("long") + F.lit(offset).cast("long")).alias("x"))
    h1, h2 = hash128(F.col("x"))
    return rows.select("vec_id", "x", h1.alias("h1"), h2.alias("h2"))


def _sums(classes: DataFrame, d: int) -> tuple[int, list[int]]:
    """The number of rows and the exact sums of their vectors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * d, 0
        for batch in batches:
            x, w = _matrix(batch.column(0), d), batch.column(1).to_numpy(zero_copy_only=False)
            if not len(w):
                continue
            if float(np.abs(x).max(initial=0)) * float(w.sum()) >= 2.0 ** 62:
                x, w = x.astype(object), w.astype(object)
            total = [t + int(s) for t, s in zip(total, (x * w[:, None]).sum(axis=0), strict=True)]
            n += int(w.sum())
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([Decimal(v) for v in [n, *total]], pa.decimal128(38, 0))],
                                             names=["i", "s"])

    rows = classes.select("x", "weight").mapInArrow(run, "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    found = {r["i"]: int(r["s"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


class _Centre:
    """Takes the mean S / n off whole numbers: the whole part exactly, the rest as a double."""

    def __init__(self, n: int, sums: list[int]):
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([float(Fraction(s % n, n)) for s in sums])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest


def _covariance(classes: DataFrame, d: int, n: int, centre: _Centre) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            c, w = centre(_matrix(batch.column(0), d)), batch.column(1).to_numpy(zero_copy_only=False)
            total += (c * w[:, None]).T @ c
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    rows = classes.select("x", "weight").mapInArrow(run, "i int, row array<double>")
    cells = rows.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((d, d))
    for r in cells.collect():  # d x d numbers
        out[r["i"], r["j"]] = r["v"]
    return (out + out.T) / (2 * n)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2 in whole numbers; None where a long can't hold it."""
    top = max(float(n) * float(np.abs(x).max(initial=0)), max(map(abs, sums), default=0))
    if top < 2.0 ** 61:
        off = x * n - np.array(sums, np.int64)
        if float(np.abs(off).max(initial=0)) ** 2 * max(off.shape[1], 1) < 2.0 ** 62:
            return (off * off).sum(axis=1).tolist()
    exact = [sum((int(v) * n - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist()]
    return [v if v < 2 ** 63 else None for v in exact]


def _whitened(classes: DataFrame, d: int, n: int, sums: list[int], centre: _Centre, axes: np.ndarray) -> DataFrame:
    """Each distinct vector with its deviation and its coordinates."""
    k = axes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0), d)
            flat = pa.array((centre(x) @ axes).ravel(), pa.float64(), from_pandas=True)  # undefined coordinates are null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(x) * k + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in (2, 3, 1)] + [pa.array(_deviations(x, n, sums), pa.int64()), lists],
                                             names=["h1", "h2", "weight", "deviation", "w"])

    return classes.select("x", "weight", "h1", "h2").mapInArrow(run, "h1 long, h2 long, weight long, deviation long, w array<double>")


def _identity_error(white: DataFrame, n: int, used: list[int]) -> float | None:
    """How far the covariance of the defined coordinates is from the identity, at most."""
    if not used:
        return None
    at = lambda i: F.col("w")[i]
    means = white.agg(*[(F.sum(at(i) * F.col("weight")) / n).alias(f"m{i}") for i in used]).first()
    off = {i: at(i) - F.lit(float(means[f"m{i}"])) for i in used}
    pairs = [(i, j) for i in used for j in used if i <= j]
    cov = white.agg(*[(F.sum(off[i] * off[j] * F.col("weight")) / n).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cov[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = 8, scale: int = 1024,
           offset: int = 100_000) -> DataFrame:
    """Coordinates of each row's vector on the first ``components`` principal axes, each with variance one over all rows.

    Returns for each usable row and component (from 1, by falling variance): ``vec_id``, ``component``, ``n`` (usable rows), ``deviation``
    (sum over dimensions of (n x - S)^2, exact), ``whitened``, ``explained`` (the component's share of the variance) and ``identity_error``
    (largest absolute entry of the whitened covariance minus the identity).

    Rows whose vector is null or holds a null, a NaN or an infinity take no part, nor do vectors of another length than
    most have (of equally frequent lengths the larger counts). Null and repeated ids are rows like others. A
    component without variance (all vectors equal, or fewer distinct ones than components) has a null ``whitened`` and takes
    no part in ``identity_error``, which is null if there is none; ``explained`` is then null or 0. ``deviation`` is null beyond 2^63 - 1. Empty vectors and an empty table give an
    empty result. Other columns aren't read.
    """
    spark = df.sparkSession
    schema = RESULT.format(df.schema[id_col].dataType.simpleString())
    rows = _vectors(df, id_col, vec_col, scale, offset)
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None or lengths["d"] == 0:
        return spark.createDataFrame([], schema)
    d = lengths["d"]
    rows = rows.where(F.size("x") == d)
    classes = materialize(rows.groupBy("h1", "h2", "x").agg(F.count(F.lit(1)).alias("weight")), "vectors")
    n, sums = _sums(classes, d)
    centre = _Centre(n, sums)
    cov = _covariance(classes, d, n, centre)
    e, axes = np.linalg.eigh(cov)
    k = min(components, d)
    e, axes = e[::-1][:k], axes[:, ::-1][:, :k]
    trace = float(np.trace(cov))
    defined = e > max(trace, 0.0) * d * np.finfo(float).eps
    axes = np.where(defined, axes / np.sqrt(np.where(defined, e, 1.0)), np.nan)
    white = materialize(_whitened(classes, d, n, sums, centre, axes), "whitened")
    error = _identity_error(white, n, np.flatnonzero(defined).tolist())

    key = ["h1", "h2"]
    ids, of = rows.select("vec_id", *key), white.select(*key, "deviation", "w")
    often = F.col("weight") * FREQUENT >= n
    frequent = F.broadcast(white.where(often).select(*key, "deviation", "w"))
    names = F.broadcast(white.where(often).select(*key))
    rare = ids.join(names, key, "left_anti").join(of, key)
    joined = ids.join(frequent, key).unionByName(rare)
    share = [max(float(v), 0.0) / trace if trace > 0 else None for v in e]
    explained = F.element_at(F.array(*[F.lit(v).cast("double") for v in share]), F.col("component"))
    out = joined.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    out = out.withColumn("component", (F.col("at") + 1).cast("int"))
    return out.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
                      F.lit(error).cast("double").alias("identity_error"))
