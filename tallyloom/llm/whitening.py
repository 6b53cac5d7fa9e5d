"""Whitening of embeddings from a covariance over distinct vectors.

Identical vectors are grouped first. The covariance is a weighted centred matrix product
over the distinct vectors, with their counts (or one) as weights; each distinct vector is
whitened once and joined back to its rows.

All fitted sums are exact: entries become whole numbers, partitions multiply them in
whichever arithmetic holds their products without rounding, and the partial sums meet as
decimals, one per dimension or pair of dimensions. The driver sees those sums alone and
takes the eigenvectors; no vector passes through it.

Rows: a vector that is null, empty, or holds a null, non-finite or unusably large entry
(``|scale * c|`` of 2^52 or more) is left out; what remains must be of one length, else an
error names the lengths. Repeated rows count as often as they stand there and each gets its
own result, a null id too; an empty table gives no rows. Other columns are not touched.
A component without variance (equal vectors, fewer vectors than dimensions) has null in
``whitened`` and does not enter ``identity_error``; without any variance ``explained`` is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import tidy
from tallyloom.sources.staging import written

_LARGE = 2.0**52
_EXACT = pa.decimal128(38, 0)


def _usable(vector: Column, scale: int) -> Column:
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * F.lit(float(scale))) < _LARGE))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _whole(vector: Column, scale: int, shift: int) -> Column:
    return F.transform(vector, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint") + F.lit(shift))


def _matrix(rows: pa.RecordBatch, dims: int) -> np.ndarray:
    return rows.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _product(left: np.ndarray, right: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over rows of weight * left' right as Python integers, without rounding."""
    most = float(np.abs(left).max(initial=1)) * float(np.abs(right).max(initial=1)) * float(weights.sum())
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    a, b, w = left.astype(kind), right.astype(kind), weights.astype(kind)
    out = (a * w[:, None]).T @ b
    return (out.astype(np.int64) if kind is np.float64 else out).astype(object)


def _sums(dims: int):
    """Per partition, the weighted sum of each dimension."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows in parts:
            w = rows.column("weight").to_numpy()
            part = _product(np.ones((len(w), 1), np.int64), _matrix(rows, dims), w)[0]
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array(map(Decimal, total.tolist()), _EXACT)], names=["i", "value"])

    return run


def _moments(dims: int, centre: np.ndarray):
    """Per partition, the upper triangle of the weighted product of the centred vectors."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for rows in parts:
            y = _matrix(rows, dims) - centre
            part = _product(y, y, rows.column("weight").to_numpy())
            total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(dims)
            values = pa.array(map(Decimal, total[i, j].tolist()), _EXACT)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), values], names=["i", "j", "value"])

    return run


class Fit:
    """Size, sums, mean and whitening axes of the fit list."""

    def __init__(self, n: int, sums: list[int], most: int):
        self.n, self.sums, self.most = n, sums, most
        self.centre = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([float(Fraction(s % n, n)) for s in sums])  # mean less centre

    def solve(self, moments: dict[tuple[int, int], int]) -> None:
        d, n = len(self.sums), self.n
        over = [s % n for s in self.sums]
        v = np.empty((d, d))
        for (i, j), m in moments.items():
            v[i, j] = v[j, i] = float(Fraction(n * m - over[i] * over[j], n * n))
        values, axes = np.linalg.eigh(v)
        values, axes = values[::-1][: self.most], axes[:, ::-1][:, : self.most]
        signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        trace = float(np.trace(v))
        self.explained = [float(e) / trace if trace > 0 else None for e in values]
        self.live = values > d * 2.0**-52 * max(float(values[0]), 0.0)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.axes = np.where(self.live, axes * signs / np.sqrt(values), 0.0)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.rest) @ self.axes

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact: S = n centre + over."""
        far = float(np.abs(x - self.centre).max(initial=0) + 1) * self.n
        kind = np.int64 if far * far * x.shape[1] < 2.0**62 else object
        t = (x - self.centre).astype(kind) * self.n - np.array([s % self.n for s in self.sums], kind)
        return (t * t).sum(axis=1).tolist()


def _apply(fit: Fit, dims: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in parts:
            x = _matrix(rows, dims)
            z = fit.whitened(x)
            flat = pa.array(z.ravel(), mask=~np.broadcast_to(fit.live, z.shape).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), flat)
            far = pa.array(map(Decimal, fit.deviations(x)), _EXACT)
            yield pa.RecordBatch.from_arrays([rows.column("key"), rows.column("x"), rows.column("weight"), far, lists], names=["key", "x", "weight", "deviation", "z"])

    return run


def _spread(k: int):
    """Per partition, the weighted sums of the whitened values and of their products."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for rows in parts:
            z = np.nan_to_num(rows.column("z").flatten().to_numpy(zero_copy_only=False).reshape(-1, k))
            w = rows.column("weight").to_numpy().astype(float)
            total += np.vstack([(z * w[:, None]).T @ z, w @ z])
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], names=["i", "j", "value"])

    return run


def _identity_error(whole: DataFrame, fit: Fit) -> float | None:
    k = len(fit.explained)
    got = np.zeros((k + 1, k))
    for r in whole.select("weight", "z").mapInArrow(tidy(_spread(k)), "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        got[r["i"], r["j"]] = r["value"]
    mean = got[k] / fit.n
    error = np.abs(got[:k] / fit.n - np.outer(mean, mean) - np.eye(k))[np.ix_(fit.live, fit.live)]
    return float(error.max()) if error.size else None


def whiten(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 8,
    weights: str = "counts", scale: int = 1024, shift: int = 100_000,
) -> DataFrame:
    """A row per usable vector and component: its whitened value and what the fit says of it.

    ``key``, component (from 1), n (size of the fit list), deviation (exact, decimal),
    whitened, explained, identity_error. ``weights``: "counts" fits on every row, "one" on
    every distinct vector.
    """
    if weights not in ("counts", "one"):
        raise ValueError(f"weights is 'counts' or 'one', not {weights!r}")
    names = f"`{key}` bigint, component int, n bigint, deviation decimal(38,0), whitened double, explained double, identity_error double"
    entries = vectors.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    rows = entries.filter(_usable(F.col("v"), scale)).select("id", _whole(F.col("v"), scale, shift).alias("x"))
    rows = written(rows.withColumn("key", F.xxhash64("x")), "whiten-rows")
    counted = F.count("*") if weights == "counts" else F.lit(1).cast("bigint")
    distinct = written(rows.groupBy("key", "x").agg(counted.alias("weight")), "whiten-distinct")
    n, least, most = distinct.agg(F.sum("weight"), F.min(F.size("x")), F.max(F.size("x"))).first()
    if n is None:
        return vectors.sparkSession.createDataFrame([], names)
    if least != most:
        raise ValueError(f"vectors of {least} to {most} entries have no common covariance")
    sums = distinct.mapInArrow(tidy(_sums(most)), "i int, value decimal(38,0)").groupBy("i").agg(F.sum("value").alias("s")).collect()
    fit = Fit(n, [int(r["s"]) for r in sorted(sums, key=lambda r: r["i"])], components)
    products = distinct.mapInArrow(tidy(_moments(most, fit.centre)), "i int, j int, value decimal(38,0)")
    fit.solve({(r["i"], r["j"]): int(r["m"]) for r in products.groupBy("i", "j").agg(F.sum("value").alias("m")).collect()})
    whole = written(distinct.mapInArrow(tidy(_apply(fit, most)), "key bigint, x array<bigint>, weight bigint, deviation decimal(38,0), z array<double>"), "whitened")
    explained = F.array(*[F.lit(e).cast("double") for e in fit.explained])
    each = rows.join(whole.drop("weight"), ["key", "x"]).select("id", "deviation", F.posexplode("z").alias("at", "whitened"))
    return each.select(
        F.col("id").alias(key), (F.col("at") + 1).cast("int").alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("at")).alias("explained"), F.lit(_identity_error(whole, fit)).cast("double").alias("identity_error"),
    )
