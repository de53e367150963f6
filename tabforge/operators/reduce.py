"""PCA path: FEA4-FEA8, WIN2, SNK7.

mean-impute -> standardize (population std) -> PCA(k) fitted on train. Every statistic is a sum over
rows that tasks form in numpy and Spark merges in steps, so tables of thousands of columns need no
column-by-column plan, and no d x d matrix exists anywhere.

The components come from a randomized block Krylov iteration (Musco and Musco, NIPS 2015) on the covariance: one
pass over the written, standardised-on-the-fly rows gives ``C Q`` for a block ``Q`` of ``k`` and a few more
columns; the driver keeps the blocks (d x a few k), orthogonalises them, and takes the Ritz vectors. It ends when
the residuals ``C v - lambda v`` of the first ``k`` are small, or when the blocks span everything. Component
signs are fixed (largest-|loading| positive) so results are reproducible.
Projection is an Arrow-batched numpy matmul per partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from .blocks import MERGE
from .wquantile import cell_slices


@dataclass
class PCAPathModel:
    mean: np.ndarray
    scale: np.ndarray
    components: np.ndarray          # d x k, sign-fixed
    explained_variance_ratio: np.ndarray

    def transform(self, df: DataFrame, features: str, keep: list[str], out: str = "pca") -> DataFrame:
        """FEA7: ``(keep..., out array<double>)``; NaN/NULL cells take the
        train mean (so they standardize to 0)."""
        bc = df.sparkSession.sparkContext.broadcast((self.mean, self.scale, self.components))

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def project(xs: pd.Series) -> pd.Series:
            mean, scale, comp = bc.value
            x = np.stack(xs.to_numpy()).astype(np.float64)
            x = np.where(np.isnan(x), mean[None, :], x)
            z = (x - mean[None, :]) / scale[None, :]
            return pd.Series(list(z @ comp))

        arr = vector_to_array(F.col(features))
        return df.select(*keep, project(arr).alias(out))

    def save(self, spark, path: str) -> None:
        """SNK7: one row of arrays in Parquet."""
        row = (self.mean.tolist(), self.scale.tolist(), self.components.tolist(), self.explained_variance_ratio.tolist())
        spark.createDataFrame([row], "mean array<double>, scale array<double>, components array<array<double>>, "
                              "ratio array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> "PCAPathModel":
        r = spark.read.parquet(path).first()
        return cls(*(np.asarray(r[c], dtype=float) for c in ("mean", "scale", "components", "ratio")))

    def variance_table(self, spark) -> DataFrame:
        """FEA8 + WIN2: ``(component, ratio, cumulative_ratio)``."""
        rows = [(i, float(r)) for i, r in enumerate(self.explained_variance_ratio)]
        df = spark.createDataFrame(rows, "component int, ratio double")
        w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)  # k rows
        return df.withColumn("cumulative_ratio", F.sum("ratio").over(w))


def vector_moments(arrays: DataFrame) -> DataFrame:
    """``(i, m, v)``: mean and population variance of each position of ``a`` over its present cells (neither NULL
    nor NaN); NULL for a position without any."""
    width = arrays.select(F.max(F.size("a"))).first()[0] or 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, width))
        for batch in batches:
            for _, x in cell_slices(batch, "a", width):
                total = _merged(total, _moments(x))
        yield _sums_row(total)

    total = _added(_cells(arrays).mapInArrow(scan, SUMS), _merged)
    n, mean, spread = total.reshape(3, width) if total is not None else np.zeros((3, 0))
    rows = [(i, float(mean[i]) if n[i] else None, float(spread[i] / n[i]) if n[i] else None) for i in range(len(n))]
    return arrays.sparkSession.createDataFrame(rows, "i int, m double, v double")


SUMS = "g int, sums binary"


def _cells(arrays: DataFrame) -> DataFrame:
    nan = F.lit(float("nan"))
    return arrays.select(F.transform("a", lambda x: F.coalesce(x.cast("double"), nan)).alias("a"))


def _moments(x: np.ndarray) -> np.ndarray:
    """Count, mean and sum of squared differences of each column's present cells."""
    here = ~np.isnan(x)
    n = here.sum(axis=0)
    mean = np.where(here, x, 0.0).sum(axis=0) / np.maximum(n, 1)
    return np.vstack([n, mean, (np.where(here, x - mean, 0.0) ** 2).sum(axis=0)])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of two parts together (Chan, Golub and LeVeque)."""
    a, b = a.reshape(3, -1), b.reshape(3, -1)
    n = a[0] + b[0]
    safe = np.maximum(n, 1)
    apart = b[1] - a[1]
    return np.vstack([n, (a[0] * a[1] + b[0] * b[1]) / safe, a[2] + b[2] + apart**2 * a[0] * b[0] / safe])


def _sums_row(total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["g", "sums"])


def _added(sums: DataFrame, join=np.add) -> np.ndarray | None:
    """The tasks' arrays merged: groups of ``MERGE`` tasks first, then all groups."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        total = reduce(join, (np.frombuffer(raw) for raw in group["sums"]))
        return pd.DataFrame({"g": [0], "sums": [np.ascontiguousarray(total).tobytes()]})

    dealt = sums.withColumn("g", F.floor(F.spark_partition_id() / MERGE).cast("int"))
    rows = dealt.groupBy("g").applyInPandas(merge, SUMS).groupBy("g").applyInPandas(merge, SUMS).collect()
    return np.frombuffer(bytes(rows[0]["sums"])) if rows else None


#: Columns of a block beyond the wanted components, and the residual, as a share of the greatest
#: eigenvalue, at which a component counts as found.
EXTRA = 10
TOLERANCE = 1e-8


def covariance_times(arrays: DataFrame, mean: np.ndarray, scale: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, float, int]:
    """``Z' (Z q)`` over all rows, the trace of ``Z' Z``, and the number of rows; ``Z`` is the standardised
    matrix, with 0 in empty cells."""
    d, width = q.shape
    held = arrays.sparkSession.sparkContext.broadcast((mean, scale, q))  # d x a few k numbers

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, s, v = held.value
        out, squares, n = np.zeros((d, width)), 0.0, 0
        for batch in batches:
            for _, x in cell_slices(batch, "a", d):
                z = np.nan_to_num((x - m) / s, nan=0.0)
                out += z.T @ (z @ v)
                squares += float((z * z).sum())
                n += len(z)
        yield _sums_row(np.r_[out.ravel(), squares, n])

    total = _added(arrays.mapInArrow(scan, SUMS))
    return total[:-2].reshape(d, width), float(total[-2]), int(total[-1])


def principal_components(arrays: DataFrame, mean: np.ndarray, scale: np.ndarray, k: int, seed: int = 42,
                         tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` components (d x k), their eigenvalues as shares of the trace, and their residuals as shares
    of the greatest eigenvalue."""
    d = len(mean)
    k = min(k, d)
    rng = np.random.default_rng(seed)
    block = np.linalg.qr(rng.normal(size=(d, min(d, k + EXTRA))))[0]
    basis, image = np.zeros((d, 0)), np.zeros((d, 0))
    while True:
        product, trace, _ = covariance_times(arrays, mean, scale, block)
        basis, image = np.hstack([basis, block]), np.hstack([image, product])
        small = basis.T @ image
        values, vectors = np.linalg.eigh((small + small.T) / 2)
        values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
        components = basis @ vectors
        top = max(float(values[0]), np.finfo(float).tiny) if len(values) else 1.0
        residuals = np.linalg.norm(image @ vectors - components * values, axis=0) / top
        if residuals.max(initial=0.0) <= tolerance or basis.shape[1] >= d:
            return components, values / trace if trace > 0 else np.zeros(k), residuals
        for _ in range(2):
            product = product - basis @ (basis.T @ product)
        q, r = np.linalg.qr(product)
        block = q[:, np.abs(np.diag(r)) > 1e-13 * top][:, : d - basis.shape[1]]
        for _ in range(2):
            block = np.linalg.qr(block - basis @ (basis.T @ block))[0]
        if block.shape[1] == 0:
            return components, values / trace if trace > 0 else np.zeros(k), residuals


def fit_pca_path(train: DataFrame, features: str, k: int) -> PCAPathModel:
    """FEA4 + FEA5 + FEA6 on a vector column."""
    ensure_checkpoint_dir(train.sparkSession)
    # Every pass reads the cells again: written once.
    arrays = _cells(train.select(vector_to_array(F.col(features)).alias("a"))).checkpoint(eager=True)
    stats = sorted(vector_moments(arrays).collect())  # one row per column
    mean = np.array([r["m"] if r["m"] is not None else 0.0 for r in stats])
    var = np.array([r["v"] if r["v"] is not None else 0.0 for r in stats])
    scale = np.where(var > 0, np.sqrt(var), 1.0)
    comp, ratio, _ = principal_components(arrays, mean, scale, k)
    signs = np.sign(comp[np.argmax(np.abs(comp), axis=0), np.arange(comp.shape[1])])
    signs[signs == 0] = 1.0
    return PCAPathModel(mean=mean, scale=scale, components=comp * signs[None, :], explained_variance_ratio=ratio)
