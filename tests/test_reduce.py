"""Components of wide tables without a d x d matrix."""

import time

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabforge.operators import reduce as R


def frame(spark, x):
    rows = [(i, [None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a array<double>")


def standardised(x):
    mean, var = np.nanmean(x, axis=0), np.nanvar(x, axis=0)
    return np.nan_to_num((x - mean) / np.where(var > 0, np.sqrt(var), 1.0))


def test_components_equal_eigh(spark, monkeypatch):
    monkeypatch.setattr(R, "MERGE", 2)
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 64)) @ rng.normal(size=(64, 64)) + 5
    x[:, 7] = 3.0
    x[rng.random(x.shape) < 0.03] = np.nan
    df = frame(spark, x).repartition(7)
    stats = sorted(R.vector_moments(df).collect())
    assert np.allclose([r["m"] for r in stats], np.nanmean(x, axis=0)) and np.allclose([r["v"] for r in stats], np.nanvar(x, axis=0))
    filled = df.select("id", array_to_vector(F.transform("a", lambda c: F.coalesce(c, F.lit(float("nan"))))).alias("v"))
    model = R.fit_pca_path(filled, "v", 8)
    z = standardised(x)
    values, vectors = np.linalg.eigh(z.T @ z)
    assert np.allclose(model.explained_variance_ratio, values[::-1][:8] / values.sum(), atol=1e-6)
    assert np.allclose(np.abs(np.sum(model.components * vectors[:, ::-1][:, :8], axis=0)), 1, atol=1e-6)
    assert np.allclose(model.components.T @ model.components, np.eye(8), atol=1e-10)
    scores = {r["id"]: r["pca"] for r in model.transform(filled, "v", ["id"]).collect()}
    assert np.allclose([scores[i] for i in range(900)], z @ model.components, atol=1e-8)


def test_four_thousand_columns_fifty_components(spark):
    rng = np.random.default_rng(1)
    d, k = 4000, 50
    x = rng.normal(size=(400, 60)) * np.linspace(9, 1, 60) @ rng.normal(size=(60, d)) + rng.normal(size=(400, d))
    df = frame(spark, x).repartition(4).checkpoint(eager=True)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    began = time.time()
    comp, ratio, residuals = R.principal_components(df, mean, scale, k)
    assert time.time() - began < 120
    s = np.linalg.svd(standardised(x), compute_uv=False) ** 2
    assert np.allclose(ratio, s[:k] / s.sum(), atol=1e-8) and residuals.max() <= R.TOLERANCE
    assert np.allclose(comp.T @ comp, np.eye(k), atol=1e-9)


def test_components_of_odd_tables(spark):
    same = frame(spark, np.ones((5, 3)))
    comp, ratio, _ = R.principal_components(same, np.ones(3), np.ones(3), 2)
    assert comp.shape[0] == 3 and np.allclose(ratio, 0)
    gone = spark.createDataFrame([(1, [None, 2.0])], "id long, a array<double>")
    assert [tuple(r) for r in sorted(R.vector_moments(gone).collect())] == [(0, None, None), (1, 2.0, 0.0)]
