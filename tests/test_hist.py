"""Histogram booster (LRN2): learned missing direction, leaf values, and
that the packed-array scorer equals a plain Python walk of the trees."""

import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import hist


@pytest.fixture(scope="module")
def gap_table(spark):
    # x missing <=> positive label; z is noise. A learner that routes
    # missing values must send them to the positive side.
    rows = []
    for i in range(400):
        y = 1 if i % 4 == 0 else 0
        x = None if y == 1 else float(i % 17)
        z = float((i * 7) % 13)
        rows.append((i, x, z, y))
    return spark.createDataFrame(rows, "id long, x double, z double, y int")


def _walk_py(model, x_bins, n_trees):
    m = model.base_margin
    for tr in model.trees[:n_trees]:
        node = 0
        while node in tr.splits:
            f, b, ml, _ = tr.splits[node]
            v = x_bins[f]
            left = ml if v < 0 else v <= b
            node = 2 * node + 1 if left else 2 * node + 2
        m += tr.leaves[node]
    return m


def test_missing_direction_learned(spark, gap_table):
    p = hist.HistParams(n_rounds=2, max_depth=2, eta=0.5, max_bins=8, min_child_weight=0.1)
    model = hist.fit_hist(gap_table, ["x", "z"], "y", "id", params=p)
    root = model.trees[0].splits[0]
    assert root[0] == 0                       # splits on x
    # missing rows are the positives: their first-tree leaf value is positive
    for zb in range(len(model.cuts["z"]) + 1):
        assert _walk_py(model, [-1, zb], 1) - model.base_margin > 0
    pr = model.predict_proba(gap_table, ["id", "y"], use_best=False)
    stats = pr.groupBy("y").agg(F.min("p").alias("lo"), F.max("p").alias("hi")).collect()
    by = {r["y"]: r for r in stats}
    assert by[1]["lo"] > by[0]["hi"]          # perfectly separated by the gap


def test_packed_scorer_equals_python_walk(spark, gap_table):
    p = hist.HistParams(n_rounds=3, max_depth=3, eta=0.3, max_bins=8, subsample=0.8, seed=7)
    model = hist.fit_hist(gap_table, ["x", "z"], "y", "id", params=p)
    binned = hist.apply_bins(gap_table, model.cols, model.cuts, ["id"]).collect()
    pr = {r["id"]: r["p"] for r in model.predict_proba(gap_table, ["id"], use_best=False).collect()}
    for r in binned:
        m = _walk_py(model, r["bins"], len(model.trees))
        assert abs(pr[r["id"]] - 1.0 / (1.0 + math.exp(-m))) < 1e-12


def test_leaf_value_formula(spark):
    # one round, depth 1, no regularisation beyond lambda: leaf = -eta * G / (H + lambda)
    rows = [(i, float(i % 2), i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, x double, y int")
    p = hist.HistParams(n_rounds=1, max_depth=1, eta=1.0, reg_lambda=1.0, max_bins=4)
    model = hist.fit_hist(df, ["x"], "y", "id", params=p)
    tr = model.trees[0]
    assert set(tr.leaves) == {1, 2}
    # each child: 20 rows with p = 0.5; G = 20 * (0.5 - y), H = 20 * 0.25
    assert tr.leaves[1] == pytest.approx(-(20 * 0.5) / (5 + 1))
    assert tr.leaves[2] == pytest.approx(-(20 * -0.5) / (5 + 1))
