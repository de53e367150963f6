"""Invariants for the learners and the PCA path (no SQL oracle there)."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.operators import learn, metrics
from tabforge.operators.reduce import fit_pca_path
from tabforge.plans import fixtures as fx
from tabforge.plans import q_learn

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def emb(spark):
    train, val = q_learn.emb_splits(spark, SF_SMALL)
    return train.withColumn("w", learn.class_weight_col("y", 9.0)), val


def test_staged_equals_transform(spark, emb):
    train, _ = emb
    m = learn.fit_gbt(train, "y", weight="w", params={"n_estimators": 5, "max_depth": 2, "seed": 42})
    t = learn.leaf_table(spark, m)
    st = learn.staged_scores(train, m, t, ["vec_id", "y"]).filter(F.col("round") == t.n_trees - 1)
    ref = m.transform(train).select("vec_id", vector_to_array("probability")[1].alias("prob"))
    diff = st.join(ref, "vec_id").agg(F.max(F.abs(F.col("p") - F.col("prob")))).first()[0]
    assert diff < 1e-12
    fin = learn.final_scores(train, m, t, ["vec_id"], t.n_trees).join(ref, "vec_id")
    assert fin.agg(F.max(F.abs(F.col("p") - F.col("prob")))).first()[0] < 1e-12


def test_same_seed_same_model(spark, emb):
    train, _ = emb
    p = {"n_estimators": 3, "max_depth": 2, "subsample": 0.8, "seed": 7}
    a = learn.fit_gbt(train, "y", weight="w", params=p)
    b = learn.fit_gbt(train, "y", weight="w", params=p)
    assert a.featureImportances.toArray().tolist() == b.featureImportances.toArray().tolist()


def test_training_loss_not_increasing(spark, emb):
    train, _ = emb
    m = learn.fit_gbt(train, "y", params={"n_estimators": 6, "max_depth": 2, "seed": 42})
    t = learn.leaf_table(spark, m)
    h = learn.round_history(learn.staged_scores(train, m, t, ["vec_id", "y"]), "y", "train",
                            metric_names=("logloss",))
    vals = [r["value"] for r in h.orderBy("round").collect()]
    assert all(b <= a + 1e-9 for a, b in zip(vals, vals[1:]))


def test_class_weight_raises_mean_probability(spark, emb):
    train, _ = emb
    p = {"n_estimators": 3, "max_depth": 2, "seed": 42}
    lo = learn.fit_gbt(train.withColumn("w1", F.lit(1.0)), "y", weight="w1", params=p)
    hi = learn.fit_gbt(train, "y", weight="w", params=p)
    mean = lambda m: m.transform(train).select(F.avg(vector_to_array("probability")[1])).first()[0]
    assert mean(hi) > mean(lo)


def test_early_stopping_best_iteration(spark, emb):
    train, val = emb
    bm = learn.fit_with_early_stopping(train, val.withColumn("w", learn.class_weight_col("y", 9.0)),
                                       "y", "vec_id", weight="w",
                                       params={"n_estimators": 8, "max_depth": 2, "seed": 42}, patience=3)
    hist = {r["round"]: r["value"] for r in bm.history.filter("split = 'eval'").collect()}
    best = max(hist, key=lambda r: (hist[r], -r))
    assert bm.best_iteration <= best or hist[bm.best_iteration] == hist[best]
    scored = bm.predict_proba(val, ["vec_id", "y"])
    assert scored.count() == val.count()


def test_patience_ends_the_fit(spark, emb):
    train, val = emb
    bm = learn.fit_with_early_stopping(train, val, "y", "vec_id", weight="w", patience=2,
                                       params={"n_estimators": 64, "max_depth": 2, "subsample": 0.8, "seed": 42})
    assert bm.leaves.n_trees == bm.best_iteration + 3 < 64
    assert bm.history.count() == bm.leaves.n_trees
    # A longer fit begins with the shorter one's trees, so doubling changes no result.
    p = {"n_estimators": 12, "max_depth": 2, "subsample": 0.8, "seed": 42}
    longer = learn.leaf_table(spark, learn.fit_gbt(train, "y", weight="w", params=p))
    shorter = learn.leaf_table(spark, learn.fit_gbt(train, "y", weight="w", params=dict(p, n_estimators=4)))
    assert np.allclose(longer.values[:4, :shorter.values.shape[1]], shorter.values)


def test_query_budget_is_not_cut():
    from tabforge.plans.budgets import QUERIES
    assert QUERIES.rounds >= 20 and QUERIES.search_trials >= 3 and QUERIES.search_rounds > QUERIES.patience
    assert QUERIES.rounds > QUERIES.patience


def test_hist_and_sweep_take_the_budget(spark, monkeypatch):
    from tabforge.operators import hist, tune
    from tabforge.plans import q_hist
    from tabforge.plans.budgets import QUERIES
    seen = {}

    class Seen(Exception):
        pass

    def fit(*args, params=None, **kw):
        seen["hist"] = params
        raise Seen

    def sweep(train, val, label, key, weights, threshold, params, patience):
        seen["sweep"] = (len(weights), params["n_estimators"], params["max_depth"], patience)
        raise Seen

    monkeypatch.setattr(hist, "fit_hist", fit)
    monkeypatch.setattr(tune, "weight_sweep", sweep)
    for run in (q_hist.hist_fit, q_learn.weight_sweep):
        with pytest.raises(Seen):
            run(spark, SF_SMALL)
    p = seen["hist"]
    assert (p.n_rounds, p.max_depth, p.max_bins, p.patience) == (QUERIES.rounds, QUERIES.depth, QUERIES.max_bins, QUERIES.patience)
    assert seen["sweep"] == (4, QUERIES.rounds, QUERIES.depth, QUERIES.patience)


def test_pca_orthonormal_and_variance(spark, emb):
    train, val = emb
    m = fit_pca_path(train, "features", 5)
    c = m.components
    assert np.allclose(c.T @ c, np.eye(5), atol=1e-8)
    x = np.array([r["a"] for r in train.select(vector_to_array("features").alias("a")).collect()])
    z = (x - x.mean(0)) / x.std(0)
    ev = np.linalg.eigvalsh(np.cov(z, rowvar=False))[::-1]
    assert np.allclose(m.explained_variance_ratio, ev[:5] / ev.sum(), atol=1e-8)
    out = m.transform(val, "features", ["vec_id"])
    assert len(out.first()["pca"]) == 5
    v = m.variance_table(spark).orderBy("component").collect()
    assert v[-1]["cumulative_ratio"] == pytest.approx(sum(m.explained_variance_ratio))


def test_assemble_categorical_metadata(spark):
    df = spark.createDataFrame([(1.0, 0), (2.0, None), (3.0, 1)], "x double, c int")
    v = learn.assemble(df, ["x"], {"c": 2})
    meta = v.schema["features"].metadata["ml_attr"]
    assert meta["num_attrs"] == 2 and meta["attrs"]["nominal"][0]["vals"][-1] == "__missing__"
    arr = [r["a"] for r in v.select(vector_to_array("features").alias("a")).collect()]
    assert arr[1] == [2.0, 2.0]
