"""Queries: learners, search, PCA (LRN1-LRN11, TUN2-TUN4, FEA6-FEA8, WIN2).

These depend on a fitted model or a numeric solver, so they carry no SQL
oracle; tests check their invariants (staged = transform, determinism,
orthonormal components, ...).
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import hist, learn, metrics, sample, select, tune
from ..operators.history import history_table
from ..operators.profile import class_weight
from ..operators.reduce import covariance_times, fit_pca_path
from . import fixtures as fx
from .budgets import QUERIES as BUDGET
from .registry import query, r6

ROUNDS, PATIENCE, DEPTH = BUDGET.rounds, BUDGET.patience, BUDGET.depth


def emb_splits(spark, sf_dir):
    e = fx.emb_binary(spark, sf_dir)
    return sample.split_exact(e, "vec_id", 0.8, 42)


def _spw(train) -> float:
    r = class_weight(train, "y").first()
    return float(r["scale_pos_weight"] or 1.0)


def _weighted(df, spw):
    return df.withColumn("w", learn.class_weight_col("y", spw))


def fitted(spark, sf_dir, params=None):
    train, val = emb_splits(spark, sf_dir)
    spw = _spw(train)
    p = {"n_estimators": ROUNDS, "max_depth": DEPTH, "learning_rate": 0.1, "subsample": 0.8, "seed": 42}
    p.update(params or {})
    bm = learn.fit_with_early_stopping(_weighted(train, spw), _weighted(val, spw), "y", "vec_id",
                                       weight="w", params=p, patience=PATIENCE, metric="aucpr")
    return bm, train, val


@query("gbt_importance")
def gbt_importance(spark, sf_dir):
    """LRN6 + LRN7 + FEA13: quick weighted fit, importances, cumulative cut."""
    train, _ = emb_splits(spark, sf_dir)
    spw = _spw(train)
    m = learn.fit_gbt(_weighted(train, spw), "y", weight="w",
                      params={"n_estimators": BUDGET.importance_rounds, "max_depth": DEPTH, "seed": 42})
    names = [f"f{i}" for i in range(m.numFeatures)]
    imp = select.importance_table(spark, names, m.featureImportances)
    sel = select.cumulative_selection(imp, 0.95, min_features=10, max_features=2000)
    return sel.select("feature", r6("importance").alias("importance"), "rank",
                      r6("cumulative_ratio").alias("cumulative_ratio"), "selected")


@query("gbt_history")
def gbt_history(spark, sf_dir):
    """LRN8 + RPT1: per-round eval PR-AUC and log loss, pivoted."""
    bm, train, val = fitted(spark, sf_dir)
    long = learn.round_metrics(_weighted(val, _spw(train)), bm.model, bm.leaves, "y", "eval", "w")
    return history_table(long, [("eval", "aucpr"), ("eval", "logloss")])


@query("gbt_score")
def gbt_score(spark, sf_dir):
    """LRN9-LRN11 + PRJ10-PRJ12: val scored with the best iteration,
    threshold 0.1."""
    bm, _, val = fitted(spark, sf_dir)
    p = bm.predict_proba(val, ["vec_id", "y"])
    return p.select("vec_id", "y", r6("p").alias("p"), metrics.threshold("p", 0.1).alias("pred"),
                    F.lit(bm.best_iteration).alias("best_iteration"))


def _emb_columns(df):
    """The embedding as one column per dimension."""
    width = fx.EMB_DIMS
    cell = vector_to_array("features")
    return df.select("vec_id", "y", *[cell[i].alias(f"f{i}") for i in range(width)])


@query("search_trials")
def search_trials(spark, sf_dir):
    """TUN2-TUN4: Parzen-estimator search with successive halving over all seven parameters on a stratified
    50% of train; objective = best val PR-AUC."""
    train, val = emb_splits(spark, sf_dir)
    spw = _spw(train)
    half = sample.stratified_fraction(train, "y", "vec_id", 0.5, 42)
    cols = [f"f{i}" for i in range(fx.EMB_DIMS)]
    table = hist.TrainingTable.of(_emb_columns(half), cols, "y", "vec_id", val=_emb_columns(val), max_bins=BUDGET.max_bins)
    trials = tune.search_boosters(table, tune.XGB_SPACE, BUDGET.search_trials, seed=42, n_rounds=BUDGET.search_rounds,
                                  patience=PATIENCE, scale_pos_weight=spw, max_bins=BUDGET.max_bins)
    table.forget()
    return trials.select("trial", F.to_json("params").alias("params"), r6("objective").alias("objective"), "rounds", "pruned")


@query("weight_sweep")
def weight_sweep(spark, sf_dir):
    """TUN1: class weights 1, ratio/2, ratio and twice the ratio, one fit each, metrics at 0.5 with both
    areas; the refit takes the best F1."""
    train, val = emb_splits(spark, sf_dir)
    spw = _spw(train)
    table, best, _ = tune.weight_sweep(train, val, "y", "vec_id", [1.0, spw / 2, spw, 2 * spw], 0.5,
                                       {"n_estimators": ROUNDS, "max_depth": DEPTH, "seed": 42}, patience=PATIENCE)
    return table.select(*[r6(c).alias(c) for c in table.columns], (F.col("weight") == F.lit(best)).alias("chosen"))


@query("embedding_moments", sql="""
SELECT CAST(i AS INTEGER) AS i, round(avg(x), 6) AS mean, round(var_pop(x), 6) AS variance
FROM (SELECT unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
GROUP BY i
""")
def embedding_moments(spark, sf_dir):
    """FEA6 input: the moments that standardise the vectors."""
    from ..operators.reduce import vector_moments
    m = vector_moments(fx.emb_binary(spark, sf_dir).select(vector_to_array("features").alias("a")))
    return m.select("i", r6("m").alias("mean"), r6("v").alias("variance"))


@query("pca_variance")
def pca_variance(spark, sf_dir):
    """FEA6 + FEA8 + WIN2: explained-variance ratios of 8 components."""
    train, _ = emb_splits(spark, sf_dir)
    m = fit_pca_path(train, "features", 8)
    v = m.variance_table(spark)
    return v.select("component", r6("ratio").alias("ratio"), r6("cumulative_ratio").alias("cumulative_ratio"))


@query("pca_quality")
def pca_quality(spark, sf_dir):
    """FEA6: each component's length, its greatest product with another one, and its residual as a share of the greatest
    eigenvalue, against the covariance of all train rows."""
    import numpy as np

    train, _ = emb_splits(spark, sf_dir)
    model = fit_pca_path(train, "features", 8)
    arrays = train.select(vector_to_array("features").alias("a"))
    c = model.components
    product, trace, _ = covariance_times(arrays, model.mean, model.scale, c)
    values = model.explained_variance_ratio
    residual = np.linalg.norm(product / trace - c * values, axis=0) / values[0]
    dots = np.abs(c.T @ c - np.diag(np.sum(c * c, axis=0))).max(axis=0)
    rows = [(i, *map(float, r)) for i, r in enumerate(zip(np.linalg.norm(c, axis=0), dots, residual))]
    found = spark.createDataFrame(rows, "component int, length double, dot double, residual double")
    return found.select("component", *[r6(x).alias(x) for x in ("length", "dot", "residual")])


@query("pca_scores")
def pca_scores(spark, sf_dir):
    """FEA4-FEA7: val projected on the train components (key kept)."""
    train, val = emb_splits(spark, sf_dir)
    m = fit_pca_path(train, "features", 8)
    return m.transform(val, "features", ["vec_id", "y"])


# SCO1: the full train/select/tune/evaluate/submit job on the order features.
def order_job(spark, sf_dir, search_trials=BUDGET.search_trials, rounds=BUDGET.rounds):
    from ..operators.prep import MissingPlan
    from .jobs import TrainConfig, train_select_tune
    from ..session import ensure_checkpoint_dir
    ensure_checkpoint_dir(spark)
    # The derived feature table is read by both splits and every fit pass:
    # write it once to the checkpoint folder and cut its lineage there.
    of = fx.order_features(spark, sf_dir).checkpoint(eager=True)
    labelled, test = sample.split_exact(of, "id", 0.8, 42)
    train, val = sample.split_exact(labelled, "id", 0.8, 42)
    cfg = TrainConfig(
        label="label", key="id",
        plan=MissingPlan(exclude=["id", "label"], zero_contains=["discount"], sentinel_cols=["max_tax"],
                         categorical_cols=["status", "priority"]),
        categorical=["status", "priority"], threshold=0.1, select_cut=0.99, min_features=3,
        importance_params={"n_estimators": BUDGET.importance_rounds, "max_depth": BUDGET.importance_depth},
        search_trials=search_trials,
        search_space=dict(tune.XGB_SPACE), backend="hist",
        params={"n_estimators": rounds, "max_depth": 4, "learning_rate": 0.1, "subsample": 0.8},
        patience=PATIENCE)
    return train_select_tune(spark, cfg, train, val, test.drop("label"))


@query("order_submission")
def order_submission(spark, sf_dir):
    """SCO1 + PRJ10-PRJ11: (id, label) for the unlabelled test split."""
    return order_job(spark, sf_dir)["submission"]
