"""Boosted trees on MLlib (backend A): LRN1, LRN3-LRN11, SCO1 helpers.

* ``GBTClassifier`` does the distributed fit (histogram bins, tree
  aggregation); the positive-class weight is a weight column (LRN3).
* Staged scoring (LRN8/LRN11): one ``transform`` with ``leafCol`` gives
  every row's leaf in every tree; the fitted leaf values (trees x leaves,
  bounded by ``maxIter * 2**maxDepth``) are broadcast once. Per-round metrics come from one
  score sketch per round and task (``round_metrics``). ``staged_scores`` gives the scores themselves,
  one row per row and round.
* Early stopping (LRN9/LRN10) fits some rounds, finds the best round on the
  validation history (WIN5), fits twice as many while patience has not ended
  the fit, and scores with the first ``best_round + 1`` trees.

MLlib's margin scale: ``p = 1 / (1 + exp(-2 m))``.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, scratch_dir
from . import metrics, score_sketch
from .blocks import MERGE, added
from .history import early_stopping
from .wquantile import cell_slices

MAX_LEAF_TABLE = 4_000_000  # trees x leaves held in the broadcast matrix; checked before the fit
FIRST_ROUNDS = 32  # rounds of the first fit under a larger round budget


def class_weight_col(label: str, scale_pos_weight: float) -> F.Column:
    """LRN3: weight = ``scale_pos_weight`` for positives, 1 otherwise."""
    return F.when(F.col(label) == 1, F.lit(float(scale_pos_weight))).otherwise(F.lit(1.0))


def assemble(df: DataFrame, numeric: list[str], categorical: dict[str, int] | None = None,
             out: str = "features") -> DataFrame:
    """Feature vector with ML attribute metadata. ``categorical`` maps a code
    column (0..k-1, NULL for missing/unseen) to its cardinality k; such
    columns become nominal attributes with one extra "missing" category, so
    the trees split on category sets (LRN4). Numeric NULL/NaN pass through
    as NaN (``handleInvalid='keep'``)."""
    categorical = dict(categorical or {})
    cat_cols = list(categorical)
    prepared = df
    for c, k in categorical.items():
        prepared = prepared.withColumn(f"__cat_{c}", F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(float(k))))
    inputs = list(numeric) + [f"__cat_{c}" for c in cat_cols]
    va = VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep")
    v = va.transform(prepared)
    attrs = {"numeric": [{"idx": i, "name": n} for i, n in enumerate(numeric)]} if numeric else {}
    if cat_cols:
        attrs["nominal"] = [{"idx": len(numeric) + j, "name": c,
                             "vals": [str(i) for i in range(categorical[c])] + ["__missing__"]}
                            for j, c in enumerate(cat_cols)]
    meta = {"ml_attr": {"attrs": attrs, "num_attrs": len(inputs)}}
    return v.withMetadata(out, meta).drop(*[f"__cat_{c}" for c in cat_cols])


# Reference-style parameter names -> MLlib GBT parameters.
def gbt_params(params: dict) -> dict:
    """Map learner parameters to ``GBTClassifier``. What MLlib cannot do (L1/L2
    regularisation, the ``gamma`` split penalty) stops with an error instead of
    being dropped: use the histogram booster for it. Column subsampling is per
    node, not per tree."""
    refused = [k for k in ("reg_alpha", "reg_lambda", "gamma") if float(params.get(k) or 0.0) != 0.0]
    if refused:
        raise ValueError(f"MLlib trees have no {', '.join(refused)}; fit the histogram booster")
    p = {}
    if "n_estimators" in params:
        p["maxIter"] = int(params["n_estimators"])
    if "max_depth" in params:
        p["maxDepth"] = int(params["max_depth"])
    if "learning_rate" in params:
        p["stepSize"] = float(params["learning_rate"])
    if "subsample" in params:
        p["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        p["featureSubsetStrategy"] = repr(float(params["colsample_bytree"]))
    if "max_bins" in params:
        p["maxBins"] = int(params["max_bins"])
    if "seed" in params or "random_state" in params:
        p["seed"] = int(params.get("seed", params.get("random_state")))
    return p


def fit_gbt(train: DataFrame, label: str, features: str = "features", weight: str | None = None,
            params: dict | None = None, checkpoint_interval: int = 10) -> GBTClassificationModel:
    """LRN1/LRN5/LRN6: distributed boosted-tree fit (logistic loss)."""
    kw = dict(seed=42, maxIter=20, maxDepth=5)
    kw.update(gbt_params(params or {}))
    if kw["maxIter"] * 2 ** kw["maxDepth"] > MAX_LEAF_TABLE:
        raise ValueError(f"{kw['maxIter']} rounds of depth {kw['maxDepth']} pass {MAX_LEAF_TABLE} leaves")
    # Category-set splits need a bin per category.
    nominal = train.schema[features].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    kw["maxBins"] = max([kw.get("maxBins", 32), *(len(a["vals"]) for a in nominal)])
    gbt = GBTClassifier(featuresCol=features, labelCol=label, lossType="logistic",
                        checkpointInterval=checkpoint_interval, cacheNodeIds=True, **kw)
    if weight:
        gbt = gbt.setWeightCol(weight)
    # Boosting scans its input once per round: pin the (already prepared)
    # input for the fit, release it after.
    data = train.withColumn(label, F.col(label).cast("double")).persist()
    try:
        return gbt.fit(data)
    finally:
        data.unpersist()


@dataclass
class LeafTable:
    """Fitted leaf values per tree, scaled by the tree weights."""
    values: np.ndarray  # shape (n_trees, max_leaves)

    @property
    def n_trees(self) -> int:
        return int(self.values.shape[0])


def leaf_table(spark: SparkSession, model: GBTClassificationModel, path: str | None = None) -> LeafTable:
    """Persist the model (SNK6) and read its node table: leaves in preorder
    are the ``leafCol`` indices."""
    scratch = path is None
    if scratch:
        path = scratch_dir(spark, f"gbt-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(os.path.join(path, "data"))
    leaves = (nodes.filter(F.col("nodeData.leftChild") < 0)
              .select("treeID", F.col("nodeData.id").alias("id"), F.col("nodeData.prediction").alias("pred")))
    rows = leaves.collect()  # bounded: trees x 2**maxDepth, checked before the fit
    if scratch:
        delete_folder(spark, path)
    weights = list(model.treeWeights)
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["treeID"], []).append((r["id"], r["pred"]))
    width = max(len(v) for v in by_tree.values())
    mat = np.zeros((len(weights), width))
    for t, lst in by_tree.items():
        for j, (_, pred) in enumerate(sorted(lst)):
            mat[t, j] = pred * weights[t]
    return LeafTable(mat)


def staged_scores(df: DataFrame, model: GBTClassificationModel, table: LeafTable,
                  keep: list[str], features: str = "features", n_trees: int | None = None) -> DataFrame:
    """LRN8/LRN11: ``(keep..., round, margin, p)`` for rounds ``0..n_trees-1``."""
    spark = df.sparkSession
    n = table.n_trees if n_trees is None else min(n_trees, table.n_trees)
    bc = spark.sparkContext.broadcast(table.values[:n])

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def cum_margins(leaves: pd.Series) -> pd.Series:
        vals = bc.value
        idx = np.stack(leaves.to_numpy()).astype(np.int64)[:, : vals.shape[0]]
        contrib = vals[np.arange(vals.shape[0])[None, :], idx]
        return pd.Series(list(np.cumsum(contrib, axis=1)))

    m = model.copy()
    m.setLeafCol("_leaf")
    scored = m.transform(df.select(*keep, features)).select(*keep, vector_to_array("_leaf").alias("_leaf"))
    staged = scored.select(*keep, F.posexplode(cum_margins("_leaf")).alias("round", "margin"))
    return staged.withColumn("p", F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * F.col("margin"))))


def final_scores(df: DataFrame, model: GBTClassificationModel, table: LeafTable, keep: list[str],
                 n_trees: int, features: str = "features") -> DataFrame:
    """LRN11 with the best iteration: ``(keep..., p)`` from the first
    ``n_trees`` trees (one margin per row, no explode)."""
    vals = table.values[:n_trees]
    # Leaf values as one folded array literal (bounded by MAX_LEAF_TABLE);
    # the margin is a JVM-side sum over trees, no Python worker involved.
    lit = F.from_json(F.lit(json.dumps(vals.tolist())), "array<array<double>>")
    m = model.copy()
    m.setLeafCol("_leaf")
    scored = m.transform(df.select(*keep, features)).select(*keep, vector_to_array("_leaf").alias("_leaf"))
    leaf = F.col("_leaf")
    margin = F.aggregate(
        F.sequence(F.lit(1), F.lit(int(vals.shape[0]))), F.lit(0.0),
        lambda acc, t: acc + F.element_at(F.element_at(lit, t), F.element_at(leaf, t).cast("int") + 1))
    return scored.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * margin))).alias("p"))


def round_history(staged: DataFrame, label: str, split: str, weight: str | None = None,
                  metric_names: tuple[str, ...] = ("logloss", "aucpr")) -> DataFrame:
    """LRN8 + MET9/MET10: long history ``(round, split, metric, value)``."""
    parts = []
    if "logloss" in metric_names:
        ll = metrics.log_loss(staged, label, "p", by=["round"], weight=weight)
        parts.append(ll.select("round", F.lit(split).alias("split"), F.lit("logloss").alias("metric"),
                               F.col("log_loss").alias("value")))
    if "aucpr" in metric_names:
        pa = metrics.pr_auc(staged, label, "p", by=["round"])
        parts.append(pa.select("round", F.lit(split).alias("split"), F.lit("aucpr").alias("metric"),
                               F.col("pr_auc").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def round_metrics(df: DataFrame, model: GBTClassificationModel, table: LeafTable, label: str, split: str,
                  weight: str | None = None, features: str = "features") -> DataFrame:
    """LRN8 + MET9/MET10 for every round at once: ``(round, split, metric, value)`` with logloss, aucpr and auc.

    Each task adds its rows' margins of all rounds to one score sketch per round; the shuffle holds
    tasks x rounds sketches, not rows x rounds. The areas are those of the sketch."""
    spark = df.sparkSession
    values = table.values
    n = len(values)
    # The range of the margins of each round, from the leaf values.
    low, high = np.cumsum(values.min(axis=1)), np.cumsum(values.max(axis=1))
    held = spark.sparkContext.broadcast(values)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vals = held.value
        total = np.zeros((n, score_sketch.SIZE))
        for batch in batches:
            y, w = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w"))
            for rows, leaves in cell_slices(batch, "x", n):
                margin = np.zeros(len(leaves))
                for t in range(n):
                    margin += vals[t, leaves[:, t].astype(np.int64)]
                    total[t] += score_sketch.sketch(margin, y[rows], w[rows], low[t], high[t], 2.0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(n), pa.int32()), pa.array([t.tobytes() for t in total], pa.binary())], ["round", "sums"])

    def partial(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"round": group["round"].iloc[:1], "sums": [added(group["sums"]).tobytes()]})

    def finish(group: pd.DataFrame) -> pd.DataFrame:
        total = added(group["sums"])
        pr, roc = score_sketch.areas(total)
        found = {"logloss": score_sketch.log_loss(total), "aucpr": pr, "auc": roc}
        return pd.DataFrame({"round": int(group["round"].iloc[0]), "split": split, "metric": list(found), "value": list(found.values())})

    m = model.copy()
    m.setLeafCol("_leaf")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    rows = df.filter(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("y"), w.alias("w"), features)
    leaves = m.transform(rows).select("y", "w", F.slice(vector_to_array("_leaf"), 1, n).alias("x"))
    sums = leaves.mapInArrow(scan, "round int, sums binary").withColumn("g", F.floor(F.spark_partition_id() / MERGE))
    once = sums.groupBy("round", "g").applyInPandas(partial, "round int, sums binary")
    return once.groupBy("round").applyInPandas(finish, "round int, split string, metric string, value double")


@dataclass
class BoostedModel:
    """A fitted booster plus its best iteration (trees used for scoring)."""
    model: GBTClassificationModel
    leaves: LeafTable
    best_iteration: int
    history: DataFrame | None = None
    feature_names: list | None = None

    @property
    def n_trees_used(self) -> int:
        return self.best_iteration + 1

    def predict_proba(self, df: DataFrame, keep: list[str], features: str = "features") -> DataFrame:
        return final_scores(df, self.model, self.leaves, keep, self.n_trees_used, features)

    def importances(self) -> list[float]:
        return self.model.featureImportances.toArray().tolist()

    def summary(self) -> dict:
        return {"best_iteration": self.best_iteration, "n_trees": self.leaves.n_trees,
                "params": json.dumps({k.name: v for k, v in self.model.extractParamMap().items()},
                                     default=str)}


def fit_with_early_stopping(train: DataFrame, val: DataFrame, label: str, key: str,
                            features: str = "features", weight: str | None = None,
                            params: dict | None = None, patience: int = 50,
                            metric: str = "aucpr", with_train_history: bool = False) -> BoostedModel:
    """LRN1 + LRN8 + LRN9 + LRN10: evaluate every round on ``val`` (the last eval
    set), stop at ``patience``. A longer MLlib fit with the same seed begins with
    the trees of a shorter one, so the fit starts with a few patiences of rounds
    and doubles until patience ends it or the round budget is used; rounds past
    the stop are dropped from the leaf table and the history."""
    spark = train.sparkSession
    params = dict(params or {})
    budget = int(params.get("n_estimators", 20))
    rounds = min(budget, max(FIRST_ROUNDS, 2 * patience))
    while True:
        model = fit_gbt(train, label, features, weight, dict(params, n_estimators=rounds))
        table = leaf_table(spark, model)
        hist = round_metrics(val, model, table, label, "eval", weight if weight in val.columns else None, features)
        hist = hist.filter(F.col("metric") == metric)
        hist = hist.checkpoint(eager=True)  # small: rounds x splits x metrics
        es = early_stopping(hist, patience, maximize=(metric != "logloss")).first()
        if rounds >= budget or int(es["stop_round"]) - int(es["best_round"]) >= patience:
            break
        rounds = min(budget, 2 * rounds)
    used = int(es["stop_round"]) + 1
    table = LeafTable(table.values[:used])
    if with_train_history:
        ours = round_metrics(train, model, table, label, "train", weight, features).filter(F.col("metric") == metric)
        hist = hist.unionByName(ours).checkpoint(eager=True)
    return BoostedModel(model=model, leaves=table, best_iteration=int(es["best_round"]),
                        history=hist.filter(F.col("round") < used))
