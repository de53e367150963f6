"""End-to-end jobs: ingest (ING1) and train/select/tune/evaluate/submit
(the reference's full training script, SCO1, RPT1-RPT3).

Everything data-sized runs as Spark jobs; the driver holds only fit
statistics (one value per column), trees, importances and per-trial scores.
"""

from __future__ import annotations

import os
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import columns as C
from ..operators import hist, learn, metrics, profile, sample, select, tune
from ..operators.encode import CategoryEncoder
from ..operators.prep import MissingPlan
from ..sources import sinks
from ..session import ensure_checkpoint_dir
from . import stages
from .budgets import REFERENCE
from ..sources.tables import REJECT, normalize_nan, read_csv, split_rejects


def ingest_csv(spark: SparkSession, labelled_csv: str, out_dir: str, label: str, key: str,
               frac: float = 0.8, seed: int = 42, test_csv: str | None = None) -> tuple[DataFrame, DataFrame]:
    """ING1: CSV -> train/val (exact hash split) [+ test] Parquet. Lines that do
    not fit the schema go to ``rejects`` (EXP2). Returns the label distribution
    of the input (AGG1) and the counts ``(table, n_read, n_rejected)`` (AGG11)."""
    counts: list = []
    for name, path in (("labelled", labelled_csv), ("test", test_csv)):
        if path is None:
            continue
        # Written as read, so that the CSV is parsed once; the write itself counts.
        raw = os.path.join(out_dir, f"{name}.parquet")
        rejected = F.col(REJECT).isNotNull()
        seen = Observation()
        read = read_csv(spark, path, corrupt_col=REJECT, quoted_breaks=True)
        sinks.write_parquet(read.observe(seen, F.count_if(~rejected).alias("n_read"), F.count_if(rejected).alias("n_rejected")), raw)
        counts.append((name, seen.get["n_read"], seen.get["n_rejected"]))
        good, bad = split_rejects(spark.read.parquet(raw))
        sinks.write_parquet(bad, os.path.join(out_dir, "rejects", f"{name}.parquet"))
        if name == "test":
            sinks.write_parquet(good, os.path.join(out_dir, "test_clean.parquet"))
        else:
            full = good
            for split, part in zip(("train", "val"), sample.split_exact(good, key, frac, seed), strict=True):
                sinks.write_parquet(part, os.path.join(out_dir, f"{split}.parquet"))
    return profile.label_distribution(full, label), spark.createDataFrame(counts, "table string, n_read long, n_rejected long")


@dataclass
class TrainConfig:
    label: str
    key: str
    plan: MissingPlan | None = None        # None: train on the gaps (FEA12, "hist" backend)
    backend: str = "mllib"                 # "mllib" or "hist" (all regularisation, gaps, category sets)
    categorical: list = field(default_factory=list)
    lookup: str = "join"                   # category lookup; "index" only for at most encode.INDEX_VALUES values
    threshold: float = 0.1                 # PRJ10 decision threshold
    select_cut: float | None = 0.99        # FEA13 cumulative cut (None: all features)
    min_features: int = 50
    max_features: int = 2000
    importance_params: dict = field(default_factory=lambda: {"n_estimators": REFERENCE.importance_rounds,
                                                              "max_depth": REFERENCE.importance_depth})
    search_trials: int = 0                 # TUN3 budget (0: fixed params; budgets.REFERENCE.search_trials to search)
    search_fraction: float = 0.5           # TUN4 stratified subsample
    search_space: dict = field(default_factory=lambda: dict(tune.GBT_SPACE))
    params: dict = field(default_factory=lambda: {"n_estimators": REFERENCE.rounds, "max_depth": REFERENCE.depth,
                                                   "learning_rate": 0.05,
                                                   "subsample": 0.8, "colsample_bytree": 0.8})
    patience: int = REFERENCE.patience
    seed: int = 42


def _prepare(cfg: TrainConfig, train: DataFrame, others: dict):
    plan = cfg.plan.fit(train) if cfg.plan else None
    given = {k: v for k, v in {"train": train, **others}.items() if v is not None}
    prep = {k: plan.transform(v) for k, v in given.items()} if plan else given
    cats = C.present(prep["train"], cfg.categorical)
    enc = CategoryEncoder(cats, cfg.lookup).fit(prep["train"]) if cats else None
    if enc is not None:
        prep = {k: enc.transform(v) for k, v in prep.items()}
        card = {r["feature"]: r["k"] for r in enc.dictionary.groupBy("feature")
                .agg(F.max("code").alias("m")).select("feature", (F.col("m") + 1).alias("k")).collect()}
    else:
        card = {}
    numeric = [c for c in prep["train"].columns
               if c not in set(cats) | {cfg.label, cfg.key} and c in set(C.numeric_cols(prep["train"]))]
    return plan, enc, prep, numeric, {c: card.get(c, 1) for c in cats}


class _Gbt:
    """MLlib trees behind the job's calls."""

    def __init__(self, cfg: TrainConfig, numeric: list, cards: dict):
        self.cfg, self.numeric, self.cards = cfg, numeric, cards

    def ready(self, df: DataFrame) -> DataFrame:
        return learn.assemble(df, self.numeric, self.cards)

    def importances(self, train: DataFrame, params: dict):
        return learn.fit_gbt(self.ready(train), self.cfg.label, weight="_w", params=params).featureImportances

    def fit(self, train: DataFrame, val: DataFrame, params: dict):
        return learn.fit_with_early_stopping(self.ready(train), self.ready(val), self.cfg.label, self.cfg.key,
                                             weight="_w", params=params, patience=self.cfg.patience)

    def score(self, model, df: DataFrame, keep: list) -> DataFrame:
        return model.predict_proba(self.ready(df), keep)

    def search(self, spark: SparkSession, half: DataFrame, val: DataFrame) -> DataFrame:
        """One trial after another: each fit spreads over the cluster by itself."""
        cfg = self.cfg

        def evaluate(drawn: list[dict]) -> list[tuple[float, int, bool]]:
            model = self.fit(half, val, dict(drawn[0], n_estimators=cfg.params.get("n_estimators", REFERENCE.search_rounds),
                                             seed=cfg.seed))
            scored = self.score(model, val, [cfg.key, cfg.label]).checkpoint(eager=True)
            return [(metrics.pr_auc(scored, cfg.label, "p").first()["pr_auc"] or 0.0, model.leaves.n_trees, False)]

        return tune.search(spark, cfg.search_space, cfg.search_trials, evaluate, cfg.seed, batch=1)

    def save(self, spark, model, path: str) -> None:
        sinks.save_model(model.model, path)

    def stage(self, model):
        return stages.TreesModelStage(model, self.numeric, self.cards)


class _Hist:
    """The histogram booster behind the job's calls: L1/L2, gamma, gaps, category sets, and a
    fit that ends when patience does."""

    def __init__(self, cfg: TrainConfig, numeric: list, cards: dict):
        self.cfg, self.cols, self.cards = cfg, [*numeric, *cards], cards

    def _params(self, params: dict) -> hist.HistParams:
        return hist.HistParams.of(params, patience=self.cfg.patience)

    def importances(self, train: DataFrame, params: dict):
        model = hist.fit_hist(train, self.cols, self.cfg.label, self.cfg.key, "_w", self._params(params),
                              categorical=list(self.cards))
        found = model.importances()
        return [found[c] for c in self.cols]

    def fit(self, train: DataFrame, val: DataFrame, params: dict):
        model = hist.fit_hist(train, self.cols, self.cfg.label, self.cfg.key, "_w", self._params(params), val,
                              list(self.cards))
        return model

    def score(self, model, df: DataFrame, keep: list) -> DataFrame:
        return model.predict_proba(df, keep)

    def search(self, spark: SparkSession, half: DataFrame, val: DataFrame) -> DataFrame:
        """All trials of a batch in step over one table, pruned at rungs."""
        cfg = self.cfg
        table = hist.TrainingTable.of(half, self.cols, cfg.label, cfg.key, "_w", val, list(self.cards))
        fixed = {hist.HistParams.NAMES.get(k, k): v for k, v in cfg.params.items() if k not in cfg.search_space}
        try:
            return tune.search_boosters(table, cfg.search_space, cfg.search_trials, cfg.seed,
                                        **{"patience": cfg.patience, **fixed})
        finally:
            table.forget()

    def save(self, spark, model, path: str) -> None:
        model.save(spark, path)

    def stage(self, model):
        return stages.BoosterModelStage(model)


BACKENDS = {"mllib": _Gbt, "hist": _Hist}


def train_select_tune(spark: SparkSession, cfg: TrainConfig, train: DataFrame, val: DataFrame,
                      test: DataFrame | None = None, out_dir: str | None = None) -> dict:
    """The full job. Returns a dict of result tables and the summary row."""
    t0 = time.time()
    ensure_checkpoint_dir(spark)
    C.check_same_columns(train, val, "train and val")
    train, val = normalize_nan(train), normalize_nan(val)
    plan, enc, prep, numeric, cards = _prepare(cfg, train, {"val": val, "test": test})
    spw = float(profile.class_weight(prep["train"], cfg.label).first()["scale_pos_weight"] or 1.0)
    w = learn.class_weight_col(cfg.label, spw)
    # Prepared splits are read by every fit, trial and scoring pass: write
    # them once to the checkpoint folder and cut the lineage there.
    prep = {k: (v.withColumn("_w", w) if cfg.label in v.columns else v).checkpoint(eager=True)
            for k, v in prep.items()}
    timings = {"prepare": time.time() - t0}

    # importance fit + selection (LRN6, LRN7, FEA13, FEA14)
    feats_all = numeric + list(cards)
    backend = BACKENDS[cfg.backend]
    quick = backend(cfg, numeric, cards).importances(prep["train"], dict(cfg.importance_params, seed=cfg.seed))
    imp = select.importance_table(spark, feats_all, quick)
    if cfg.select_cut is not None:
        sel = select.cumulative_selection(imp, cfg.select_cut, cfg.min_features, cfg.max_features)
        chosen = select.selected_names(sel)
    else:
        sel, chosen = None, feats_all
    sel_num = C.intersect_names(chosen, numeric)
    sel_cat = {c: k for c, k in cards.items() if c in chosen}

    learner = backend(cfg, sel_num, sel_cat)
    timings["importance_select"] = time.time() - t0 - sum(timings.values())

    # search on a stratified fraction (TUN2-TUN4)
    trials = None
    params = dict(cfg.params, seed=cfg.seed)
    if cfg.search_trials > 0:
        half = sample.stratified_fraction(prep["train"], cfg.label, cfg.key, cfg.search_fraction, cfg.seed)

        trials = learner.search(spark, half, prep["val"])
        best = tune.best_trial(trials, "objective").first()
        params.update({k: (int(v) if k == "max_depth" else v) for k, v in best["params"].items()})
    timings["search"] = time.time() - t0 - sum(timings.values())

    # final fit with early stopping on val (LRN1, LRN8-LRN10)
    bm = learner.fit(prep["train"], prep["val"], params)
    # Scored once; every metric below reads the written table.
    scored = learner.score(bm, prep["val"], [cfg.key, cfg.label]).withColumn(
        "pred", metrics.threshold("p", cfg.threshold)).checkpoint(eager=True)
    timings["final_fit"] = time.time() - t0 - sum(timings.values())
    m = metrics.binary_metrics(scored, cfg.label, "pred").first()
    areas = metrics.curve_metrics(scored, cfg.label, "p").first()
    roc, prauc = areas["roc_auc"], areas["pr_auc"]
    # The names of the summary report, the same as the reference's.
    summary = {
        "model_type": f"boosted trees ({cfg.backend})",
        "feature_selection": f"top {len(chosen)} features" + (f" ({cfg.select_cut} cum importance)"
                                                               if cfg.select_cut else ""),
        "hyperparameters": {k: str(v) for k, v in params.items()},
        "best_iteration": bm.best_iteration,
        "validation_accuracy": m["accuracy"], "validation_f1": m["f1"],
        "validation_precision": m["precision"], "validation_recall": m["recall"],
        "validation_roc_auc": roc, "validation_auc_pr": prauc,
        "num_features_used": len(chosen), "categorical_features_used_count": len(sel_cat),
        "elapsed_sec": None,
    }
    timings["evaluate"] = time.time() - t0 - sum(timings.values())
    # RPT1: per-round metrics of train and eval rows, where the learner sketches them.
    rounds = hist.rounds_frame(spark, bm) if isinstance(bm, hist.HistModel) and bm.rounds else None
    result = {"importance": imp, "selection": sel, "trials": trials, "history": bm.history,
              "rounds": rounds, "val_scores": scored, "class_report": metrics.class_report(scored, cfg.label, "pred"),
              "confusion": metrics.confusion_matrix(scored, cfg.label, "pred"), "model": bm}

    # The whole path from raw columns to the probability, as one model that can be stored.
    result["pipeline"] = stages.scorer([
        plan and stages.PlanModelStage(plan), enc and stages.CategoryModelStage(enc),
        stages.SelectStage(sel_num + list(sel_cat), feats_all), learner.stage(bm)])

    # score test -> submission (SCO1, SNK4)
    if test is not None:
        C.check_required(prep["test"], sel_num + list(sel_cat), "test split")
        sub = (learner.score(bm, prep["test"], [cfg.key])
               .select(cfg.key, metrics.threshold("p", cfg.threshold).alias(cfg.label)))
        result["submission"] = sub
        if out_dir:
            sinks.write_submission_csv(sub, os.path.join(out_dir, "submission"))
    summary["elapsed_sec"] = time.time() - t0
    row = spark.createDataFrame([{k: (v if not isinstance(v, dict) else v) for k, v in summary.items()}])
    result["summary"] = row
    result["summary_dict"] = summary
    result["timings"] = timings
    if out_dir:
        sinks.write_report_csv(imp, os.path.join(out_dir, "feature_importance"))
        sinks.write_report_csv(sinks.with_json_params(row, "hyperparameters"), os.path.join(out_dir, "summary"))
        learner.save(spark, bm, os.path.join(out_dir, "model"))
        result["pipeline"].write().overwrite().save(os.path.join(out_dir, "pipeline"))
    return result
