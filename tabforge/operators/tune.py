"""Sweeps and hyperparameter search: TUN1-TUN4, MET11, SRT3-SRT4.

The search (TUN3) is a tree-structured Parzen estimator (Bergstra et al., NIPS 2011) with successive halving
(Jamieson and Talwalkar, AISTATS 2016). Trials come in batches. A batch's parameters depend on the
finished batches only, its boosters train in step over one binned table (``hist.fit_on``: one scan serves
all of them), and at each rung only the best part goes on. Everything drawn comes from
``md5(seed:trial:name)``, so a search gives the same trials on any engine and cluster.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def threshold_sweep(df: DataFrame, y: str, score: str, thresholds: list[float]) -> DataFrame:
    """MET11 over trials = thresholds: one aggregate (no row explosion),
    ``(trial, threshold, accuracy, precision, recall, f1)``."""
    yy, s = F.col(y), F.col(score)
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(yy == 1).alias("P")]
    for i, t in enumerate(thresholds):
        aggs += [F.count_if((yy == 1) & (s > F.lit(float(t)))).alias(f"tp{i}"),
                 F.count_if((yy == 0) & (s > F.lit(float(t)))).alias(f"fp{i}")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"{i}, {float(t)!r}D, tp{i}, fp{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr("n", "P", f"stack({len(thresholds)}, {stack}) as (trial, threshold, tp, fp)")
    tp, fp, P, n = (F.col(c).cast("double") for c in ("tp", "fp", "P", "n"))
    fn, tn = P - tp, n - P - fp
    z = F.lit(0.0)
    return long.select(
        F.col("trial").cast("int").alias("trial"), "threshold",
        F.coalesce(F.try_divide(tp + tn, n), z).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), z).alias("precision"),
        F.coalesce(F.try_divide(tp, P), z).alias("recall"),
        F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), z).alias("f1"))


def best_trial(trials: DataFrame, objective: str, maximize: bool = True, trial_col: str = "trial") -> DataFrame:
    """SRT3/SRT4: arg-best of a trials table, first trial wins ties."""
    order = F.desc(objective) if maximize else F.asc(objective)
    return trials.orderBy(order, F.asc(trial_col)).limit(1)


def weight_sweep(train: DataFrame, val: DataFrame, label: str, key: str, weights: list[float], threshold: float,
                 params: dict | None = None, features: str = "features", patience: int = 20):
    """TUN1: one weighted fit per positive-class weight, all scored on ``val``;
    the table ``(weight, accuracy, precision, recall, f1, roc_auc, pr_auc)`` at the
    threshold, and the refit with the weight of the best F1 (the first one wins
    ties). Returns ``(table, best_weight, model)``."""
    from . import learn, metrics

    def fit(w: float):
        weighted = train.withColumn("_w", learn.class_weight_col(label, w))
        return learn.fit_with_early_stopping(weighted, val, label, key, features, "_w", params, patience)

    # The fits are Spark jobs of their own: all run at once.
    with ThreadPoolExecutor(len(weights)) as pool:
        fits = dict(zip(weights, pool.map(fit, weights), strict=True))
    scored = None
    for w in weights:
        one = fits[w].predict_proba(val, [key, label], features).withColumn("weight", F.lit(float(w)))
        scored = one if scored is None else scored.unionByName(one)
    # A row per weight and validation row, read by two aggregates: written once.
    table = metrics.metrics_table(scored.checkpoint(eager=True), label, "p", threshold, by=["weight"])
    order = {float(w): i for i, w in enumerate(weights)}
    rows = table.select("weight", "f1").collect()  # one row per weight
    best = min(rows, key=lambda r: (-r["f1"], order[r["weight"]]))["weight"]
    # The refit with the same weight, rows and seed is the fit itself.
    model = next(fits[w] for w in weights if float(w) == best)
    return table, best, model


# Search space (TUN2) ------------------------------------------------------------

def _unit(seed: int, trial: int, name: str) -> float:
    h = hashlib.md5(f"{seed}:{trial}:{name}".encode()).hexdigest()
    return int(h[:13], 16) / float(16 ** 13)


def suggest(space: dict, trial: int, seed: int = 42) -> dict:
    """One trial's parameters. ``space`` maps a name to
    ``("float", lo, hi)``, ``("logfloat", lo, hi)`` or ``("int", lo, hi)``."""
    return {name: from_unit(*spec, _unit(seed, trial, name)) for name, spec in space.items()}


# Tree-structured Parzen estimator (TUN3) ------------------------------------------

#: Trials drawn at random before the estimator starts, share of trials that count as good, and
#: candidates drawn for each parameter.
STARTUP = 10
GOOD_SHARE = 0.25
CANDIDATES = 24


def to_unit(kind: str, lo: float, hi: float, value: float) -> float:
    """A parameter's place in its range, 0 to 1 (integers: the middle of their cell)."""
    if kind == "logfloat":
        return (math.log(value) - math.log(lo)) / (math.log(hi) - math.log(lo))
    if kind == "int":
        return (value - lo + 0.5) / (hi - lo + 1)
    return (value - lo) / (hi - lo)


def from_unit(kind: str, lo: float, hi: float, u: float) -> float | int:
    if kind == "logfloat":
        return math.exp(math.log(lo) + u * (math.log(hi) - math.log(lo)))
    if kind == "int":
        return int(min(hi, lo + math.floor(u * (hi - lo + 1))))
    return lo + u * (hi - lo)


def parzen(points: list[float]) -> tuple[list[float], list[float]]:
    """Centres and widths of the kernels of some points in [0, 1], and of the flat prior. A kernel is as wide as the
    greater distance to its neighbours, at least ``1 / min(100, n + 1)``."""
    ordered = sorted([*points, 0.5])
    least = 1.0 / min(100, len(ordered))
    widths = []
    prior = ordered.index(0.5)
    for i, c in enumerate(ordered):
        left = c - (ordered[i - 1] if i else 0.0)
        right = (ordered[i + 1] if i + 1 < len(ordered) else 1.0) - c
        widths.append(1.0 if i == prior else min(1.0, max(least, left, right)))
    return ordered, widths


def _phi(x: float) -> float:
    return 0.5 * (1.0 + math.erf(x / math.sqrt(2.0)))


def parzen_density(x: float, centres: list[float], widths: list[float]) -> float:
    """Mean of normal densities, each cut to [0, 1]."""
    total = 0.0
    for c, w in zip(centres, widths, strict=True):
        inside = _phi((1.0 - c) / w) - _phi(-c / w)
        total += math.exp(-0.5 * ((x - c) / w) ** 2) / (w * math.sqrt(2.0 * math.pi) * inside)
    return total / len(centres)


def _draw(u: float, v: float, centres: list[float], widths: list[float]) -> float:
    """A draw from the mixture: the kernel by ``u``, the place in it by ``v``."""
    i = min(len(centres) - 1, int(u * len(centres)))
    c, w = centres[i], widths[i]
    low, high = _phi(-c / w), _phi((1.0 - c) / w)
    normal = NormalDist()
    return min(1.0, max(0.0, c + w * normal.inv_cdf(min(1 - 1e-12, max(1e-12, low + v * (high - low))))))


def tpe_suggest(space: dict, seen: list[tuple[dict, float]], trial: int, seed: int = 42, running: list[dict] | None = None) -> dict:
    """Parameters of a trial from the finished ones ``(params, objective)``, greater objectives being better: for
    each parameter, of some draws from the density of the good trials, the one with the greatest ratio
    to the density of the others. Trials that still run count among the others, which keeps a batch apart."""
    if len(seen) < STARTUP:
        return suggest(space, trial, seed)
    ranked = sorted(seen, key=lambda s: -s[1])
    n_good = max(1, math.ceil(GOOD_SHARE * len(ranked)))
    ranked += [(p, -math.inf) for p in running or []]
    out = {}
    for name, spec in space.items():
        good, rest = (parzen([to_unit(*spec, p[name]) for p, _ in part]) for part in (ranked[:n_good], ranked[n_good:]))
        drawn = [_draw(_unit(seed, trial, f"{name}:{i}:kernel"), _unit(seed, trial, f"{name}:{i}:place"), *good)
                 for i in range(CANDIDATES)]
        out[name] = from_unit(*spec, max(drawn, key=lambda x: parzen_density(x, *good) / parzen_density(x, *rest)))
    return out


def halving(reduction: int, maximize: bool = True) -> Callable[[int, dict], set]:
    """Successive halving: of the trials' histories ``{place: [(round, value), ...]}`` up to a rung, the places of the
    best ``1 / reduction``, the first trial winning ties. Ended trials count, so one of them may take a place."""

    def survivors(rung: int, histories: dict) -> set:
        sign = 1 if maximize else -1
        best = {i: max((sign * v for t, v in h if t < rung), default=-math.inf) for i, h in histories.items()}
        ranked = sorted(best, key=lambda i: (-best[i], i))
        return set(ranked[: math.ceil(len(ranked) / reduction)])

    return survivors


TRIALS = T.StructType([T.StructField("trial", T.IntegerType()),
                       T.StructField("params", T.MapType(T.StringType(), T.DoubleType())),
                       T.StructField("objective", T.DoubleType()),
                       T.StructField("rounds", T.IntegerType()),
                       T.StructField("pruned", T.BooleanType())])


def search(spark: SparkSession, space: dict, n_trials: int,
           evaluate: Callable[[list[dict]], list[tuple[float, int, bool]]], seed: int = 42, batch: int = 10) -> DataFrame:
    """TUN3: trials in batches; ``evaluate`` gives (objective, rounds, pruned) for each one's parameters. The
    table ``(trial, params, objective, rounds, pruned)``."""
    rows, seen = [], []
    while len(rows) < n_trials:
        first = len(rows)
        drawn: list[dict] = []
        for t in range(first, min(n_trials, first + batch)):
            drawn.append(tpe_suggest(space, seen, t, seed, drawn))
        for i, (p, (objective, rounds, pruned)) in enumerate(zip(drawn, evaluate(drawn), strict=True)):
            rows.append((first + i, {k: float(v) for k, v in p.items()}, float(objective), int(rounds), bool(pruned)))
            seen.append((p, float(objective)))
    return spark.createDataFrame(rows, TRIALS)


#: Rounds after which a batch is cut, and to which part of it.
RUNGS = (5, 20, 80)
REDUCTION = 4


def search_boosters(table, space: dict, n_trials: int, seed: int = 42, batch: int = 10, rungs: tuple = RUNGS,
                    reduction: int = REDUCTION, **fixed) -> DataFrame:
    """TUN2-TUN4 on the histogram booster: every trial trains on ``table`` (``hist.TrainingTable``) with ``fixed`` and its own
    parameters; its objective is the best eval metric of its rounds."""
    from .hist import HistParams, fit_on

    maximize = fixed.get("eval_metric") != "logloss"

    def evaluate(drawn: list[dict]) -> list[tuple[float, int, bool]]:
        params = [HistParams.of(p, seed=seed, **fixed) for p in drawn]
        models = fit_on(table, params, rungs, halving(reduction, maximize))
        out = []
        for model, p in zip(models, params, strict=True):
            values = [v for _, v in model.history]
            best = max(values) if maximize else -min(values)
            ended = len(model.history) >= p.n_rounds or (
                p.patience is not None and len(model.history) - 1 - model.best_iteration >= p.patience)
            out.append((best, len(model.history), not ended))
        return out

    return search(table.table.sparkSession, space, n_trials, evaluate, seed, batch)


# The reference's search space, as parameters.
XGB_SPACE = {
    "learning_rate": ("logfloat", 1e-3, 0.2),
    "max_depth": ("int", 3, 10),
    "subsample": ("float", 0.5, 1.0),
    "colsample_bytree": ("float", 0.5, 1.0),
    "gamma": ("float", 0.0, 5.0),
    "reg_alpha": ("logfloat", 1e-8, 10.0),
    "reg_lambda": ("logfloat", 1e-8, 10.0),
}
#: The part of it that MLlib's trees have.
GBT_SPACE = {k: v for k, v in XGB_SPACE.items() if k not in ("gamma", "reg_alpha", "reg_lambda")}
