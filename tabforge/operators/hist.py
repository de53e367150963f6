"""Histogram gradient boosting as Spark jobs (backend B): LRN2, LRN4, LRN5, LRN8, LRN9.

Published method: Chen & Guestrin, "XGBoost: A Scalable Tree Boosting
System" (KDD 2016): second-order gradients, L1/L2-regularised leaf weights,
``gamma`` split penalty, weighted quantile bins, and a *learned default
direction* for missing values (each split is scored twice, missing sent
left and right). MLlib's trees lack these, which is why this backend
exists (training on unimputed tables, LRN2).

Data flow:

1. cut points from a mergeable weighted summary (``wquantile``); rows are packed once into
   column blocks in the shared folder (``blocks``);
2. a level of a tree is one pass over the blocks and one shuffle of sums; only the best
   splits (nodes x feature chunks) reach the driver; nodes that fit into a block are finished by one group;
3. the first pass of a round also sketches the scores of the round before, for train and eval
   rows alike (``score_sketch``): the history and patience-based stopping cost no job. The exact
   PR-AUC is computed for the chosen round only;
4. every ``checkpoint_every`` rounds the blocks are written anew with their margins, large tables more often.

* LRN4 (category-set splits): the bins of a categorical column are its codes.
  At each node they are ranked once by their gradient ratio, and a prefix of that
  order is the set that goes left, as in the published optimal-partition method
  for one-dimensional gradients (Fisher's grouping). A set travels as one bit per code.
"""

from __future__ import annotations

import hashlib
import json
import math
from dataclasses import asdict, dataclass, field
from typing import ClassVar

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir
from . import blocks as B
from . import metrics
from .wquantile import CELLS, cells_of, quantile_cuts


@dataclass
class HistParams:
    n_rounds: int = 100
    max_depth: int = 6
    eta: float = 0.3
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0
    min_child_weight: float = 1.0
    scale_pos_weight: float = 1.0   # LRN3: factor on the weight of positive rows in training
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    max_bins: int = 256
    base_score: float = 0.5
    seed: int = 42
    patience: int | None = None
    eval_metric: str = "aucpr"
    checkpoint_every: int = 16


    #: Names of the published library for the same parameters.
    NAMES: ClassVar[dict] = {"n_estimators": "n_rounds", "learning_rate": "eta", "random_state": "seed"}

    @classmethod
    def of(cls, params: dict, **defaults) -> HistParams:
        return cls(**{**defaults, **{cls.NAMES.get(k, k): v for k, v in params.items()}})


# --- binning -------------------------------------------------------------------

def fit_bins(train: DataFrame, cols: list[str], max_bins: int, weight: str | None = None) -> dict:
    """Cut points per column, at even ranks of the weight (at the base score every hessian is the
    row's weight times one constant)."""
    return quantile_cuts(train, cols, max_bins, weight) if cols else {}


def bin_cells(x: np.ndarray, layout: B.Layout) -> np.ndarray:
    """Bins of a matrix of cells, a column of the result per feature."""
    return np.stack([layout.code(x[:, j], j).astype(np.int64) for j in range(x.shape[1])], axis=1)


def in_slices(cells: pd.Series, width: int):
    """Matrices of at most ``CELLS`` cells."""
    step = max(1, CELLS // max(1, width))
    for at in range(0, len(cells), step):
        yield np.array([np.asarray(r, dtype=np.float64) for r in cells.iloc[at : at + step]]).reshape(-1, width)


def apply_bins(df: DataFrame, cols: list[str], cuts: dict, keep: list[str], codes: dict | None = None) -> DataFrame:
    """``bins array<int>``: bin i holds values in [cut_{i-1}, cut_i); missing -> -1.
    One array of all cells, searched column by column per Arrow batch, so the plan
    does not grow with the number of columns."""
    layout = layout_of(cols, cuts, codes or {})

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def binned(cells: pd.Series) -> pd.Series:
        out = []
        for x in in_slices(cells, len(cols)):
            bins = bin_cells(x, layout)
            out += list(np.where(bins == np.array(layout.slots) - 1, -1, bins).astype(np.int32))
        return pd.Series(out, dtype=object)

    return df.select(*keep, binned(cells_of(cols)).alias("bins"))


def layout_of(cols: list[str], cuts: dict, codes: dict) -> B.Layout:
    return B.Layout.of([cuts[c] for c in cols], [codes.get(c, 0) for c in cols])


def count_codes(df: DataFrame, cols: list[str]) -> dict:
    """Number of codes (0, 1, ...) of each column."""
    if not cols:
        return {}
    row = df.agg(*[F.max(F.col(f"`{c}`")).alias(str(i)) for i, c in enumerate(cols)]).first()
    return {c: int(row[str(i)]) + 1 if row[str(i)] is not None else 0 for i, c in enumerate(cols)}


# --- model ---------------------------------------------------------------------

@dataclass
class HistTree:
    splits: dict  # node -> (feature, bin or list of category codes that go left, missing_left, gain)
    leaves: dict  # node -> value (eta applied)


@dataclass
class HistModel:
    cols: list
    cuts: dict
    params: HistParams
    base_margin: float
    trees: list = field(default_factory=list)
    history: list = field(default_factory=list)   # (round, eval metric), from the score sketches
    best_iteration: int = 0
    codes: dict = field(default_factory=dict)     # number of codes of each column without cut points
    rounds: list = field(default_factory=list)    # (round, split, metric, value) of train and eval rows
    best_value: float | None = None               # exact eval metric of the best round

    def node_table(self, spark) -> DataFrame:
        """The model as a node table (SNK6 for this backend)."""
        rows = []
        for t, tr in enumerate(self.trees):
            for n, (f, b, ml, g) in tr.splits.items():
                cats = [int(c) for c in b] if isinstance(b, (list, tuple)) else None
                edges = self.cuts[self.cols[f]]
                # A column of ordered codes has no cut points; its bin says it all.
                thr = None if cats or edges is None else float(edges[b]) if b < len(edges) else math.inf
                rows.append((t, n, self.cols[f], None if cats else int(b), thr, cats, bool(ml), float(g), None))
            for n, v in tr.leaves.items():
                rows.append((t, n, None, None, None, None, None, None, float(v)))
        schema = ("tree int, node int, feature string, bin int, threshold double, categories array<int>, "
                  "missing_left boolean, gain double, leaf_value double")
        return spark.createDataFrame(rows, schema)

    def importances(self) -> dict:
        """Average split gain per feature, normalised to sum 1."""
        tot, cnt = {}, {}
        for tr in self.trees[: self.best_iteration + 1]:
            for _, (f, _, _, g) in tr.splits.items():
                tot[f] = tot.get(f, 0.0) + g
                cnt[f] = cnt.get(f, 0) + 1
        avg = {self.cols[f]: tot[f] / cnt[f] for f in tot}
        s = sum(avg.values()) or 1.0
        return {c: avg.get(c, 0.0) / s for c in self.cols}

    def to_dict(self) -> dict:
        return {"cols": self.cols, "cuts": self.cuts, "params": asdict(self.params),
                "base_margin": self.base_margin, "history": self.history,
                "best_iteration": self.best_iteration, "codes": self.codes, "rounds": self.rounds,
                "best_value": self.best_value,
                "trees": [{"splits": list(t.splits.items()), "leaves": list(t.leaves.items())} for t in self.trees]}

    @classmethod
    def from_dict(cls, d: dict) -> HistModel:
        trees = [HistTree({int(n): tuple(v) for n, v in t["splits"]}, {int(n): v for n, v in t["leaves"]})
                 for t in d["trees"]]
        return cls(cols=d["cols"], cuts=d["cuts"], params=HistParams(**d["params"]), base_margin=d["base_margin"],
                   trees=trees, history=[tuple(h) for h in d["history"]], best_iteration=d["best_iteration"],
                   codes=d["codes"], rounds=[tuple(r) for r in d["rounds"]], best_value=d["best_value"])

    def save(self, spark, path: str) -> None:
        """SNK6: the model as one JSON line in a text folder."""
        text = json.dumps(self.to_dict())
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)

    @classmethod
    def load(cls, spark, path: str) -> HistModel:
        return cls.from_dict(json.loads(spark.read.text(path).first()["value"]))

    def layout(self) -> B.Layout:
        return layout_of(self.cols, self.cuts, self.codes)

    def predict_proba(self, df: DataFrame, keep: list[str], use_best: bool = True) -> DataFrame:
        """Bins and tree walks of an Arrow batch in numpy, in one function over one array column: the plan has
        one size for every model, and the work is trees x depth gathers per batch."""
        trees = self.trees[: self.best_iteration + 1] if use_best else self.trees
        depth, layout, base, width = self.params.max_depth, self.layout(), self.base_margin, len(self.cols)
        packed = [B.PackedTree.of(t.splits, t.leaves, depth) for t in trees]
        missing = [s - 1 for s in layout.slots]

        @F.pandas_udf(T.DoubleType())
        def margin(cells: pd.Series) -> pd.Series:
            out = []
            for x in in_slices(cells, width):
                binned: dict = {}

                def column(j: int, x=x, binned=binned) -> np.ndarray:
                    if j not in binned:
                        binned[j] = layout.code(x[:, j], j)
                    return binned[j]

                m = np.full(len(x), base)
                for tree in packed:
                    m += tree.value[tree.nodes(column, missing, len(x), depth)]
                out.append(m)
            return pd.Series(np.concatenate(out) if out else np.zeros(0))

        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(cells_of(self.cols))))
        return df.select(*keep, p.alias("p"))


def _leaf(g: float, h: float, p: HistParams) -> float:
    g_soft = math.copysign(max(abs(g) - p.reg_alpha, 0.0), g)
    return -p.eta * g_soft / (h + p.reg_lambda)


def _col_sample(n_features: int, frac: float, seed: int, rnd: int) -> list[int] | None:
    if frac >= 1.0:
        return None
    k = max(1, int(math.ceil(frac * n_features)))
    order = sorted(range(n_features), key=lambda f: hashlib.md5(f"{seed}:col{rnd}:{f}".encode()).hexdigest())
    return sorted(order[:k])


@dataclass
class TrainingTable:
    """Train and eval rows as column blocks, ready for any number of fits."""

    cols: list
    cuts: dict
    codes: dict
    sets: list
    table: DataFrame
    paths: list
    with_eval: bool
    rows: int   # train rows

    @classmethod
    def of(cls, train: DataFrame, cols: list[str], label: str, key: str, weight: str | None = None,
           val: DataFrame | None = None, categorical: list[str] | None = None, max_bins: int = 256,
           base_score: float = 0.5) -> TrainingTable:
        ensure_checkpoint_dir(train.sparkSession)
        sets = [c for c in cols if c in set(categorical or [])]
        cuts = fit_bins(train, [c for c in cols if c not in sets], max_bins, weight) | {c: None for c in sets}
        codes = count_codes(train, sets)
        base = base_margin(base_score)
        layout = layout_of(cols, cuts, codes)
        packed = B.pack(train, cols, layout, key, label, weight, B.TRAIN, base)
        if val is not None:
            known = weight if weight in val.columns else None
            packed = packed.unionByName(B.pack(val, cols, layout, key, label, known, B.EVAL, base))
        table, path = B.written(packed, "hist-blocks")
        rows = table.filter(F.col("part") == B.TRAIN).agg(F.sum("n")).first()[0] or 0
        return cls(cols, cuts, codes, sets, table, [path], val is not None, rows)

    def forget(self) -> None:
        B.forget(self.table.sparkSession, self.paths)


def base_margin(base_score: float) -> float:
    return math.log(base_score / (1 - base_score))


def fit_hist(train: DataFrame, cols: list[str], label: str, key: str, weight: str | None = None,
             params: HistParams | None = None, val: DataFrame | None = None,
             categorical: list[str] | None = None) -> HistModel:
    """Train with optional early stopping on ``val`` (the last eval set).
    ``categorical`` columns hold codes 0, 1, ... (NULL: missing)."""
    p = params or HistParams()
    table = TrainingTable.of(train, cols, label, key, weight, val, categorical, p.max_bins, p.base_score)
    try:
        model = fit_on(table, [p])[0]
    finally:
        table.forget()
    if val is not None and model.trees:
        scored = model.predict_proba(val, [key, label])
        if p.eval_metric == "logloss":
            model.best_value = metrics.log_loss(scored, label, "p").first()["log_loss"]
        else:
            model.best_value = metrics.pr_auc(scored, label, "p").first()["pr_auc"]
    return model


class Fit:
    """One booster in training: ``steps`` asks for passes over the blocks, and stops at rungs."""

    def __init__(self, table: TrainingTable, params: HistParams, rungs: tuple = ()):
        self.p, self.rungs, self.with_eval = params, set(rungs), table.with_eval
        self.model = HistModel(cols=table.cols, cuts=table.cuts, params=params, base_margin=base_margin(params.base_score),
                               codes=table.codes)
        self.layout = self.model.layout()
        self.sets = frozenset(i for i, c in enumerate(table.cols) if c in table.sets)
        self.recent: list = []
        self.unkept = 0   # trees since the last write that the table keeps
        self.rows = table.rows
        self.slot = 0
        self.low = self.high = self.model.base_margin
        self.best, self.since = None, 0

    def work(self, **more) -> B.Pass:
        p = self.p
        return B.Pass(layout=self.layout, splitting=B.Splitting(p.reg_lambda, p.reg_alpha, p.gamma, p.min_child_weight),
                      depth=p.max_depth, recent=self.recent, sets=self.sets, slot=self.slot, positive=p.scale_pos_weight,
                      **more)

    def ended(self, rows: list) -> bool:
        """Take down the metrics of the trees so far; whether patience ends the fit."""
        t = len(self.model.trees) - 1
        for r in rows:
            split = "eval" if r["node"] == B.EVAL else "train"
            self.model.rounds += [(t, split, "logloss", r["gain"]), (t, split, "aucpr", r["gl"]), (t, split, "auc", r["hl"])]
            if split == "eval":
                sign = -1 if self.p.eval_metric == "logloss" else 1
                value = r["gain"] if self.p.eval_metric == "logloss" else r["gl"]
                self.model.history.append((t, value))
                if self.best is None or sign * value > sign * self.best:
                    self.best, self.since, self.model.best_iteration = value, 0, t
                else:
                    self.since += 1
        return self.p.patience is not None and self.since >= self.p.patience

    def steps(self):
        """Generator: yields a ``Pass`` and is sent its rows, or yields the number of rounds at a rung."""
        p, model = self.p, self.model
        for t in range(p.n_rounds):
            if t in self.rungs:
                yield t
            wide = (self.low, self.high) if self.with_eval and t else None
            work = self.work(features=_col_sample(len(model.cols), p.colsample_bytree, p.seed, t), sample=p.subsample,
                             salt=p.seed * 1_000_003 + t, sketch_range=wide)
            tree = yield from self.grow(work)
            if tree is None:
                return
            model.trees.append(tree)
            self.recent.append(B.PackedTree.of(tree.splits, tree.leaves, p.max_depth))
            self.unkept += 1
            self.low, self.high = self.low + min(tree.leaves.values()), self.high + max(tree.leaves.values())
        if self.with_eval and model.trees:
            self.ended([r for r in (yield self.work(sketch_range=(self.low, self.high))) if r["kind"] == 1])
        else:
            model.best_iteration = max(0, len(model.trees) - 1)

    def grow(self, work: B.Pass):
        """One tree, level by level as long as nodes are large; None if the metrics of the first pass end the fit."""
        p = self.p
        splits: dict = {}
        leaves: dict = {}
        pending: dict = {}
        open_nodes = {0: self.rows}   # and how many rows they hold at most
        # A quarter of the table at most, so that a pass leaves work for several groups.
        most = min(max(B.BLOCK_ROWS, min(B.SMALL_ROWS, self.rows // 4)), B.BLOCK_CELLS // max(1, len(work.chosen())))
        first = True
        while open_nodes:
            work.small = [n for n, rows in open_nodes.items() if rows <= most]
            work.active = [n for n in open_nodes if n not in set(work.small)]
            work.slot = self.slot
            rows = yield work
            if first and work.sketch_range and self.ended([r for r in rows if r["kind"] == 1]):
                return None
            first, work.sketch_range = False, None
            best: dict = {}
            for r in sorted((r for r in rows if r["kind"] == 0), key=lambda r: (r["f"] is None, r["f"])):
                known = best.get(r["node"])
                if known is None or (r["gain"] is not None and (known["gain"] is None or r["gain"] > known["gain"])):
                    best[r["node"]] = r
            for n, r in best.items():
                if r["gain"] is None or not r["gain"] > 0:
                    leaves[n] = _leaf(r["g"], r["h"], p)
                    continue
                b = int(r["b"]) if r["codes"] is None else B.bits_to_codes(r["codes"])
                splits[n] = (int(r["f"]), b, bool(r["missing_left"]), float(r["gain"]))
                pending[2 * n + 1] = (r["gl"], r["hl"])
                pending[2 * n + 2] = (r["g"] - r["gl"], r["h"] - r["hl"])
            # Below a small node the whole subtree came back.
            open_nodes = {
                2 * n + side: (best[n]["cl"], best[n]["c"] - best[n]["cl"])[side - 1]
                for n in work.active if n in splits and 2 * n + 1 < 2 ** p.max_depth - 1 for side in (1, 2)
            }
            work.growing = B.PackedTree.of(splits, leaves, p.max_depth)
        # Children of the deepest level, and a root without a row.
        for n in [c for n in splits for c in (2 * n + 1, 2 * n + 2)] or [0]:
            if n not in splits and n not in leaves:
                leaves[n] = _leaf(*pending.get(n, (0.0, 0.0)), p)
        return HistTree(splits=splits, leaves=leaves)


def fit_on(table: TrainingTable, params: list[HistParams], rungs: tuple = (), survivors=None) -> list[HistModel]:
    """Fit a booster for each of ``params`` on one table, in step: every pass over the blocks serves all of
    them. At a rung (a number of rounds) a booster waits until all others that still train have come there or ended;
    ``survivors`` (rung, histories by place of all that were not dropped before) then says which go on."""
    fits = [Fit(table, p, rungs) for p in params]
    live = {i: fit.steps() for i, fit in enumerate(fits)}
    asked = {i: next(steps, None) for i, steps in live.items()}
    tasks = table.table.rdd.getNumPartitions()
    blocks = Margins(table)
    pruned: set[int] = set()

    def go_on(i: int, rows) -> None:
        try:
            asked[i] = live[i].send(rows)
        except StopIteration:
            del live[i], asked[i]

    try:
        while asked:
            asked = {i: a for i, a in asked.items() if a is not None}
            passes = [i for i, a in asked.items() if isinstance(a, B.Pass)]
            if not passes:
                # All wait: the lowest rung is decided first.
                rung = min(asked.values())
                there = [i for i in asked if asked[i] == rung]
                stay = survivors(rung, {i: f.model.history for i, f in enumerate(fits) if i not in pruned}) if survivors else there
                for i in there:
                    if i in stay:
                        go_on(i, None)
                    else:
                        pruned.add(i)
                        del live[i], asked[i]
                continue
            if blocks.renewed([fits[i] for i in asked]):
                for i in passes:
                    asked[i].recent, asked[i].slot = fits[i].recent, fits[i].slot
            rows: dict = {}
            with B.small_batches(table.table.sparkSession):
                found = B.found(blocks.df, [asked[i] for i in passes], tasks).collect()  # nodes x chunks of each booster
            for r in found:
                rows.setdefault(r["trial"], []).append(r)
            for place, i in enumerate(passes):
                go_on(i, rows.get(place, []))
    finally:
        blocks.forget()
    return [fit.model for fit in fits]


#: What a write of the blocks costs, in walks of one row down one tree: in all, for each row, and for each row of a booster.
WRITE = (16_000_000, 10, 2)


class Margins:
    """The blocks that a fit reads, with the margins of its boosters. Every ``checkpoint_every`` trees the table keeps
    them. Every pass walks the trees since the last write again: there is a write in between, which lasts until
    the next one, as soon as these walks have cost as much as it will."""

    def __init__(self, table: TrainingTable):
        self.table, self.df, self.path = table, table.table, None
        self.walks = 0   # trees walked by the passes since the last write

    def renewed(self, fits: list[Fit]) -> bool:
        """Whether it was time to write the blocks anew."""
        kept = max(f.unkept for f in fits) >= fits[0].p.checkpoint_every
        self.walks += sum(len(f.recent) for f in fits)
        once, row, booster = WRITE
        if not kept and self.walks * self.table.rows < once + (row + booster * len(fits)) * self.table.rows:
            return False
        self.walks = 0
        new, path = B.written(B.advanced(self.df, [f.work() for f in fits]), "hist-blocks")
        self.forget()
        self.df = new
        if kept:
            self.table.table = new
            self.table.paths.append(path)
        else:
            self.path = path
        for slot, f in enumerate(fits):
            f.recent, f.slot, f.unkept = [], slot, 0 if kept else f.unkept
        return True

    def forget(self) -> None:
        if self.path:
            B.forget(self.df.sparkSession, [self.path])
            self.path = None


def rounds_frame(spark, model: HistModel) -> DataFrame:
    """LRN8: ``(round, split, metric, value)`` of train and eval rows."""
    return spark.createDataFrame(model.rounds, "round int, split string, metric string, value double")


def history_frame(spark, model: HistModel) -> DataFrame:
    """``(round, value)`` eval history of a fitted model."""
    return spark.createDataFrame(model.history, T.StructType([T.StructField("round", T.IntegerType()),
                                                              T.StructField("value", T.DoubleType())]))
