"""Metric histories and patience-based early stopping: WIN4, WIN5, LRN9,
LRN10, RPT1.

A history is ``(round, value)`` (one row per boosting round: bounded by the
round budget, so the windows below run over a small table).

Stopping rule (the learner's): a round improves when its value is strictly
better than every earlier round; training stops at the first round that is
``patience`` rounds past the last improvement; the best round is the last
improvement up to the stop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def early_stopping(history: DataFrame, patience: int, maximize: bool = True,
                   round_col: str = "round", value_col: str = "value") -> DataFrame:
    """One row: ``best_round, best_value, stop_round, n_rounds``."""
    w_prev = Window.orderBy(round_col).rowsBetween(Window.unboundedPreceding, -1)
    w_upto = Window.orderBy(round_col).rowsBetween(Window.unboundedPreceding, 0)
    prev_best = (F.max(value_col) if maximize else F.min(value_col)).over(w_prev)
    better = (F.col(value_col) > prev_best) if maximize else (F.col(value_col) < prev_best)
    h = (history.select(round_col, value_col)
         .withColumn("_improved", prev_best.isNull() | better)
         .withColumn("_last_best", F.max(F.when(F.col("_improved"), F.col(round_col))).over(w_upto)))
    h = h.withColumn("_stop", (F.col(round_col) - F.col("_last_best")) >= F.lit(patience))
    stop = h.agg(F.coalesce(F.min(F.when(F.col("_stop"), F.col(round_col))), F.max(round_col)).alias("stop_round"),
                 F.count(F.lit(1)).alias("n_rounds"))
    at_stop = h.join(F.broadcast(stop), F.col(round_col) == F.col("stop_round")).select(
        F.col("_last_best").alias("best_round"), "stop_round", "n_rounds")
    best_val = history.select(F.col(round_col).alias("best_round"), F.col(value_col).alias("best_value"))
    return at_stop.join(best_val, "best_round").select("best_round", "best_value", "stop_round", "n_rounds")


def history_table(per_round: DataFrame, series: list[tuple[str, str]],
                  split_col: str = "split", metric_col: str = "metric") -> DataFrame:
    """RPT1: ``(round, <split>_<metric> ...)`` from the long history ``(round,
    split, metric, value)``; ``series`` names the (split, metric) columns, so no
    job runs to find them."""
    keyed = per_round.withColumn("_k", F.concat_ws("_", split_col, metric_col))
    return keyed.groupBy("round").pivot("_k", [f"{s}_{m}" for s, m in series]).agg(F.first("value"))
