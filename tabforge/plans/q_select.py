"""Queries: selection, early stopping, sweeps, prompt export (WIN1, FLT3,
SRT1-SRT3, FEA13, WIN5, LRN10, TUN1, MET11, EXP1, SCL5-SCL8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import export, history, select, tune
from ..sources.tables import read_table
from . import fixtures as fx
from .registry import query, r6


# EXP2 + AGG11 ---------------------------------------------------------------------
@query("export_counts", sql=f"""
SELECT count(*) FILTER (WHERE toxic IS NOT NULL) AS n_good, count(*) FILTER (WHERE toxic IS NULL) AS n_rejected
FROM ({fx.DOC_LABELS_SQL})
""")
def export_counts(spark, sf_dir):
    good, bad = export.split_good_bad(fx.doc_labels(spark, sf_dir), "toxic")
    flagged = good.select(F.lit(1).alias("g")).unionByName(bad.select(F.lit(0).alias("g")))
    return flagged.agg(F.count_if(F.col("g") == 1).alias("n_good"), F.count_if(F.col("g") == 0).alias("n_rejected"))


# SCL7, both branches -----------------------------------------------------------------
@query("number_text", sql="""
SELECT o_orderkey, CAST(x AS VARCHAR) AS plain, CAST(x * 1e7 AS VARCHAR) AS large, CAST(x * 1e14 AS VARCHAR) AS huge,
       CAST(x / 1e9 AS VARCHAR) AS small, CAST(-x / 1e6 AS VARCHAR) AS negative
FROM (SELECT o_orderkey, o_totalprice AS x FROM orders)
""")
def number_text(spark, sf_dir):
    from pyspark.sql import types as T
    from ..functions.text import num_to_text
    x = F.col("o_totalprice")
    shown = {"plain": x, "large": x * 1e7, "huge": x * 1e14, "small": x / 1e9, "negative": -x / 1e6}
    return read_table(spark, sf_dir, "orders").select(
        "o_orderkey", *[num_to_text(v, T.DoubleType()).alias(k) for k, v in shown.items()])


# RPT1 --------------------------------------------------------------------------------
@query("history_pivot", sql="""
SELECT l_linenumber AS round, round(avg(l_discount) FILTER (WHERE l_returnflag = 'A'), 6) AS a_disc,
       round(avg(l_discount) FILTER (WHERE l_returnflag = 'N'), 6) AS n_disc
FROM lineitem GROUP BY l_linenumber
""")
def history_pivot(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    long = li.groupBy(F.col("l_linenumber").alias("round"), F.lower("l_returnflag").alias("split")).agg(
        r6(F.avg("l_discount")).alias("value")).withColumn("metric", F.lit("disc"))
    return history.history_table(long, [("a", "disc"), ("n", "disc")])


# FEA14 + SET3 + CHK3 -----------------------------------------------------------------
@query("common_features", sql="SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def common_features(spark, sf_dir):
    from ..operators import columns as C
    orders = read_table(spark, sf_dir, "orders")
    other = orders.select("o_orderstatus", "o_totalprice", "o_orderkey")
    return orders.select(*C.common_columns(orders, other))


# WIN1 + FLT3 + SRT1-SRT2 + FEA13 ------------------------------------------------
@query("cumulative_selection", sql=f"""
WITH s AS ({fx.PART_SHARE_SQL}),
r AS (SELECT feature, importance,
             row_number() OVER (ORDER BY importance DESC, feature) - 1 AS rank,
             sum(importance) OVER (ORDER BY importance DESC, feature ROWS UNBOUNDED PRECEDING)
               / sum(importance) OVER () AS ratio
      FROM s),
k AS (SELECT CASE WHEN n_sel < 50 THEN 50 WHEN n_sel > 2000 THEN 2000 ELSE n_sel END AS k
      FROM (SELECT count(*) FILTER (WHERE ratio <= 0.99e0) AS n_sel FROM r))
SELECT feature, round(importance, 6) AS importance, rank, round(ratio, 6) AS cumulative_ratio,
       rank < k AS selected
FROM r, k
""")
def cumulative_selection(spark, sf_dir):
    sel = select.cumulative_selection(fx.part_share(spark, sf_dir), 0.99, 50, 2000)
    return sel.select("feature", r6("importance").alias("importance"), "rank",
                      r6("cumulative_ratio").alias("cumulative_ratio"), "selected")


# WIN5 + LRN10 -------------------------------------------------------------------
_PATIENCE = 5


@query("early_stopping_round", sql=f"""
WITH h AS ({fx.EVENT_SERIES_SQL}),
i AS (SELECT round, value,
             (max(value) OVER (ORDER BY round ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS prev_best
      FROM h),
j AS (SELECT round, value,
             max(CASE WHEN prev_best IS NULL OR value > prev_best THEN round END)
               OVER (ORDER BY round ROWS UNBOUNDED PRECEDING) AS last_best
      FROM i),
s AS (SELECT coalesce(min(CASE WHEN round - last_best >= {_PATIENCE} THEN round END), max(round)) AS stop_round,
             count(*) AS n_rounds FROM j)
SELECT j.last_best AS best_round, round(h.value, 6) AS best_value, s.stop_round, s.n_rounds
FROM j JOIN s ON j.round = s.stop_round JOIN h ON h.round = j.last_best
""")
def early_stopping_round(spark, sf_dir):
    es = history.early_stopping(fx.event_series(spark, sf_dir), _PATIENCE, maximize=True)
    return es.select("best_round", r6("best_value").alias("best_value"), "stop_round", "n_rounds")


# TUN1 + MET11 + SRT3 -----------------------------------------------------------
_THRESHOLDS = [0.1, 0.3, 0.5, 0.7, 0.9]


def _sweep_sql():
    arms = " UNION ALL ".join(
        f"SELECT {i} AS trial, {t!r}e0 AS threshold FROM (SELECT 1)" for i, t in enumerate(_THRESHOLDS))
    return f"""
WITH s AS ({fx.LINE_SCORES_SQL}), t AS ({arms}),
c AS (SELECT trial, threshold,
             count(*) FILTER (WHERE y = 1 AND score > threshold) * 1e0 AS tp,
             count(*) FILTER (WHERE y = 0 AND score > threshold) * 1e0 AS fp,
             count(*) FILTER (WHERE y = 1) * 1e0 AS P, count(*) * 1e0 AS n
      FROM s, t GROUP BY trial, threshold),
m AS (SELECT trial, threshold,
             coalesce((tp + (n - P - fp)) / nullif(n, 0), 0) AS accuracy,
             coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
             coalesce(tp / nullif(P, 0), 0) AS recall,
             coalesce(2 * tp / nullif(2 * tp + fp + (P - tp), 0), 0) AS f1 FROM c)
"""


@query("sweep_table", sql=_sweep_sql() + """
SELECT CAST(trial AS INTEGER) AS trial, threshold, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1 FROM m
""")
def sweep_table(spark, sf_dir):
    t = tune.threshold_sweep(fx.line_scores(spark, sf_dir), "y", "score", _THRESHOLDS)
    return t.select("trial", "threshold", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("sweep_best", sql=_sweep_sql() + """
SELECT CAST(trial AS INTEGER) AS trial, threshold, round(f1, 6) AS f1 FROM m ORDER BY f1 DESC, trial LIMIT 1
""")
def sweep_best(spark, sf_dir):
    t = tune.threshold_sweep(fx.line_scores(spark, sf_dir), "y", "score", _THRESHOLDS)
    return tune.best_trial(t, "f1").select("trial", "threshold", r6("f1").alias("f1"))


# EXP1 + SCL5-SCL8 --------------------------------------------------------------
_CUSTOMER_SQL = """
SELECT c_custkey, c_name, NULLIF(c_nationkey, 0) AS c_nationkey,
       CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal END AS c_acctbal, c_mktsegment,
       CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS y
FROM customer
"""


def _kv_sql(col):
    return f"CASE WHEN {col} IS NOT NULL THEN '{col}: ' || CAST({col} AS VARCHAR) END"


@query("prompt_export", sql=f"""
SELECT '{export.INSTRUCTION}' AS instruction,
       concat_ws(', ', {', '.join(_kv_sql(c) for c in ['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'])}) AS input,
       CASE WHEN y = 1 THEN '{export.YES}' ELSE '{export.NO}' END AS output
FROM ({_CUSTOMER_SQL})
""")
def prompt_export(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    c = c.select("c_custkey", "c_name", F.nullif(F.col("c_nationkey"), F.lit(0)).alias("c_nationkey"),
                 F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal"), "c_mktsegment",
                 (F.col("c_mktsegment") == "BUILDING").cast("int").alias("y"))
    return export.to_prompts(c, "y")
