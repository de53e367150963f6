"""Queries: thresholding and metrics (PRJ10-11, MET1-MET9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics
from . import fixtures as fx
from .registry import query, r6

# A fixed logistic score over the order features (a stand-in for a fitted
# model, so the metric operators can be checked against SQL).
_Z_SQL = ("-3e0 + CASE WHEN status = 'P' THEN 2e0 ELSE 0e0 END"
          " + CASE WHEN priority = '1-URGENT' THEN 1.5e0 ELSE 0e0 END"
          " + coalesce(sum_qty, 0e0) / 200e0")
PRED_SQL = f"""
SELECT id, label, p, CAST(p > 0.1e0 AS INTEGER) AS pred
FROM (SELECT id, label, 1e0 / (1e0 + exp(-({_Z_SQL}))) AS p FROM ({fx.ORDER_FEATURES_SQL}))
"""


def scored_orders(spark, sf_dir):
    of = fx.order_features(spark, sf_dir)
    z = (F.lit(-3.0) + F.when(F.col("status") == "P", 2.0).otherwise(0.0)
         + F.when(F.col("priority") == "1-URGENT", 1.5).otherwise(0.0)
         + F.coalesce(F.col("sum_qty"), F.lit(0.0)) / 200.0)
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
    return of.select("id", "label", p.alias("p")).withColumn("pred", metrics.threshold("p", 0.1))


@query("threshold_predictions", sql=f"SELECT id, label, round(p, 6) AS p, pred FROM ({PRED_SQL})")
def threshold_predictions(spark, sf_dir):
    return scored_orders(spark, sf_dir).select("id", "label", r6("p").alias("p"), "pred")


@query("confusion_matrix", sql=f"""
WITH s AS ({PRED_SQL})
SELECT 0 AS y, 0 AS pred, count(*) FILTER (WHERE label = 0 AND pred = 0) AS n FROM s
UNION ALL SELECT 0, 1, count(*) FILTER (WHERE label = 0 AND pred = 1) FROM s
UNION ALL SELECT 1, 0, count(*) FILTER (WHERE label = 1 AND pred = 0) FROM s
UNION ALL SELECT 1, 1, count(*) FILTER (WHERE label = 1 AND pred = 1) FROM s
""")
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(scored_orders(spark, sf_dir), "label", "pred")


_COUNTS_SQL = f"""
SELECT count(*) FILTER (WHERE label = 0 AND pred = 0) * 1e0 AS tn,
       count(*) FILTER (WHERE label = 0 AND pred = 1) * 1e0 AS fp,
       count(*) FILTER (WHERE label = 1 AND pred = 0) * 1e0 AS fn,
       count(*) FILTER (WHERE label = 1 AND pred = 1) * 1e0 AS tp
FROM ({PRED_SQL})
"""


@query("binary_metrics", sql=f"""
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1
FROM ({_COUNTS_SQL})
""")
def binary_metrics(spark, sf_dir):
    m = metrics.binary_metrics(scored_orders(spark, sf_dir), "label", "pred")
    return m.select(*[r6(c).alias(c) for c in m.columns])


@query("class_report", sql=f"""
WITH c AS ({_COUNTS_SQL}),
k AS (SELECT *, coalesce(tn / nullif(tn + fn, 0), 0) AS p0, coalesce(tn / nullif(tn + fp, 0), 0) AS r0,
             coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0) AS f0,
             coalesce(tp / nullif(tp + fp, 0), 0) AS p1, coalesce(tp / nullif(tp + fn, 0), 0) AS r1,
             coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1,
             tn + fp AS s0, tp + fn AS s1, tn + fp + fn + tp AS n FROM c)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1,
       CAST(s0 AS BIGINT) AS support FROM k
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1, 6), CAST(s1 AS BIGINT) FROM k
UNION ALL SELECT 'accuracy', NULL, NULL, round((tp + tn) / n, 6), CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6),
                 CAST(n AS BIGINT) FROM k
UNION ALL SELECT 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
                 round((f0 * s0 + f1 * s1) / n, 6), CAST(n AS BIGINT) FROM k
""")
def class_report(spark, sf_dir):
    r = metrics.class_report(scored_orders(spark, sf_dir), "label", "pred")
    return r.select("class", r6("precision").alias("precision"), r6("recall").alias("recall"),
                    r6("f1").alias("f1"), F.col("support").cast("long").alias("support"))


# Ranking metrics over a heavily tied score ---------------------------------------
_CURVE_SQL = f"""
WITH g AS (SELECT score, sum(y) AS tp, sum(1 - y) AS fp FROM ({fx.LINE_SCORES_SQL}) GROUP BY score),
c AS (SELECT score, tp, fp,
             sum(tp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ctp,
             sum(fp) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS cfp FROM g),
t AS (SELECT sum(tp) AS P, sum(fp) AS N FROM g),
pts AS (SELECT score, ctp, cfp, ctp - tp AS ptp, cfp - fp AS pfp, P, N,
               ctp * 1e0 / (ctp + cfp) AS prec, ctp * 1e0 / P AS rec FROM c, t)
"""


@query("pr_curve", sql=_CURVE_SQL + """
SELECT round(score, 6) AS threshold, round(prec, 6) AS precision, round(rec, 6) AS recall FROM pts
UNION ALL SELECT NULL, 1e0, 0e0
""")
def pr_curve(spark, sf_dir):
    c = metrics.pr_curve(fx.line_scores(spark, sf_dir), "y", "score")
    return c.select(r6("threshold").alias("threshold"), r6("precision").alias("precision"),
                    r6("recall").alias("recall"))


@query("pr_auc", sql=_CURVE_SQL + """
SELECT round(sum((rec - prev_rec) * (prec + prev_prec) / 2e0), 6) AS pr_auc
FROM (SELECT prec, rec,
             CASE WHEN ptp + pfp = 0 THEN 1e0 ELSE ptp * 1e0 / (ptp + pfp) END AS prev_prec,
             ptp * 1e0 / P AS prev_rec FROM pts)
""")
def pr_auc(spark, sf_dir):
    return metrics.pr_auc(fx.line_scores(spark, sf_dir), "y", "score").select(r6("pr_auc").alias("pr_auc"))


@query("roc_auc", sql=_CURVE_SQL + """
SELECT round(sum((cfp - pfp) * (ctp + ptp) / 2e0) / (max(P) * 1e0 * max(N)), 6) AS roc_auc FROM pts
""")
def roc_auc(spark, sf_dir):
    return metrics.roc_auc(fx.line_scores(spark, sf_dir), "y", "score").select(r6("roc_auc").alias("roc_auc"))


# Gaps in label and score: such rows are in no metric ---------------------------------
_GAPS_SQL = f"""
SELECT CASE WHEN l_linenumber = 3 AND l_orderkey % 5 = 0 THEN NULL ELSE y END AS y,
       CASE WHEN l_linenumber = 2 AND l_orderkey % 3 = 0 THEN NULL ELSE score END AS score,
       l_linenumber AS trial
FROM ({fx.LINE_SCORES_SQL})
"""


def gappy_scores(spark, sf_dir):
    ls = fx.line_scores(spark, sf_dir)
    no_label = (F.col("l_linenumber") == 3) & (F.col("l_orderkey") % 5 == 0)
    no_score = (F.col("l_linenumber") == 2) & (F.col("l_orderkey") % 3 == 0)
    nan = F.lit(float("nan"))
    # Half of the missing scores are NaN, half NULL: both are gaps.
    gap = F.when(F.col("l_orderkey") % 2 == 0, nan)
    return ls.select(F.when(~no_label, F.col("y")).alias("y"),
                     F.when(no_score, gap).otherwise(F.col("score")).alias("score"),
                     F.col("l_linenumber").alias("trial"))


_TRIAL_SQL = f"""
WITH u AS (SELECT * FROM ({_GAPS_SQL}) WHERE y IS NOT NULL AND score IS NOT NULL),
g AS (SELECT trial, score, sum(y) AS tp, sum(1 - y) AS fp FROM u GROUP BY trial, score),
c AS (SELECT *, sum(tp) OVER w AS ctp, sum(fp) OVER w AS cfp FROM g
      WINDOW w AS (PARTITION BY trial ORDER BY score DESC ROWS UNBOUNDED PRECEDING)),
t AS (SELECT trial, sum(tp) AS P, sum(fp) AS N FROM g GROUP BY trial),
a AS (SELECT trial, sum((cfp - (cfp - fp)) * (ctp + ctp - tp) / 2e0) / max(P * 1e0 * N) AS roc_auc,
             sum(tp * (ctp * 1e0 / (ctp + cfp) + CASE WHEN ctp - tp + cfp - fp = 0 THEN 1e0
                       ELSE (ctp - tp) * 1e0 / (ctp - tp + cfp - fp) END) / 2e0) / max(P) AS pr_auc
      FROM c JOIN t USING (trial) GROUP BY trial),
m AS (SELECT trial, count(*) FILTER (WHERE y = 0 AND score <= 0.5e0) * 1e0 AS tn,
             count(*) FILTER (WHERE y = 0 AND score > 0.5e0) * 1e0 AS fp,
             count(*) FILTER (WHERE y = 1 AND score <= 0.5e0) * 1e0 AS fn,
             count(*) FILTER (WHERE y = 1 AND score > 0.5e0) * 1e0 AS tp FROM u GROUP BY trial)
SELECT trial, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1,
       round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc
FROM m JOIN a USING (trial)
"""


@query("metrics_by_trial", sql=_TRIAL_SQL)
def metrics_by_trial(spark, sf_dir):
    """MET10 + MET11: the sweep table, one row per trial."""
    t = metrics.metrics_table(gappy_scores(spark, sf_dir), "y", "score", 0.5, by=["trial"])
    return t.select("trial", *[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")])


@query("rows_left_out", sql=f"""
SELECT count(*) AS n, count(*) FILTER (WHERE y IS NULL) AS no_label,
       count(*) FILTER (WHERE y IS NOT NULL AND score IS NULL) AS no_score FROM ({_GAPS_SQL})
""")
def rows_left_out(spark, sf_dir):
    return metrics.left_out(gappy_scores(spark, sf_dir), "y", "score")


@query("log_loss", sql=f"""
SELECT round(avg(-(y * ln(pc) + (1 - y) * ln(1e0 - pc))), 6) AS log_loss
FROM (SELECT y, least(greatest(score, 1e-15), 1e0 - 1e-15) AS pc FROM ({fx.LINE_SCORES_SQL}))
""")
def log_loss(spark, sf_dir):
    return metrics.log_loss(fx.line_scores(spark, sf_dir), "y", "score").select(r6("log_loss").alias("log_loss"))
