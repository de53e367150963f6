"""Classification metrics as SQL aggregates: MET1-MET11, PRJ10.

Threshold metrics (confusion matrix, accuracy, P/R/F1, per-class report) are
one aggregate over the scored rows. Ranking metrics (PR curve, PR-AUC,
ROC-AUC) need running totals over the scores in descending order; they are
computed without a single-task global window:

* rows are first reduced to one row per distinct score (``groupBy``, map-side
  combined — a hot score value becomes one row);
* distinct scores are cut into ~``n_buckets`` ranges at approximate quantiles
  (a bounded list of cut points) and bucketed JVM-side (binary search);
* per-bucket totals (bounded table) give each bucket's offset; the running sum
  inside a bucket is a window partitioned by bucket.

Conventions (chosen to equal the reference's library): precision 0/0 -> 0,
PR curve anchored at (recall 0, precision 1), trapezoids for both AUCs,
ROC-AUC NULL when only one class is present, strict ``>`` thresholding.

One rule for gaps in all metrics: a row counts when it has a label and a score
(or prediction); rows with a NULL label or a NULL or NaN score are in no
metric, and ``left_out`` counts them.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_EPS = 1e-15


def threshold(p: Column | str, thr: float) -> Column:
    """PRJ10 + SCL4: ``(p > thr)`` as 0/1 int (strict, like the reference)."""
    p = F.col(p) if isinstance(p, str) else p
    return (p > F.lit(float(thr))).cast("int")


def positive_probability(prob_col: str = "probability") -> Column:
    """PRJ12: second component of an MLlib probability vector."""
    from pyspark.ml.functions import vector_to_array
    return vector_to_array(F.col(prob_col)).getItem(1)


def _present(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    floats = df.schema[name].dataType.simpleString() in ("double", "float")
    return c.isNotNull() & ~F.isnan(c) if floats else c.isNotNull()


def usable(df: DataFrame, y: str, score: str) -> DataFrame:
    """The rows that count in a metric: label and score present."""
    return df.filter(_present(df, y) & _present(df, score))


def left_out(df: DataFrame, y: str, score: str) -> DataFrame:
    """One row: rows in all, without a label, and with a label but no score."""
    label, value = _present(df, y), _present(df, score)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(~label).alias("no_label"),
                  F.count_if(label & ~value).alias("no_score"))


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, y: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """tn, fp, fn, tp (one row per ``by`` group)."""
    yy, pp = F.col(y), F.col(pred)
    aggs = [F.count_if((yy == 0) & (pp == 0)).alias("tn"), F.count_if((yy == 0) & (pp == 1)).alias("fp"),
            F.count_if((yy == 1) & (pp == 0)).alias("fn"), F.count_if((yy == 1) & (pp == 1)).alias("tp")]
    return df.groupBy(*(by or [])).agg(*aggs)


def confusion_matrix(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MET1: full 2x2 grid ``(y, pred, n)``; absent cells are 0."""
    return confusion_counts(df, y, pred).selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (y, pred, n)")


def _metric_cols(tn: Column, fp: Column, fn: Column, tp: Column) -> list[Column]:
    n = tn + fp + fn + tp
    precision = _safe_div(tp, tp + fp)
    recall = _safe_div(tp, tp + fn)
    return [
        _safe_div(tp + tn, n).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _safe_div(2 * tp, 2 * tp + fp + fn).alias("f1"),
    ]


def binary_metrics(df: DataFrame, y: str, pred: str, by: list[str] | None = None) -> DataFrame:
    """MET2, MET3, MET4: accuracy, precision, recall, F1 of the positive class
    (0/0 -> 0)."""
    c = confusion_counts(df, y, pred, by)
    return c.select(*(by or []), *_metric_cols(F.col("tn"), F.col("fp"), F.col("fn"), F.col("tp")))


def class_report(df: DataFrame, y: str, pred: str) -> DataFrame:
    """MET5: per-class precision/recall/F1/support plus accuracy, macro and
    weighted averages (rows ``0``, ``1``, ``accuracy``, ``macro avg``,
    ``weighted avg``)."""
    c = confusion_counts(df, y, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    s1, s0 = tp + fn, tn + fp
    p1, r1 = _safe_div(tp, tp + fp), _safe_div(tp, tp + fn)
    p0, r0 = _safe_div(tn, tn + fn), _safe_div(tn, tn + fp)
    f1_1 = _safe_div(2 * tp, 2 * tp + fp + fn)
    f1_0 = _safe_div(2 * tn, 2 * tn + fn + fp)
    n = s0 + s1
    acc = _safe_div(tp + tn, n)
    wide = c.select(
        p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"),
        acc.alias("acc"), n.alias("n"),
        ((p0 + p1) / 2).alias("mp"), ((r0 + r1) / 2).alias("mr"), ((f1_0 + f1_1) / 2).alias("mf"),
        _safe_div(p0 * s0 + p1 * s1, n).alias("wp"), _safe_div(r0 * s0 + r1 * s1, n).alias("wr"),
        _safe_div(f1_0 * s0 + f1_1 * s1, n).alias("wf"),
    )
    return wide.selectExpr(
        "stack(5, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, "
        "'accuracy', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), acc, n, "
        "'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n) "
        "as (class, precision, recall, f1, support)")


def score_curve(df: DataFrame, y: str, score: str, by: list[str] | None = None,
                weight: str | None = None, n_buckets: int = 1024) -> DataFrame:
    """Running totals over distinct scores, descending, per ``by`` group.

    Returns ``(by..., score, tp, fp, cum_tp, cum_fp, prev_tp, prev_fp)`` where
    ``prev_*`` are the totals of the previous (higher) distinct score, 0 for
    the first point.
    """
    by = list(by or [])
    w = F.col(weight).cast("double") if weight else F.lit(1)
    yy = F.col(y)
    distinct = (usable(df, y, score)
                .groupBy(*by, F.col(score).alias("score"))
                .agg(F.sum(F.when(yy == 1, w).otherwise(0)).alias("tp"),
                     F.sum(F.when(yy == 1, 0).otherwise(w)).alias("fp")))
    # Cut points at approximate quantiles of the distinct scores: a bounded
    # list whose only role is balancing the buckets (exactness never depends
    # on it).
    probs = [i / n_buckets for i in range(1, n_buckets)]
    cuts = distinct.approxQuantile("score", probs, 1.0 / (4 * n_buckets))
    splits = sorted(set(float(c) for c in cuts if c is not None))
    splits = [float("-inf")] + splits + [float("inf")]
    bucketed = Bucketizer(splits=splits, inputCol="score", outputCol="_bkt").transform(distinct)
    bucketed = bucketed.withColumn("_bkt", F.col("_bkt").cast("int"))

    totals = bucketed.groupBy(*by, "_bkt").agg(F.sum("tp").alias("_btp"), F.sum("fp").alias("_bfp"))
    wo = (Window.partitionBy(*by).orderBy(F.desc("_bkt")) if by else Window.orderBy(F.desc("_bkt")))
    wo = wo.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_bkt",
                            F.coalesce(F.sum("_btp").over(wo), F.lit(0)).alias("_otp"),
                            F.coalesce(F.sum("_bfp").over(wo), F.lit(0)).alias("_ofp"))
    # offsets: one row per (group, bucket) -- bounded by groups x n_buckets.
    joined = bucketed.join(offsets, on=[*by, "_bkt"], how="inner")
    wi = Window.partitionBy(*by, "_bkt").orderBy(F.desc("score"))
    run = wi.rowsBetween(Window.unboundedPreceding, 0)
    cum_tp = F.col("_otp") + F.sum("tp").over(run)
    cum_fp = F.col("_ofp") + F.sum("fp").over(run)
    return (joined.select(*by, "score", "tp", "fp", cum_tp.alias("cum_tp"), cum_fp.alias("cum_fp"))
            .withColumn("prev_tp", F.col("cum_tp") - F.col("tp"))
            .withColumn("prev_fp", F.col("cum_fp") - F.col("fp")))


def pr_curve(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """MET7: one point per distinct score ``(threshold, precision, recall)``, and
    the end point (recall 0, precision 1) with a NULL threshold."""
    by = list(by or [])
    curve = score_curve(df, y, score, by)
    # Total positives per group: the curve's last running total.
    totals = curve.groupBy(*by).agg(F.max("cum_tp").alias("_P"))
    c = curve.join(totals, on=by) if by else _one_row_join(curve, totals)
    points = c.select(*by, F.col("score").alias("threshold"),
                      _safe_div(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp")).alias("precision"),
                      _recall(F.col("cum_tp"), F.col("_P")).alias("recall"))
    end = totals.filter(F.col("_P").isNotNull()).select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.withColumn("threshold", F.col("threshold").cast("double")).unionByName(end)


def _recall(cum_tp: Column, total_pos: Column) -> Column:
    # No positive at all: recall is 1 everywhere (reference's library convention).
    return F.when(total_pos == 0, F.lit(1.0)).otherwise(cum_tp.cast("double") / total_pos)


def curve_metrics(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """MET6 + MET8/MET10 from one pass over one curve: ``roc_auc`` (ties as
    diagonal segments; NULL with one class only) and ``pr_auc`` (trapezoids,
    anchored at recall 0, precision 1) per ``by`` group. Areas are summed
    unscaled and divided by the class totals of the same aggregate."""
    by = list(by or [])
    c = score_curve(df, y, score, by)
    prec = _safe_div(F.col("cum_tp"), F.col("cum_tp") + F.col("cum_fp"))
    prev_prec = F.when(F.col("prev_tp") + F.col("prev_fp") == 0, F.lit(1.0)).otherwise(
        _safe_div(F.col("prev_tp"), F.col("prev_tp") + F.col("prev_fp")))
    roc_area = (F.col("cum_fp") - F.col("prev_fp")) * (F.col("cum_tp") + F.col("prev_tp")) / 2.0
    pr_area = (F.col("cum_tp") - F.col("prev_tp")).cast("double") * (prec + prev_prec) / 2
    sums = c.groupBy(*by).agg(F.sum("tp").alias("_P"), F.sum("fp").alias("_N"),
                              F.sum(roc_area).alias("_roc"), F.sum(pr_area).alias("_pr"))
    roc = F.when((F.col("_P") > 0) & (F.col("_N") > 0), F.col("_roc") / (F.col("_P").cast("double") * F.col("_N")))
    # Without a positive the recall is 1 from the first point on, at precision 0.
    pr = F.when(F.col("_P") == 0, F.lit(0.5)).otherwise(F.col("_pr") / F.col("_P"))
    return sums.select(*by, roc.alias("roc_auc"), pr.alias("pr_auc"))


def pr_auc(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """MET8/MET10: area under the PR curve; one row (per ``by`` group)."""
    return curve_metrics(df, y, score, by).drop("roc_auc")


def roc_auc(df: DataFrame, y: str, score: str, by: list[str] | None = None) -> DataFrame:
    """MET6: area under the ROC curve; one row (per ``by`` group)."""
    return curve_metrics(df, y, score, by).drop("pr_auc")


def log_loss(df: DataFrame, y: str, p: str, by: list[str] | None = None,
             weight: str | None = None, eps: float = LOG_EPS) -> DataFrame:
    """MET9: mean (weighted) negative log-likelihood, probabilities clipped
    to ``[eps, 1 - eps]``."""
    pc = F.least(F.greatest(F.col(p).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    yy = F.col(y).cast("double")
    ll = -(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))
    df = usable(df, y, p)
    if weight:
        w = F.col(weight).cast("double")
        return df.groupBy(*(by or [])).agg((F.sum(w * ll) / F.sum(w)).alias("log_loss"))
    return df.groupBy(*(by or [])).agg(F.avg(ll).alias("log_loss"))


def metrics_table(df: DataFrame, y: str, p: str, thr: float, by: list[str] | None = None) -> DataFrame:
    """MET11: accuracy, F1, precision, recall (at ``thr``) and ROC-AUC, PR-AUC
    for every ``by`` group (a trial, a round) in one table."""
    by = list(by or [])
    scored = usable(df, y, p).withColumn("_pred", threshold(F.col(p), thr))
    base = binary_metrics(scored, y, "_pred", by)
    areas = curve_metrics(df, y, p, by)
    return base.join(areas, by) if by else _one_row_join(base, areas)


def _one_row_join(*dfs: DataFrame) -> DataFrame:
    """Attach one-row tables to a table (equi-join on a constant key with a
    one-row broadcast side)."""
    out = dfs[0].withColumn("_one", F.lit(1))
    for d in dfs[1:]:
        out = out.join(F.broadcast(d.withColumn("_one", F.lit(1))), "_one")
    return out.drop("_one")
