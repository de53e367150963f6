"""Importance-driven feature selection: LRN7, WIN1, WIN3, FLT3, SRT1-SRT2,
FEA13-FEA14.

The cut is the reference's: rank by importance (descending; the feature
name breaks ties, which the reference leaves to its sort), keep features
whose cumulative share is ``<= threshold``, then apply a floor (take the top
``min_features``) or a cap (top ``max_features``). Importances are
non-negative, so the kept set is always a prefix of the ranking: the result
is ``rank < k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .running import ranked_running_sum


def importance_table(spark: SparkSession, names: list[str], importances) -> DataFrame:
    """LRN7/RPT2: ``(feature, importance)`` from a fitted model's importance
    vector (one value per feature; bounded by the table width)."""
    vals = importances.toArray().tolist() if hasattr(importances, "toArray") else list(importances)
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, vals)], schema)


def cumulative_selection(imp: DataFrame, threshold: float = 0.99, min_features: int = 50,
                         max_features: int = 2000, feature: str = "feature",
                         importance: str = "importance") -> DataFrame:
    """FEA13 (WIN1, WIN3, AGG12 total, FLT3, SRT2):
    ``(feature, importance, rank, cumulative_ratio, selected)``."""
    ranked = ranked_running_sum(imp.select(feature, F.col(importance).cast("double").alias(importance)),
                                importance, feature)
    ranked = ranked.withColumn("cumulative_ratio", F.try_divide(F.col("cum"), F.col("total")))
    n_sel = ranked.filter(F.col("cumulative_ratio") <= F.lit(float(threshold))).count()
    if n_sel < min_features:
        k = min_features
    elif n_sel > max_features:
        k = max_features
    else:
        k = n_sel
    return ranked.select(feature, importance, "rank", "cumulative_ratio",
                         (F.col("rank") < F.lit(k)).alias("selected"))


def selected_names(sel: DataFrame, feature: str = "feature") -> list[str]:
    """The selected feature names in rank order (bounded by the width)."""
    return [r[feature] for r in sel.filter("selected").orderBy("rank").select(feature).collect()]
