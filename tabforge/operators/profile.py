"""Profiling: AGG1-AGG6, AGG11, RPT4, RPT5.

Every profile is a single aggregate with map-side partial aggregation. What is
counted per column goes through one array of the row's cells and a group per
position, so the plan does not grow with the number of columns (thousands) and
nothing per-row reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.DoubleType, T.FloatType)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def is_missing(df: DataFrame, name: str) -> Column:
    """``isna`` semantics: NULL, and NaN for float columns."""
    c = _q(name)
    if isinstance(df.schema[name].dataType, _FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def long_cells(df: DataFrame, cells: list[Column], names: list[str], keep: list[str] | None = None,
               name_col: str = "feature") -> DataFrame:
    """``(keep..., feature, value)``: one row per cell. The name is looked up in a
    constant array by the cell's position."""
    constant = F.array(*[F.lit(n) for n in names])
    long = df.select(*[_q(k) for k in keep or []], F.posexplode(F.array(*cells)).alias("_i", "value"))
    return long.select(*[_q(k) for k in keep or []], F.element_at(constant, F.col("_i") + 1).alias(name_col), "value")


def numeric_cells(df: DataFrame, cols: list[str]) -> list[Column]:
    """The cells as doubles, NaN as NULL."""
    out = []
    for c in cols:
        x = _q(c).cast("double")
        out.append(F.nanvl(x, F.lit(None).cast("double")) if isinstance(df.schema[c].dataType, _FLOATS) else x)
    return out


def label_distribution(df: DataFrame, label: str) -> DataFrame:
    """AGG1: ``value_counts`` — count per label value, NULL excluded,
    descending by count (label as tie-break)."""
    return label_counts(df, label).orderBy(F.desc("n"), _q(label))


def label_counts(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """RPT5 with ``by=["split"]``: rows per label value (and split), one scan."""
    keys = [_q(c) for c in [*(by or []), label]]
    return df.filter(~is_missing(df, label)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """AGG2/LRN3: negatives, positives and ``n_neg / n_pos`` (NULL without
    positives)."""
    y = _q(label)
    return df.agg(
        F.count_if(y == 0).alias("n_neg"),
        F.count_if(y == 1).alias("n_pos"),
    ).withColumn("scale_pos_weight", F.try_divide(F.col("n_neg").cast("double"), F.col("n_pos")))


def missing_counts(df: DataFrame, cols: list[str] | None = None,
                   name_col: str = "column_name", count_col: str = "n_missing",
                   only_missing: bool = True, by: list[str] | None = None) -> DataFrame:
    """AGG4 (+FLT2, RPT4): ``(by..., column, n_missing)``, optionally only the
    columns with gaps; with ``by=["split"]`` every split in one scan."""
    cols = list(cols or [c for c in df.columns if c not in (by or [])])
    flags = [is_missing(df, c).cast("long") for c in cols]
    long = long_cells(df, flags, cols, by, name_col).groupBy(*[_q(c) for c in by or []], name_col)
    counts = long.agg(F.sum("value").alias(count_col))
    return counts.filter(F.col(count_col) > 0) if only_missing else counts


def missing_ratios(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AGG4 with ratio: ``(column_name, n_missing, n_rows, missing_ratio)``."""
    cols = list(cols or df.columns)
    long = long_cells(df, [is_missing(df, c).cast("long") for c in cols], cols, name_col="column_name")
    counts = long.groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("value").alias("n_missing"))
    return counts.select("n_rows", "column_name", "n_missing",
                         F.try_divide(F.col("n_missing").cast("double"), F.col("n_rows")).alias("missing_ratio"))


def missing_total(df: DataFrame, cols: list[str] | None = None) -> Column:
    """AGG6: total missing cells as one aggregate expression."""
    flags = F.array(*[is_missing(df, c) for c in (cols or df.columns)])
    return F.sum(F.size(F.filter(flags, lambda x: x)).cast("long"))


def missing_total_by_split(df: DataFrame, cols: list[str] | None = None, split: str = "split") -> DataFrame:
    """AGG6 per split: ``(split, total_missing)`` of a table with a split flag."""
    cols = list(cols or [c for c in df.columns if c != split])
    return df.groupBy(split).agg(missing_total(df, cols).alias("total_missing"))


def shape(df: DataFrame) -> DataFrame:
    """AGG3: one row ``(n_rows, n_columns)``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))
