"""Queries: fills, imputers, scaler, drop rule, category dictionary/encoding,
the full missing plan (SCL1-SCL3, AGG7-AGG10, FEA1-FEA5, FEA9-FEA10, FEA2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, sample
from ..operators.encode import CategoryEncoder
from ..operators.profile import missing_ratios
from ..sources.tables import read_table
from . import fixtures as fx
from .registry import query, r6, split_sql

OF = fx.ORDER_FEATURES_SQL
OF_SPLIT = split_sql(OF, "id")


def _of_split(spark, sf_dir):
    return sample.split_exact(fx.order_features(spark, sf_dir), "id", 0.8, 42)


# SCL1 ------------------------------------------------------------------------
@query("fill_zero", sql=f"""
SELECT id, round(coalesce(avg_discount, 0e0), 6) AS avg_discount, round(coalesce(max_tax, 0e0), 6) AS max_tax,
       coalesce(n_lines, 0) AS n_lines
FROM ({OF})
""")
def fill_zero(spark, sf_dir):
    of = fx.order_features(spark, sf_dir).select("id", "avg_discount", "max_tax", "n_lines")
    f = prep.fill_zero(of, ["avg_discount", "max_tax", "n_lines"])
    return f.select("id", r6("avg_discount").alias("avg_discount"), r6("max_tax").alias("max_tax"), "n_lines")


# SCL2 ------------------------------------------------------------------------
@query("fill_sentinel", sql=f"""
SELECT id, round(coalesce(max_tax, 999999e0), 6) AS max_tax FROM ({OF})
""")
def fill_sentinel(spark, sf_dir):
    of = fx.order_features(spark, sf_dir).select("id", "max_tax")
    return prep.fill_sentinel(of, ["max_tax"]).select("id", r6("max_tax").alias("max_tax"))


# SCL3 ------------------------------------------------------------------------
@query("fill_missing_token", sql=f"SELECT id, coalesce(priority, 'MISSING') AS priority FROM ({OF})")
def fill_missing_token(spark, sf_dir):
    of = fx.order_features(spark, sf_dir).select("id", "priority")
    return prep.fill_token(of, ["priority"])


# AGG7 ------------------------------------------------------------------------
_NUM = fx.ORDER_NUMERIC


@query("median_values", sql="\nUNION ALL\n".join(
    f"SELECT '{c}' AS feature, round(median({c}), 6) AS median, count({c}) AS n FROM ({OF_SPLIT}) WHERE split = 'train'"
    for c in _NUM))
def median_values(spark, sf_dir):
    from ..operators.quantiles import exact_medians
    train, _ = _of_split(spark, sf_dir)
    m = exact_medians(train, _NUM)
    return m.select("feature", r6("median").alias("median"), "n")


# FEA3 ------------------------------------------------------------------------
_GAPPY = ["n_lines", "sum_qty", "avg_discount", "max_tax"]  # gaps in train; total_price has none


@query("median_impute", sql=f"""
WITH s AS ({OF_SPLIT}),
m AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in _GAPPY)} FROM s WHERE split = 'train')
SELECT id, {', '.join(f'round(coalesce(CAST({c} AS DOUBLE), m_{c}), 6) AS {c}' for c in _GAPPY)},
       round(total_price, 6) AS total_price
FROM s, m WHERE split = 'val'
""")
def median_impute(spark, sf_dir):
    train, val = _of_split(spark, sf_dir)
    model = prep.fit_median_imputer(train, _NUM)
    out = model.transform(val.select("id", *_NUM))
    return out.select("id", *[r6(c).alias(c) for c in _NUM])


# FEA4 ------------------------------------------------------------------------
@query("mean_impute", sql=f"""
WITH s AS ({OF_SPLIT}),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}' for c in _NUM)} FROM s WHERE split = 'train')
SELECT id, {', '.join(f'round(coalesce(CAST({c} AS DOUBLE), m_{c}), 6) AS {c}' for c in _NUM)}
FROM s, m WHERE split = 'val'
""")
def mean_impute(spark, sf_dir):
    train, val = _of_split(spark, sf_dir)
    model = prep.fit_mean_imputer(train, _NUM)
    out = model.transform(val.select("id", *_NUM))
    return out.select("id", *[r6(c).alias(c) for c in _NUM])


# FEA5 ------------------------------------------------------------------------
_SCALE = ["total_price", "sum_qty", "n_lines"]


@query("standardize_pop", sql=f"""
WITH s AS ({OF_SPLIT}),
m AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALE)}
      FROM s WHERE split = 'train')
SELECT id, {', '.join(f'round(({c} - m_{c}) / CASE WHEN s_{c} > 0 THEN s_{c} ELSE 1e0 END, 6) AS {c}' for c in _SCALE)}
FROM s, m WHERE split = 'val'
""")
def standardize_pop(spark, sf_dir):
    train, val = _of_split(spark, sf_dir)
    model = prep.fit_standard_scaler(train, _SCALE)
    out = model.transform(val.select("id", *_SCALE))
    return out.select("id", *[r6(c).alias(c) for c in _SCALE])


# FEA1 ------------------------------------------------------------------------
_DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", "source_gap"]


@query("drop_high_missing", sql="\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column_name, round(count(*) FILTER (WHERE {c} IS NULL) * 1e0 / count(*), 6) AS missing_ratio,
       count(*) FILTER (WHERE {c} IS NULL) * 1e0 / count(*) > 0.5e0 AS dropped
FROM (SELECT *, NULLIF(source, 'src0') AS source_gap FROM ({fx.DOC_LABELS_SQL}))""" for c in _DOC_COLS))
def drop_high_missing(spark, sf_dir):
    dl = fx.doc_labels(spark, sf_dir).withColumn("source_gap", F.nullif(F.col("source"), F.lit("src0")))
    r = missing_ratios(dl, _DOC_COLS)
    return r.select("column_name", r6("missing_ratio").alias("missing_ratio"),
                    (F.col("missing_ratio") > 0.5).alias("dropped"))


# AGG10 / FEA9 / FEA10 ----------------------------------------------------------
_PART_SQL = """
SELECT p_partkey, p_name, p_brand, p_type, 'S' || CAST(p_size AS VARCHAR) AS size_band FROM part
"""
_CATS = ["p_brand", "p_type", "size_band"]
_PART_SPLIT = split_sql(_PART_SQL, "p_partkey")


def _parts(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    p = p.select("p_partkey", "p_name", "p_brand", "p_type",
                 F.concat(F.lit("S"), F.col("p_size").cast("string")).alias("size_band"))
    return sample.split_exact(p, "p_partkey", 0.8, 42)


def _dict_sql(cols):
    arms = "\nUNION ALL\n".join(f"SELECT DISTINCT '{c}' AS feature, {c} AS value FROM s WHERE split = 'train'"
                                for c in cols)
    return f"""WITH s AS ({_PART_SPLIT}), d AS ({arms})
SELECT feature, value, CAST(row_number() OVER (PARTITION BY feature ORDER BY value) - 1 AS INTEGER) AS code FROM d"""


@query("category_dictionary", sql=_dict_sql(_CATS))
def category_dictionary(spark, sf_dir):
    train, _ = _parts(spark, sf_dir)
    return CategoryEncoder(_CATS).fit(train).dictionary


@query("category_encode", sql=f"""
WITH dd AS ({_dict_sql(_CATS)}), s AS ({_PART_SPLIT})
SELECT s.p_partkey, {', '.join(f'd_{c}.code AS {c}' for c in _CATS)}
FROM s {' '.join(f"LEFT JOIN (SELECT value, code FROM dd WHERE feature = '{c}') d_{c} ON s.{c} = d_{c}.value" for c in _CATS)}
WHERE s.split = 'val'
""")
def category_encode(spark, sf_dir):
    train, val = _parts(spark, sf_dir)
    model = CategoryEncoder(_CATS).fit(train)
    return model.transform(val.select("p_partkey", *_CATS))


_UNSEEN = _CATS + ["p_name"]


@query("unseen_categories", sql=f"""
WITH s AS ({_PART_SPLIT})
{' UNION ALL '.join(f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM s WHERE split = 'train' AND {c} IS NOT NULL)) AS n_unseen FROM s WHERE split = 'val'" for c in _UNSEEN)}
""")
def unseen_categories(spark, sf_dir):
    train, val = _parts(spark, sf_dir)
    model = CategoryEncoder(_UNSEEN, lookup="join").fit(train)
    return model.unseen_counts(val)


# FEA2 ------------------------------------------------------------------------
def order_plan() -> prep.MissingPlan:
    """The plan used on the order features: drop ``total_price``; zero-fill
    the ``discount`` columns; sentinel for ``max_tax``; median for other
    numeric gaps; 'MISSING' for categorical gaps."""
    return prep.MissingPlan(exclude=["id", "label"], drop_cols=["total_price", "not_a_column"],
                            zero_contains=["discount"], sentinel_cols=["max_tax"],
                            categorical_cols=["status", "priority"])


@query("missing_plan_full", sql=f"""
WITH s AS ({OF_SPLIT}),
m AS (SELECT median(n_lines) AS m_n_lines, median(sum_qty) AS m_sum_qty FROM s WHERE split = 'train')
SELECT id, label, round(coalesce(CAST(n_lines AS DOUBLE), m_n_lines), 6) AS n_lines,
       round(coalesce(sum_qty, m_sum_qty), 6) AS sum_qty,
       round(coalesce(avg_discount, 0e0), 6) AS avg_discount,
       round(coalesce(max_tax, 999999e0), 6) AS max_tax,
       status, coalesce(priority, 'MISSING') AS priority
FROM s, m WHERE split = 'val'
""")
def missing_plan_full(spark, sf_dir):
    train, val = _of_split(spark, sf_dir)
    model = order_plan().fit(train)
    out = model.transform(val)
    return out.select("id", "label", r6("n_lines").alias("n_lines"), r6("sum_qty").alias("sum_qty"),
                      r6("avg_discount").alias("avg_discount"), r6("max_tax").alias("max_tax"),
                      "status", "priority")
