"""Queries: profiling, sampling and splits (AGG1-AGG6, RPT4-RPT5, SMP1-SMP4,
JON1, SET1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile, sample
from ..sources.tables import read_table
from . import fixtures as fx
from .registry import query, split_sql


# AGG1 ----------------------------------------------------------------------
@query("label_distribution", sql="""
SELECT 'quality' AS label_col, quality AS label, count(*) AS n FROM labels WHERE quality IS NOT NULL GROUP BY quality
UNION ALL
SELECT 'toxic' AS label_col, toxic AS label, count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic
""")
def label_distribution(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    q = profile.label_distribution(lab, "quality").select(F.lit("quality").alias("label_col"),
                                                         F.col("quality").alias("label"), "n")
    t = profile.label_distribution(lab, "toxic").select(F.lit("toxic").alias("label_col"),
                                                       F.col("toxic").alias("label"), "n")
    return q.unionByName(t)


# AGG2 / LRN3 ------------------------------------------------------------------
@query("class_weight_ratio", sql="""
SELECT count(*) FILTER (WHERE toxic = 0) AS n_neg,
       count(*) FILTER (WHERE toxic = 1) AS n_pos,
       round(count(*) FILTER (WHERE toxic = 0) * 1e0 / nullif(count(*) FILTER (WHERE toxic = 1), 0), 6)
         AS scale_pos_weight
FROM labels
""")
def class_weight_ratio(spark, sf_dir):
    lab = read_table(spark, sf_dir, "labels")
    return profile.class_weight(lab, "toxic").withColumn("scale_pos_weight", F.round("scale_pos_weight", 6))


# RPT5 + SMP1 ----------------------------------------------------------------
@query("label_distribution_by_split", sql=f"""
SELECT split, label, count(*) AS n FROM ({split_sql(fx.ORDER_FEATURES_SQL, 'id')})
WHERE label IS NOT NULL GROUP BY split, label
""")
def label_distribution_by_split(spark, sf_dir):
    flagged = sample.split_flag(fx.order_features(spark, sf_dir), "id", 0.8, 42)
    return profile.label_counts(flagged, "label", by=["split"])


# SMP1 -----------------------------------------------------------------------
_ORDERS_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


@query("split_train", sql=f"""
SELECT {_ORDERS_COLS} FROM ({split_sql('SELECT * FROM orders', 'o_orderkey')}) WHERE split = 'train'
""")
def split_train(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    train, _ = sample.split_exact(orders, "o_orderkey", 0.8, 42)
    return train


# JON1 / SET2 -----------------------------------------------------------------
@query("split_val_anti", sql=f"""
SELECT {_ORDERS_COLS} FROM ({split_sql('SELECT * FROM orders', 'o_orderkey')}) WHERE split = 'val'
""")
def split_val_anti(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders")
    train, _ = sample.split_exact(orders, "o_orderkey", 0.8, 42)
    return sample.anti_complement(orders, train, "o_orderkey")


# SMP3 + SET1 ---------------------------------------------------------------------
@query("downsample_balanced", sql=f"""
WITH l AS (SELECT doc_id, toxic FROM ({fx.DOC_LABELS_SQL}) WHERE toxic IS NOT NULL),
k AS (SELECT count(*) AS k FROM l WHERE toxic = 1),
r AS (SELECT doc_id, toxic,
             row_number() OVER (PARTITION BY toxic ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS rn
      FROM l)
SELECT doc_id, toxic FROM r, k WHERE toxic = 1 OR (toxic = 0 AND rn <= k.k)
""")
def downsample_balanced(spark, sf_dir):
    dl = fx.doc_labels(spark, sf_dir).filter(F.col("toxic").isNotNull()).select("doc_id", "toxic")
    return sample.downsample_majority(dl, "toxic", "doc_id", seed=42)


# SMP4 ----------------------------------------------------------------------------
@query("stratified_half", sql="""
WITH c AS (SELECT o_orderstatus, count(*) AS n, 0.5e0 * count(*) AS share, floor(0.5e0 * count(*)) AS whole
           FROM orders GROUP BY o_orderstatus),
k AS (SELECT o_orderstatus, whole + CAST(row_number() OVER (ORDER BY share - whole DESC, n DESC, o_orderstatus)
             <= (SELECT round_even(0.5e0 * sum(n), 0) - sum(whole) FROM c) AS INTEGER) AS k FROM c),
r AS (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus
                                ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn FROM orders)
SELECT o_orderkey, r.o_orderstatus FROM r JOIN k ON r.o_orderstatus = k.o_orderstatus WHERE rn <= k
""")
def stratified_half(spark, sf_dir):
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return sample.stratified_fraction(orders, "o_orderstatus", "o_orderkey", 0.5, 42)


# SMP2 ------------------------------------------------------------------------------
@query("sample_exact_n", sql="""
SELECT c_custkey, c_mktsegment FROM (
  SELECT c_custkey, c_mktsegment,
         row_number() OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS rn
  FROM customer)
WHERE rn <= 100
""")
def sample_exact_n(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return sample.sample_n(cust, "c_custkey", 100, seed=42)


# AGG4 + FLT2 + RPT4 ----------------------------------------------------------------
_DOC_GAP_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic", "source_gap"]


def _missing_sql(table_sql: str, cols: list[str]) -> str:
    arms = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM t" for c in cols)
    return f"WITH t AS ({table_sql})\nSELECT * FROM ({arms}) WHERE n_missing > 0"


@query("missing_report", sql=_missing_sql(
    f"SELECT *, NULLIF(source, 'src0') AS source_gap FROM ({fx.DOC_LABELS_SQL})", _DOC_GAP_COLS))
def missing_report(spark, sf_dir):
    dl = fx.doc_labels(spark, sf_dir).withColumn("source_gap", F.nullif(F.col("source"), F.lit("src0")))
    return profile.missing_counts(dl, _DOC_GAP_COLS)


# AGG6 ------------------------------------------------------------------------------
_LINE_GAP_SQL = """
SELECT l_orderkey * 100 + l_linenumber AS line_id, l_quantity, l_extendedprice,
       NULLIF(l_discount, 0e0) AS l_discount, NULLIF(l_tax, 0e0) AS l_tax, l_returnflag
FROM lineitem
"""
_LINE_GAP_COLS = ["line_id", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]


def _line_gaps(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line_id"),
                     "l_quantity", "l_extendedprice",
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("l_discount"),
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("l_tax"), "l_returnflag")


@query("missing_total_by_split", sql=f"""
SELECT split, CAST(sum({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in _LINE_GAP_COLS)}) AS BIGINT)
       AS total_missing
FROM ({split_sql(_LINE_GAP_SQL, 'line_id')}) GROUP BY split
""")
def missing_total_by_split(spark, sf_dir):
    lg = _line_gaps(spark, sf_dir)
    return profile.missing_total_by_split(sample.split_flag(lg, "line_id", 0.8, 42), _LINE_GAP_COLS)


# RPT4 per split -----------------------------------------------------------------------
@query("missing_report_by_split", sql=f"""
WITH t AS ({split_sql(_LINE_GAP_SQL, 'line_id')})
SELECT * FROM ({' UNION ALL '.join(
    f"SELECT split, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM t GROUP BY split"
    for c in _LINE_GAP_COLS)}) WHERE n_missing > 0
""")
def missing_report_by_split(spark, sf_dir):
    flagged = sample.split_flag(_line_gaps(spark, sf_dir), "line_id", 0.8, 42)
    return profile.missing_counts(flagged, _LINE_GAP_COLS, by=["split"])


# SET1 --------------------------------------------------------------------------------
@query("concat_splits", sql="SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def concat_splits(spark, sf_dir):
    train, val = sample.split_exact(read_table(spark, sf_dir, "orders"), "o_orderkey", 0.8, 42)
    return sample.concat_rows(train, val).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


# AGG3 --------------------------------------------------------------------------------
@query("table_shape", sql="SELECT count(*) AS n_rows, CAST(5 AS INTEGER) AS n_columns FROM documents")
def table_shape(spark, sf_dir):
    return profile.shape(read_table(spark, sf_dir, "documents"))
