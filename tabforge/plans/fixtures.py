"""Test tables derived from the driver tables (FIXTURES.md §B).

Each fixture exists twice: as a Spark plan (``order_features(spark, sf_dir)``)
and as the equivalent DuckDB SQL (``ORDER_FEATURES_SQL``), so every query
built on it can be checked against the SQL oracle. The driver tables have no
missing values, so gaps are made deterministically (``NULLIF`` / a hash
slice with its own salt, independent of the split hash).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import read_table


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# --- order_features -------------------------------------------------------

def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders left join per-order lineitem aggregates; label = urgent
    pending order (~6.5% positive)."""
    li = (_t(spark, sf_dir, "lineitem")
          .groupBy("l_orderkey")
          .agg(F.count(F.lit(1)).alias("n_lines"),
               F.sum("l_quantity").alias("sum_qty"),
               F.avg("l_discount").alias("avg_discount"),
               F.max("l_tax").alias("max_tax")))
    o = _t(spark, sf_dir, "orders")
    gap = F.substring(F.md5(F.concat(F.lit("gap:"), F.col("o_orderkey").cast("string"))), 1, 1) == "0"
    return (o.join(li, o.o_orderkey == li.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("id"),
                    F.col("n_lines"),
                    F.col("sum_qty"),
                    F.nullif(F.col("avg_discount"), F.lit(0.0)).alias("avg_discount"),
                    F.nullif(F.col("max_tax"), F.lit(0.0)).alias("max_tax"),
                    F.col("o_totalprice").alias("total_price"),
                    F.col("o_orderstatus").alias("status"),
                    F.when(gap, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("priority"),
                    ((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"))
                    .cast("int").alias("label")))


ORDER_FEATURES_SQL = """
SELECT o.o_orderkey AS id,
       li.n_lines,
       li.sum_qty,
       NULLIF(li.avg_discount, 0e0) AS avg_discount,
       NULLIF(li.max_tax, 0e0) AS max_tax,
       o.o_totalprice AS total_price,
       o.o_orderstatus AS status,
       CASE WHEN substr(md5('gap:' || CAST(o.o_orderkey AS VARCHAR)), 1, 1) = '0'
            THEN NULL ELSE o.o_orderpriority END AS priority,
       CAST(o.o_orderstatus = 'P' AND o.o_orderpriority = '1-URGENT' AS INTEGER) AS label
FROM orders o
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty,
                  avg(l_discount) AS avg_discount, max(l_tax) AS max_tax
           FROM lineitem GROUP BY l_orderkey) li
  ON o.o_orderkey = li.l_orderkey
"""

ORDER_NUMERIC = ["n_lines", "sum_qty", "avg_discount", "max_tax", "total_price"]
ORDER_CATEGORICAL = ["status", "priority"]


# --- doc_labels -----------------------------------------------------------

def doc_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents left join labels (most documents unlabelled)."""
    d = _t(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = _t(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select("doc_id", "lang", "source", "n_chars", "quality", "toxic")


DOC_LABELS_SQL = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


# --- line_scores ----------------------------------------------------------

def line_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A heavily tied score (50 distinct values) and a ~1/3 positive label."""
    li = _t(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber",
                     (F.col("l_quantity") / F.lit(50.0)).alias("score"),
                     (F.col("l_returnflag") == "R").cast("int").alias("y"))


LINE_SCORES_SQL = """
SELECT l_orderkey, l_linenumber, l_quantity / 50e0 AS score,
       CAST(l_returnflag = 'R' AS INTEGER) AS y
FROM lineitem
"""


# --- emb_binary -----------------------------------------------------------

#: Dimensions of the driver's embeddings.
EMB_DIMS = 64


def emb_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64-dim embeddings as an ML vector, ``y = (label = 0)`` (~10% positive)."""
    from pyspark.ml.functions import array_to_vector
    e = _t(spark, sf_dir, "embeddings")
    return e.select("vec_id",
                    array_to_vector(F.transform("embedding", lambda x: x.cast("double"))).alias("features"),
                    (F.col("label") == 0).cast("int").alias("y"))


# --- event_series ---------------------------------------------------------

def event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily average event value as a metric history ``(round, value)``;
    round 0 is the first day (one row per day: small)."""
    ev = _t(spark, sf_dir, "events")
    daily = ev.groupBy(F.to_date("ts").alias("day")).agg(F.avg("value").alias("value"))
    return daily.select((F.row_number().over(Window.orderBy("day")) - 1).alias("round"), "value")


EVENT_SERIES_SQL = """
SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS round, value
FROM (SELECT CAST(ts AS DATE) AS day, avg(value) AS value FROM events GROUP BY 1)
"""


# --- part_share -----------------------------------------------------------

def part_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue per part as an importance table ``(feature, importance)``."""
    li = _t(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("feature")).agg(
        F.sum("l_extendedprice").alias("importance"))


PART_SHARE_SQL = """
SELECT l_partkey AS feature, sum(l_extendedprice) AS importance FROM lineitem GROUP BY l_partkey
"""
