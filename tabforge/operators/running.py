"""Running sums over a total order without a single-task window.

``ranked_running_sum`` ranks rows by ``(value desc, tiebreak asc)`` and adds
``rank`` (0-based), ``cum`` (running sum of ``value``) and ``total``:

1. ``repartitionByRange`` on the full sort key (the tiebreak splits long runs
   of equal values, so no partition holds a hot value's whole run);
2. the partition id is materialised and the table cut from its lineage with
   a reliable ``checkpoint`` (both branches below must see the same
   partitioning, also after an executor loss);
3. per-partition running sums (a window partitioned by partition id), plus
   per-partition totals whose prefix sums (at most ``n_parts`` rows) are the
   offsets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def ranked_running_sum(df: DataFrame, value: str, tiebreak: str, n_parts: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if n_parts is None:
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_parts, F.desc(value), F.asc(tiebreak))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    w = (Window.partitionBy("_pid").orderBy(F.desc(value), F.asc(tiebreak))
         .rowsBetween(Window.unboundedPreceding, 0))
    local = (ranged.withColumn("_lcum", F.sum(value).over(w))
             .withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid")
                                                     .orderBy(F.desc(value), F.asc(tiebreak)))))
    parts = ranged.groupBy("_pid").agg(F.sum(value).alias("_psum"), F.count(F.lit(1)).alias("_pn"))
    wp = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_pid",
                           F.coalesce(F.sum("_psum").over(wp), F.lit(0.0)).alias("_osum"),
                           F.coalesce(F.sum("_pn").over(wp), F.lit(0)).alias("_on"),
                           F.sum("_psum").over(Window.orderBy("_pid").rowsBetween(
                               Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"))
    # offsets: one row per range partition (bounded by n_parts).
    return (local.join(F.broadcast(offsets), "_pid")
            .select(*df.columns,
                    (F.col("_on") + F.col("_lrn") - 1).cast("long").alias("rank"),
                    (F.col("_osum") + F.col("_lcum")).alias("cum"),
                    "total"))


def grouped_ordinal(df: DataFrame, group: str, value: str, n_parts: int | None = None) -> DataFrame:
    """``(group, value, code)``: 0-based position of each (distinct) value in
    ascending order within its group, without a window over a whole group
    (one group may hold most of the values).

    Range partitions on ``(group, value)`` split a large group across tasks;
    a row's code is its rank inside its partition plus the number of the
    group's values in earlier partitions (per-partition counts: at most
    ``n_parts`` x groups rows)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if n_parts is None:
        n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.select(group, value)
              .repartitionByRange(n_parts, F.asc(group), F.asc(value))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    local = ranged.withColumn("_lrn", F.row_number().over(
        Window.partitionBy("_pid", group).orderBy(value)))
    counts = ranged.groupBy("_pid", group).agg(F.count(F.lit(1)).alias("_pn"))
    wp = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", group, F.coalesce(F.sum("_pn").over(wp), F.lit(0)).alias("_off"))
    # offsets: one row per (range partition, group) present -- bounded.
    return (local.join(F.broadcast(offsets), ["_pid", group])
            .select(group, value, (F.col("_off") + F.col("_lrn") - 1).cast("int").alias("code")))
