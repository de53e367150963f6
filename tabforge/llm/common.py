"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_RUN = r"[\x20\x09-\x0D]+"

U64 = np.uint64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the setting is absent, a folder in the warehouse, which a cluster shares as
    well, is set for this session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return folder


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives
    the loss of executors, and keeps an expensive plan from running twice."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Reducers for a shuffle that must be dealt by an explicit partition number."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def runs_to_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the half-open intervals ``[start, end)`` into maximal disjoint spans."""
    if len(start) == 0:
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    first = np.r_[True, s[1:] > e[:-1]]
    return s[first], e[np.r_[np.flatnonzero(first)[1:] - 1, len(s) - 1]]
