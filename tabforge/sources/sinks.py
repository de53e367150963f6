"""Sinks (SNK1-SNK7). All writes are distributed; only report tables that
are small by construction (one row per column or per trial) are coalesced."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "\ufeff"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK1 (and SNK2, re-aimed): Parquet without an index column."""
    df.write.mode(mode).parquet(path)


def write_report_csv(df: DataFrame, path: str) -> None:
    """SNK3: a small report table as one header CSV file."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_submission_csv(df: DataFrame, path: str) -> None:
    """SNK4: one ``utf-8-sig`` CSV file, ``<path>/part-00000.csv``: byte-order mark, header, rows. The rows
    are written in parallel as headerless parts; at commit the Hadoop file system joins them behind the header, by
    ``concat`` where it can (no byte moves), else by copying buffer after buffer. No task sees all rows."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    folder, parts = at(path), f"{path.rstrip('/')}/_parts"
    fs = folder.getFileSystem(conf)
    fs.delete(folder, True)
    df.write.option("header", False).csv(parts)
    header = io.StringIO()
    csv.writer(header, lineterminator="\n").writerow(df.columns)
    unfinished = at(f"{path.rstrip('/')}/_part-00000.csv")
    out = fs.create(unfinished, True)
    out.write(bytearray((BOM + header.getvalue()).encode()))
    files = sorted(s.getPath().toString() for s in fs.listStatus(at(parts)) if s.getPath().getName().startswith("part-"))
    files = [f for f in files if fs.getFileStatus(at(f)).getLen() > 0]
    if fs.getScheme() == "hdfs":
        out.close()
        array = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(files))
        for i, f in enumerate(files):
            array[i] = at(f)
        fs.concat(unfinished, array)
    else:
        for f in files:
            part = fs.open(at(f))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            part.close()
        out.close()
    fs.delete(at(parts), True)
    # The name appears when the file is whole.
    fs.rename(unfinished, at(f"{path.rstrip('/')}/part-00000.csv"))


def write_jsonl(df: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """SNK5: JSON lines, non-ASCII kept as UTF-8. NULL fields are written
    as ``null`` (Spark drops them by default)."""
    (df.write.mode("overwrite")
     .option("ignoreNullFields", str(not keep_nulls).lower())
     .json(path))


def save_model(model, path: str) -> None:
    """SNK6/SNK7: MLlib persistence (tree node table in Parquet + metadata)."""
    model.write().overwrite().save(path)


def with_json_params(df: DataFrame, map_col: str) -> DataFrame:
    """RPT3 helper: a ``map<string,string>`` column flattened to JSON text
    so the summary row fits a CSV file."""
    return df.withColumn(map_col, F.to_json(F.col(map_col)))


def round_report(df: DataFrame, digits: int = 4) -> DataFrame:
    """SCL10: every floating column rounded half-up to ``digits`` places
    (the reference prints report metrics with four decimals)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
                       for f in df.schema.fields])
