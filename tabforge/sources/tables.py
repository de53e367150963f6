"""Scans (SRC1-SRC5).

The reference reads whole CSV/HDF5/Parquet files into memory; here every
scan is a lazy Spark source, so column pruning and filter pushdown reach
the file reader.
"""

from __future__ import annotations

import csv
import io
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events "
          "documents embeddings pages benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC3: one of the driver tables, ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def read_split(spark: SparkSession, path: str, *, required: bool = True) -> DataFrame | None:
    """SRC4/SRC5: a train/val/test split stored as Parquet.

    A missing required split raises ``FileNotFoundError``; a missing
    optional split (the test set) returns ``None`` so scoring is skipped.
    """
    try:
        return normalize_nan(spark.read.parquet(path))
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        if required:
            raise FileNotFoundError(f"required split not found: {path}") from exc
        return None


def normalize_nan(df: DataFrame) -> DataFrame:
    """Missing values are one concept in the reference (NaN); Spark has NULL
    and NaN. Map NaN to NULL once, at ingest, for every float column."""
    exprs = []
    changed = False
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            exprs.append(F.nanvl(F.col(f"`{f.name}`"), F.lit(None).cast(f.dataType)).alias(f.name))
            changed = True
        else:
            exprs.append(F.col(f"`{f.name}`"))
    return df.select(*exprs) if changed else df


REJECT = "_corrupt_record"


def infer_csv_schema(spark: SparkSession, path: str, encoding: str = "UTF-8") -> T.StructType:
    """SRC1 helper: infer over all rows, then pin the schema for the job (the
    reference re-infers per chunk, so types can flip between chunks)."""
    return (spark.read.option("header", True).option("encoding", encoding)
            .option("inferSchema", True).option("samplingRatio", 1.0)
            .csv(path).schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             encoding: str = "UTF-8", corrupt_col: str | None = None, quoted_breaks: bool = False) -> DataFrame:
    """SRC1/SRC2: header CSV with a pinned schema. Input splits replace the
    reference's 10,000-row chunk iterator. A value that does not fit the schema
    stops the read; with ``corrupt_col`` such rows are kept there instead, for
    the reject table (EXP2). Never a silent NULL. With ``quoted_breaks`` line breaks inside
    quotes belong to their value, and files are still read in splits (``quoted_records``)."""
    if quoted_breaks:
        return _parsed_records(spark, path, schema, encoding, corrupt_col)
    if schema is None:
        schema = infer_csv_schema(spark, path, encoding=encoding)
    reader = spark.read.option("header", True).option("encoding", encoding)
    if corrupt_col:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col)
    else:
        reader = reader.option("mode", "FAILFAST")
    return normalize_nan(reader.schema(schema).csv(path))


RECORDS = "file string, block long, kind int, place long, text string"
#: A whole record; lines that continue a record of an earlier split; a record that goes on in the next split.
WHOLE, HEAD, TAIL = 0, 1, 2


def quoted_records(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV records as ``(file, text, first)`` where quotes may hold line breaks; ``first`` marks a file's header.

    A record starts at each line with an even number of quotes before it (doubled quotes change nothing). One
    aggregate counts the quotes of each split; its running parity (one bit a split, from the driver) tells every
    task how its first line starts, so splits are cut into records independently. Only the pieces of
    records that cross a split's end, two for each split at most, are shuffled and put together.
    """
    raw = spark.read.option("lineSep", "\n").option("encoding", encoding).text(path)
    lines = raw.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(quotes).alias("n")).orderBy("file", "block").collect()
    odd: dict[tuple[str, int], bool] = {}
    last, inside = None, False
    for r in counts:
        inside = inside and r["file"] == last
        odd[r["file"], r["block"]] = inside
        last, inside = r["file"], inside ^ bool(r["n"] % 2)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, place, held, inside, started = None, 0, [], False, True

        def pieces(done: list[tuple[int, str]]) -> pd.DataFrame:
            nonlocal place
            rows = []
            for kind, text in done:
                rows.append((*at, kind, place, text))
                place += 1
            return pd.DataFrame(rows, columns=["file", "block", "kind", "place", "text"])

        def close(done: list) -> None:
            """The lines at the end of a split."""
            if held:
                done.append((HEAD if not started else TAIL if inside else WHOLE, "\n".join(held)))

        for batch in batches:
            for key, rows in batch.groupby(["file", "block"], sort=False):
                done: list[tuple[int, str]] = []
                if key != at:
                    if at is not None:
                        close(done)
                        yield pieces(done)
                        done = []
                    at, place, held, inside = key, 0, [], odd[key]
                    started = not inside
                for text in rows["value"]:
                    if not inside and held:
                        done.append((WHOLE if started else HEAD, "\n".join(held)))
                        held, started = [], True
                    held.append(text)
                    inside ^= text.count('"') % 2 == 1
                yield pieces(done)
        if at is not None:
            done = []
            close(done)
            yield pieces(done)

    found = lines.mapInPandas(cut, RECORDS)
    first = (F.col("block") == 0) & (F.col("place") == 0)
    whole = found.filter(F.col("kind") == WHOLE).select("file", "text", first.alias("first"))
    # Two pieces for each split at most: a tail and the heads after it are one record.
    order = Window.partitionBy("file").orderBy("block", "place")
    numbered = found.filter(F.col("kind") != WHOLE).withColumn("_r", F.sum((F.col("kind") == TAIL).cast("int")).over(order))
    joined = numbered.groupBy("file", "_r").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "place", "text"))), lambda x: x["text"]), "\n").alias("text"),
        F.min(F.struct("block", "place", first.alias("first")))["first"].alias("first"))
    records = whole.unionByName(joined.select("file", "text", "first"))
    return records.select("file", F.regexp_replace("text", r"\r$", "").alias("text"), "first").filter(F.trim("text") != "")


def _parsed_records(spark: SparkSession, path: str, schema: T.StructType | None, encoding: str, corrupt_col: str | None) -> DataFrame:
    records = quoted_records(spark, path, encoding)
    header = records.filter("first").select("text").first()["text"]
    names = next(csv.reader(io.StringIO(header.removeprefix("\ufeff"))))
    rows = records.filter(~F.col("first"))
    texts = T.StructType([T.StructField(n, T.StringType()) for n in names])
    options = {"escape": '"', "mode": "PERMISSIVE"}
    if schema is None:
        # SRC1: types from all rows: the narrowest one that reads every value.
        cells = rows.select(F.from_csv("text", _ddl(texts), options).alias("r")).select("r.*")
        kinds = (("int", T.IntegerType()), ("bigint", T.LongType()), ("double", T.DoubleType()), ("boolean", T.BooleanType()))
        fits = [F.every(F.col(f"`{n}`").isNull() | F.expr(f"try_cast(`{n}` as {k})").isNotNull()).alias(f"{i}_{k}")
                for i, n in enumerate(names) for k, _ in kinds]
        fit = cells.agg(*fits).first()
        schema = T.StructType([
            T.StructField(n, next((t for k, t in kinds if fit[f"{i}_{k}"]), T.StringType())) for i, n in enumerate(names)])
    bad = corrupt_col or REJECT
    full = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    read = rows.select(F.from_csv("text", _ddl(full), options | {"columnNameOfCorruptRecord": bad}).alias("r")).select("r.*")
    if corrupt_col is None:
        stop = F.raise_error(F.concat(F.lit("malformed CSV record: "), F.col(f"`{bad}`")))
        checked = F.when(F.col(f"`{bad}`").isNotNull(), stop)
        read = read.filter(checked.isNull()).drop(bad)
    return normalize_nan(read)


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def split_rejects(df: DataFrame, corrupt_col: str = REJECT) -> tuple[DataFrame, DataFrame]:
    """EXP2/AGG11: the rows that were read, and the raw lines that were not."""
    bad = F.col(f"`{corrupt_col}`").isNotNull()
    return df.filter(~bad).drop(corrupt_col), df.filter(bad).select(F.col(f"`{corrupt_col}`").alias("line"))
