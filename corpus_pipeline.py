"""From raw documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All but the last keep the columns of ``documents``.

Cases: null texts and documents without enough words go with the quality rules; rows without
``doc_id`` pass the near-duplicate stage unchanged; rows that repeat a ``doc_id`` with another text
are documents of their own there; an empty table passes through every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import materialize
from tabforge.llm.jaccard import Rule, jaccard_components
from tabforge.llm.packing import pack
from tabforge.llm.quality import quality_rules
from tabforge.llm.repeats import remove_repeats
from tabforge.llm.toxicity import fit_lexicon, fold_of, score_toxicity

#: Near duplicates: five-word shingles, similarity of at least 0.8.
NEAR_DUPLICATES = Rule(words=5, num=8, den=10)


def on_texts(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Apply ``work`` to ``doc_id`` and ``text`` with the other columns carried under names that
    no operator uses; the columns of ``docs`` come back, with the character counts of the texts."""
    carried = {c: f"_carried{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    done = work(docs.select("doc_id", "text", *[F.col(f"`{c}`").alias(name) for c, name in carried.items()]))
    if "n_chars" in carried:
        done = done.withColumn(carried["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*[F.col(carried.get(c, c)).alias(c) for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; of the others, the failing lines."""
    return on_texts(docs, lambda d: quality_rules(d).filter("kept").withColumn("text", F.col("clean_text")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    lexicon = fit_lexicon(docs.select("doc_id", "text"), labels, usable=fold_of() != 0)
    return on_texts(docs, lambda d: score_toxicity(d, lexicon).filter("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked texts the one with the smallest ``doc_id`` stays. Rows are told apart
    by ``doc_id`` and text, so that only equal or linked texts go where an id is used again."""
    rows = docs.filter(F.col("doc_id").isNotNull()).withColumn("_row", F.xxhash64("doc_id", "text"))
    components = jaccard_components(rows.select(F.col("_row").alias("doc_id"), "text"), NEAR_DUPLICATES)
    grouped = components.select(F.col("doc_id").alias("_row"), "component_id").distinct()
    owned = rows.select("_row", "doc_id").distinct().join(grouped, "_row")
    first = owned.groupBy("component_id").agg(F.min(F.struct("doc_id", "_row")).alias("first"))
    stay = materialize(first.select("first._row"), "pipeline-stay")
    named = rows.join(stay, "_row", "left_semi").dropDuplicates(["_row"])
    return named.select(*docs.columns).unionByName(docs.filter(F.col("doc_id").isNull()))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that start earlier as well are cut out."""
    return on_texts(docs, remove_repeats)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in the training sequences."""
    return pack(docs)


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeats),
    ("best-fit packing", packing),
]

#: Learned weights, sampled orders and tokenizers are not for SQL; the stages are tested against
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
