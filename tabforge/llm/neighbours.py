"""Approximate nearest neighbours along shifted space-filling curves.

Vectors are projected at random to a few dimensions, shifted, and ordered by their Hilbert key,
once per curve. Each order is cut into blocks of rows; a query looks at the blocks around its own
in every order, the windows' candidates are merged, and exact cosines rank them. The window is
not guessed: for a bounded sample of queries the exact neighbours are found by brute force, and
the window becomes the distance, in blocks, within which the target share of them lies.

Cases: null, empty and zero vectors and those with null or non-finite components take no part,
nor do vectors whose length differs from the most frequent one; of identical vectors only the
smallest ids can be among the nearest, so the others are dropped as candidates (never as
queries); repeated rows of one id count once; ties go to the smaller id; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import materialize

CURVES = 8
#: Dimensions and bits per dimension of a curve.
DIMENSIONS = 6
BITS = 8
#: Rows of a block, about.
BLOCK_ROWS = 1024
MIN_BLOCKS = 16
#: Queries of the calibration sample, and the share of their neighbours that the windows must hold.
SAMPLE_QUERIES = 128
TARGET_RECALL = 0.97
#: Identical vectors are spread over this many salts before their smallest ids are taken.
SALTS = 64


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert index of integer cells (rows x dimensions), by the transpose method: undo excess
    work bit by bit, Gray-encode, then interleave the bits."""
    x = cells.T.astype(np.uint64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = np.uint64(q - 1)
        for i in range(n):
            high = (x[i] & np.uint64(q)) != 0
            swap = np.where(high, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], dtype=np.uint64)
    q = 1 << (bits - 1)
    while q > 1:
        flip = np.where((x[n - 1] & np.uint64(q)) != 0, flip ^ np.uint64(q - 1), flip)
        q >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.uint64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << np.uint64(1)) | ((x[i] >> np.uint64(b)) & np.uint64(1))
    return key.astype(np.int64)


def curve_keys(vectors: np.ndarray, curve: int, seed: int) -> np.ndarray:
    """Keys of unit vectors on one curve: random projection, normal scores, random shift."""
    rng = np.random.default_rng([seed, curve])
    dim = vectors.shape[1]
    spread = vectors @ rng.standard_normal((dim, DIMENSIONS))  # about standard normal per column
    even = 1.0 / (1.0 + np.exp(-1.702 * spread))  # close to the normal distribution function
    shifted = (even + rng.uniform(0, 1, DIMENSIONS)) / 2.0
    cells = np.minimum((shifted * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
    return hilbert_key(cells, BITS)


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<f8").reshape(len(column), -1)


def usable_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part, as little-endian doubles."""

    def convert(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids, raw, dims = [], [], []
            for vec_id, e in zip(batch["vec_id"], batch["embedding"], strict=True):
                v = np.asarray(e, dtype="<f8")
                if len(v) and np.isfinite(v).all() and v.any():
                    ids.append(vec_id)
                    raw.append(v.tobytes())
                    dims.append(len(v))
            yield pd.DataFrame({"vec_id": np.array(ids, dtype=np.int64), "v": raw, "dim": np.array(dims, dtype=np.int32)})

    whole = table.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    vectors = whole.select(F.col("vec_id").cast("long"), "embedding").mapInPandas(convert, "vec_id long, v binary, dim int")
    return vectors.dropDuplicates(["vec_id", "v"])


def first_copies(vectors: DataFrame, keep: int) -> DataFrame:
    """Of identical vectors, the ``keep`` smallest ids; taken per salt first, then per vector."""
    digest = F.sha2("v", 256)
    salted = Window.partitionBy("_d", "_salt").orderBy("vec_id")
    whole = Window.partitionBy("_d").orderBy("vec_id")
    ranked = (
        vectors.withColumns({"_d": digest, "_salt": F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))})
        .withColumn("_r", F.row_number().over(salted))
        .filter(F.col("_r") <= keep)
        .drop("_r", "_salt")
    )
    return ranked.withColumn("_r", F.row_number().over(whole)).filter(F.col("_r") <= keep).drop("_r", "_d")


def on_curves(vectors: DataFrame, seed: int) -> DataFrame:
    """One row per vector and curve, with its key."""

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                units = unit(matrix(batch["v"]))
                for curve in range(CURVES):
                    yield pd.DataFrame(
                        {"vec_id": batch["vec_id"], "v": batch["v"], "curve": curve, "key": curve_keys(units, curve, seed)}
                    )

    return vectors.mapInPandas(place, "vec_id long, v binary, curve int, key long")


def with_blocks(keyed: DataFrame, edges: np.ndarray) -> DataFrame:
    """Adds ``block``: the place of the key between the curve's block edges. Rows of one key are
    spread over the blocks that the key fills."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            block = np.zeros(len(batch), dtype=np.int32)
            for curve in np.unique(batch["curve"]):
                at = np.flatnonzero(batch["curve"] == curve)
                key = batch["key"].to_numpy()[at]
                low, high = np.searchsorted(edges[curve], key, "left"), np.searchsorted(edges[curve], key, "right")
                block[at] = low + batch["vec_id"].to_numpy()[at] % (high - low + 1)
            yield batch.assign(block=block)[["vec_id", "v", "curve", "block"]]

    return keyed.mapInPandas(find, "vec_id long, v binary, curve int, block int")


def top_of(queries: pd.DataFrame, ids: np.ndarray, units: np.ndarray, k: int) -> pd.DataFrame:
    """The ``k`` best of a block for each query. The matrix product only preselects; the score is
    summed the same way for every pair, so that equal vectors tie exactly."""
    q = unit(matrix(queries["v"]))
    out_q, out_id, out_s = [], [], []
    for at in range(0, len(q), 256):
        rough = q[at : at + 256] @ units.T
        if rough.shape[1] > k:
            least = np.partition(rough, rough.shape[1] - k, axis=1)[:, rough.shape[1] - k] - 1e-9
        else:
            least = np.full(len(rough), -np.inf)
        for i, row in enumerate(rough):
            near = np.flatnonzero(row >= least[i])
            score = (units[near] * q[at + i]).sum(axis=1)
            best = np.lexsort((ids[near], -score))[:k]
            out_q.append(np.full(len(best), queries["qid"].iloc[at + i]))
            out_id.append(ids[near][best])
            out_s.append(score[best])
    empty = [np.empty(0)]
    return pd.DataFrame(
        {
            "qid": np.concatenate(out_q or empty).astype(np.int64),
            "vec_id": np.concatenate(out_id or empty).astype(np.int64),
            "score": np.concatenate(out_s or empty).astype(np.float64),
        }
    )


FOUND = "qid long, vec_id long, score double"


def search_blocks(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Top ``k`` per query and block for co-grouped candidates and queries of (curve, block)."""

    def search(block: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if block.empty or asked.empty:
            return pd.DataFrame({"qid": [], "vec_id": [], "score": []}).astype({"qid": "int64", "vec_id": "int64"})
        return top_of(asked, block["vec_id"].to_numpy(), unit(matrix(block["v"])), k)

    by = ("curve", "block")
    return candidates.groupBy(*by).cogroup(queries.groupBy(*by)).applyInPandas(search, FOUND)


def best_of(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("qid").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)


def calibrated_window(candidates: DataFrame, blocked: DataFrame, queries: DataFrame, k: int) -> int:
    """Blocks to either side within which, on some curve, the target share of the sampled
    queries' exact neighbours lies."""
    sample = queries.orderBy(F.xxhash64("qid")).limit(SAMPLE_QUERIES).toPandas()  # bounded
    if sample.empty:
        return 0

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield top_of(sample, batch["vec_id"].to_numpy(), unit(matrix(batch["v"])), k)

    true = best_of(candidates.select("vec_id", "v").mapInPandas(exact, FOUND), k).filter(F.col("vec_id") != F.col("qid"))
    place = blocked.select("vec_id", "curve", "block")
    ends = true.select("qid", "vec_id").join(place, "vec_id")
    own = place.withColumnsRenamed({"vec_id": "qid", "block": "own"})
    apart = (
        ends.join(own, ["qid", "curve"])
        .groupBy("qid", "vec_id")
        .agg(F.min(F.abs(F.col("block") - F.col("own"))).alias("apart"))
        .select("apart")
        .toPandas()["apart"]  # at most k rows per sampled query
    )
    return int(np.quantile(apart, TARGET_RECALL, method="higher")) if len(apart) else 0


def nearest(table: DataFrame, is_query, k: int = 5, seed: int = 7) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found for every row for
    which the Column ``is_query`` holds."""
    spark = table.sparkSession
    vectors = usable_vectors(table)
    sizes = vectors.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    vectors = vectors.filter(F.col("dim") == (sizes["dim"] if sizes else 0)).select("vec_id", "v")
    candidates = materialize(first_copies(vectors, k + 1), "ann-vectors")
    # Queries with one vector share one search: their smallest id stands for them.
    asked = vectors.filter(is_query).withColumn("_d", F.sha2("v", 256))
    asked = materialize(asked.select("vec_id", "_d", "v"), "ann-queries")
    distinct = asked.groupBy("_d").agg(F.min("vec_id").alias("qid"), F.first("v").alias("v"))
    n = candidates.count()
    blocks = max(MIN_BLOCKS, math.ceil(n / BLOCK_ROWS))
    keyed = materialize(on_curves(candidates, seed), "ann-keys")
    shares = [i / blocks for i in range(1, blocks)]
    cut = keyed.groupBy("curve").agg(F.percentile_approx("key", shares, 20 * blocks).alias("edges")).collect()
    edges = np.zeros((CURVES, blocks - 1), dtype=np.int64)
    for row in cut:
        edges[row["curve"]] = row["edges"]
    blocked = materialize(with_blocks(keyed, edges), "ann-blocks")
    query_keys = with_blocks(on_curves(distinct.select(F.col("qid").alias("vec_id"), "v"), seed), edges)
    query_blocks = materialize(query_keys.withColumnRenamed("vec_id", "qid"), "ann-query-blocks")
    one_curve = query_blocks.filter(F.col("curve") == 0).select("qid", "v")
    # The sample must be found among the candidates to have a place of its own.
    window = calibrated_window(candidates, blocked, one_curve.join(candidates.select(F.col("vec_id").alias("qid")), "qid", "left_semi"), k + 1)
    spread = query_blocks.withColumn(
        "block",
        F.explode(
            F.sequence(F.greatest(F.lit(0), F.col("block") - window), F.least(F.lit(blocks - 1), F.col("block") + window))
        ),
    )
    found = best_of(search_blocks(blocked, spread, k + 1), k + 1).select("qid", "vec_id", "score")
    # Back to every query row: its own id does not count.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    owners = asked.select("_d", F.col("vec_id").alias("query_id")).join(distinct.select("_d", "qid"), "_d")
    return (
        owners.join(found, "qid")
        .filter(F.col("vec_id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op10_nearest_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0)


#: Brute force over all rows: the recall of the search is measured against it.
BRUTE_FORCE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
          FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
