"""Shards by extendible hashing: only oversized buckets split, on one more hash bit.

The directory is indexed by the leading bits of a key's hash. A bucket of depth ``d`` exists
when its bytes fit the limit and those of its parent (depth ``d - 1``) do not, so the local
depth of a row is the smallest depth at which its bucket fits. Bucket sizes come from one
pre-aggregated pass over all rows; the directory never leaves the executors.

The hash has 128 bits: 64 of the key, then 64 of the row's text. Rows of one hot key therefore
split as well; identical rows (same key, same text) share all 128 bits and are dealt round-robin
into overflow shards of that bucket.

Cases: null texts have no bytes; a null key is a key like any other; repeated rows are placed
one by one; a single row above the limit gets a shard of its own key (``oversized`` is true
there and only there); an empty table gives an empty result; extra columns stay, and a column
that has the name of a result is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.common import materialize

#: Bytes of text that a shard may hold in the registered query.
SHARD_BYTES = 8 << 20
HASH_BITS = 128
#: Directory bits beyond those that evenly filled shards need, in the first pass and in each later one.
SPARE_BITS = 4


def hash_bits(key: Column, text: Column) -> Column:
    """128 hash bits as text of 0 and 1: the md5 digests' first halves of key and content."""

    def half(value: Column) -> Column:
        digest = F.md5(F.coalesce(value.cast("string"), F.lit("")))
        words = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 2) for i in range(2)]
        return F.concat(*[F.lpad(w, 32, "0") for w in words])

    return F.concat(half(key), half(text))


def bucket_depths(cells: DataFrame, top: int, bottom: int, limit: int) -> DataFrame:
    """For cells (``cell`` bits of length ``bottom``, ``bytes``, ``n``): the smallest depth in
    ``top..bottom`` at which the cell's bucket fits, and that bucket's totals (null: none fits)."""
    levels = cells.select(
        "cell", "bytes", "n", F.explode(F.sequence(F.lit(top), F.lit(bottom))).alias("depth")
    ).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sizes = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
    fits = sizes.filter((F.col("bytes") <= limit) | (F.col("n") == 1)).select("depth", "prefix")
    found = levels.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
    return found.groupBy("cell").agg(F.min("depth").alias("local_depth"))


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = SHARD_BYTES) -> DataFrame:
    """``docs`` plus ``shard_id`` (bits of its bucket, and ``-i`` for overflow shard ``i``),
    ``local_depth``, ``n_bytes`` and ``oversized``."""
    sized = docs.withColumns(
        {
            "n_bytes": F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long"),
            "_bits": hash_bits(F.col(key), F.col(text)),
        }
    )
    hashed = materialize(sized.groupBy("_bits").agg(F.sum("n_bytes").alias("bytes"), F.count("*").alias("n")), "shard")
    total = hashed.agg(F.sum("bytes")).first()[0] or 0
    top, bottom = 0, min(HASH_BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SPARE_BITS)
    open_rows, parts = hashed, []
    while True:
        cells = (
            open_rows.withColumn("cell", F.substring("_bits", 1, bottom))
            .groupBy("cell")
            .agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n"))
        )
        depths = materialize(
            cells.select("cell").join(bucket_depths(cells, top, bottom, limit), "cell", "left"), "shard-depths"
        )
        parts.append((bottom, depths.filter(F.col("local_depth").isNotNull())))
        too_large = depths.filter(F.col("local_depth").isNull()).select("cell")
        if bottom == HASH_BITS or too_large.isEmpty():
            break
        open_rows = materialize(
            open_rows.withColumn("cell", F.substring("_bits", 1, bottom)).join(too_large, "cell").drop("cell"), "shard-open"
        )
        top, bottom = bottom + 1, min(HASH_BITS, bottom + 2 * SPARE_BITS)
    # A row looks its cell up at every width that the directory has (one, unless keys are hot).
    widths = [bits for bits, _ in parts]
    rows = sized.drop("local_depth", "shard_id", "oversized")
    depth = F.lit(None).cast("int")
    for bits, depths in parts:
        cells = depths.select(F.col("cell").alias("_cell"), F.col("local_depth").alias(f"_depth{bits}"))
        rows = rows.withColumn("_cell", F.substring("_bits", 1, bits)).join(cells, "_cell", "left").drop("_cell")
        depth = F.coalesce(depth, F.col(f"_depth{bits}"))
    placed = rows.withColumn("local_depth", depth).drop(*[f"_depth{b}" for b in widths])
    named = placed.withColumns(
        {
            "local_depth": F.coalesce("local_depth", F.lit(HASH_BITS)),
            "oversized": F.col("n_bytes") > limit,
            "shard_id": F.expr(f"substring(_bits, 1, coalesce(local_depth, {HASH_BITS}))"),
        }
    )
    if bottom == HASH_BITS and not too_large.isEmpty():
        named = overflow_shards(named, hashed.join(too_large, F.col("_bits") == F.col("cell")), limit)
    return named.drop("_bits")


def overflow_shards(rows: DataFrame, heavy: DataFrame, limit: int) -> DataFrame:
    """Deal identical rows that together exceed the limit into numbered shards. Each salt
    numbers about eight shards' rows, so no task gets all copies."""
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) * F.col("n") / F.greatest(F.lit(1), F.col("bytes"))))
    sizes = heavy.select("_bits", fit.alias("_fit"), F.ceil(F.col("n") / fit / 8).alias("_salts"))
    light = rows.join(sizes, "_bits", "left_anti")
    salted = rows.join(sizes, "_bits").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.col("_salts")))
    place = F.row_number().over(Window.partitionBy("_bits", "_salt").orderBy(F.lit(0)))
    dealt = salted.withColumn(
        "shard_id", F.concat_ws("-", "shard_id", "_salt", F.floor((place - 1) / F.col("_fit")).cast("string"))
    )
    return light.unionByName(dealt.drop("_fit", "_salts", "_salt"))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write each shard as its own folder of Parquet (``shard_id=...``)."""
    sharded.repartition("shard_id").write.partitionBy("shard_id").parquet(path)


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return shard(docs).select("doc_id", "shard_id", "local_depth", "n_bytes", "oversized")


#: The registered query in DuckDB SQL; 20 directory bits are more than its test tables need.
SQL = f"""
WITH bits AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes,
         substr(CAST(CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS BIT) AS VARCHAR), 33, 20) AS b
  FROM documents),
levels AS (SELECT doc_id, n_bytes, d, substr(b, 1, d) AS p FROM bits, (SELECT unnest(range(0, 21)) AS d)),
sizes AS (SELECT d, p, sum(n_bytes) AS s, count(*) AS n FROM levels GROUP BY ALL),
depths AS (SELECT doc_id, n_bytes, min(levels.d) AS depth FROM levels JOIN sizes USING (d, p)
           WHERE s <= {SHARD_BYTES} OR n = 1 GROUP BY ALL)
SELECT doc_id, substr(b, 1, CAST(depth AS BIGINT)) AS shard_id, CAST(depth AS INTEGER) AS local_depth, n_bytes,
       n_bytes > {SHARD_BYTES} AS oversized
FROM depths JOIN bits USING (doc_id, n_bytes)
"""
