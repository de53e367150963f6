"""Exact medians of many columns without gathering a column in one task (AGG7).

Spark's ``median`` is exact but merges a value->count map per column in one
task, which grows with the number of distinct values. Here:

1. long form ``(feature, value)`` (``unpivot``, NULL/NaN dropped);
2. a band ``[lo, hi]`` per feature that must contain the two middle order
   statistics, with ``below`` = number of values under ``lo``. It starts as
   the whole column and is narrowed by a Greenwald-Khanna sketch
   (``percentile_approx``, rank error <= m/accuracy) *over the band only*, so
   each round shrinks it ~accuracy/4 times: at 10^12 values two rounds leave
   ~10^5 — the band never grows with the data beyond ``band_limit``;
3. once every band is small, one aggregate reduces it to ``(value, count)``
   (a hot value is one row) and a running count over the band's distinct
   values picks the exact order statistics.

A sketch band that misses the middle ranks (impossible under the sketch
guarantee, checked anyway) is widened and recomputed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .profile import long_cells, numeric_cells

BAND_LIMIT = 1_000_000


def long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(feature, value double)`` rows for the non-missing cells of ``cols``."""
    return long_cells(df, numeric_cells(df, cols), cols).filter(F.col("value").isNotNull())


def _bounds_df(spark, bands: dict) -> DataFrame:
    # one row per feature (bounded by the column count)
    return spark.createDataFrame([(f, lo, hi) for f, (lo, hi, _, _) in bands.items()],
                                 "feature string, lo double, hi double")


def _narrow(long: DataFrame, bands: dict, n: dict, accuracy: int, probs: list[float]) -> dict:
    """One sketch round over the current bands of the features in ``bands``
    (``{feature: (lo, hi, below, m)}``); returns the narrowed bands. The
    percentages are one fixed list for every feature (``percentile_approx``
    needs literals); each feature brackets its own middle ranks with them,
    keeping a margin of the sketch's rank error. Every new band is verified
    with exact counts; a band that fails keeps its old bounds."""
    spark = long.sparkSession
    band = long.join(F.broadcast(_bounds_df(spark, bands)), "feature").filter(
        (F.col("value") >= F.col("lo")) & (F.col("value") <= F.col("hi")))
    sk = band.groupBy("feature").agg(F.percentile_approx("value", probs, accuracy).alias("_q")).collect()
    eps = 1.0 / accuracy
    cand = {}
    for r in sk:  # one row per feature
        f = r["feature"]
        lo, hi, below, m = bands[f]
        k1, k2 = (n[f] - 1) // 2 - below, n[f] // 2 - below          # ranks inside the band
        lo_i = [i for i, p in enumerate(probs) if p <= k1 / m - eps]
        hi_i = [i for i, p in enumerate(probs) if p >= (k2 + 1) / m + eps]
        cand[f] = (r["_q"][lo_i[-1]] if lo_i else lo, r["_q"][hi_i[0]] if hi_i else hi)
    cb = spark.createDataFrame([(f, a, b) for f, (a, b) in cand.items()], "feature string, nlo double, nhi double")
    cnt = (band.join(F.broadcast(cb), "feature").groupBy("feature")
           .agg(F.count_if(F.col("value") < F.col("nlo")).alias("under"),
                F.count_if((F.col("value") >= F.col("nlo")) & (F.col("value") <= F.col("nhi"))).alias("m"))
           .collect())  # one row per feature
    out = dict(bands)
    for r in cnt:
        f = r["feature"]
        below = bands[f][2] + int(r["under"])
        m = int(r["m"])
        if below <= (n[f] - 1) // 2 and n[f] // 2 < below + m:
            out[f] = (cand[f][0], cand[f][1], below, m)
    return out


def _pick(long: DataFrame, bounds: dict, n: dict) -> dict:
    """One pass: values under each band collapse into one NULL row (its
    count is the band's rank offset), band values into ``(value, count)``;
    a running count per feature over at most band-size rows picks the two
    middle order statistics. ``{feature: median or None if missed}``."""
    spark = long.sparkSession
    bdf = spark.createDataFrame(
        [(f, lo, hi, (n[f] - 1) // 2, n[f] // 2) for f, (lo, hi) in bounds.items()],
        "feature string, lo double, hi double, k1 long, k2 long")   # one row per feature
    agg = (long.join(F.broadcast(bdf.select("feature", "lo", "hi")), "feature")
           .filter(F.col("value") <= F.col("hi"))
           .groupBy("feature", F.when(F.col("value") >= F.col("lo"), F.col("value")).alias("bv"))
           .agg(F.count(F.lit(1)).alias("c")))
    w = (Window.partitionBy("feature").orderBy(F.col("bv").asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, 0))
    ranked = (agg.join(F.broadcast(bdf.select("feature", "k1", "k2")), "feature")
              .withColumn("_end", F.sum("c").over(w))
              .withColumn("_start", F.col("_end") - F.col("c"))
              .filter(F.col("bv").isNotNull()))
    hit = lambda k: (F.col("_start") <= F.col(k)) & (F.col(k) < F.col("_end"))
    picked = ranked.groupBy("feature").agg(F.max(F.when(hit("k1"), F.col("bv"))).alias("v1"),
                                           F.max(F.when(hit("k2"), F.col("bv"))).alias("v2"))
    out = {f: None for f in bounds}
    for r in picked.collect():  # one row per column
        if r["v1"] is not None and r["v2"] is not None:
            out[r["feature"]] = (r["v1"] + r["v2"]) / 2
    return out


def median_map(df: DataFrame, cols: list[str], accuracy: int = 10000, band_limit: int = BAND_LIMIT) -> dict:
    """``{column: (median, n)}``: exact medians (mean of the two middle
    values for even ``n``); ``(None, 0)`` for an all-missing column.

    Typical case: two passes (count + sketch band, then the pick). Columns
    whose sketch band could exceed ``band_limit`` values (n > band_limit *
    accuracy / 4) are narrowed first; a missed pick (outside the sketch
    guarantee) falls back to narrowing from the whole column."""
    long = long_values(df, cols)
    first = [0.5 - 2.0 / accuracy, 0.5 + 2.0 / accuracy]       # whole column: the middle is at 0.5
    grid = [i / 256 for i in range(257)]                           # inside a band: anywhere
    stats = long.groupBy("feature").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("mn"), F.max("value").alias("mx"),
        F.percentile_approx("value", first, accuracy).alias("q")).collect()  # one row per column
    n = {r["feature"]: int(r["n"]) for r in stats}
    whole = {r["feature"]: (r["mn"], r["mx"], 0, int(r["n"])) for r in stats}

    def narrowed(feats):
        bands = {f: whole[f] for f in feats}
        for _ in range(8):
            big = {f: b for f, b in bands.items() if b[3] > band_limit}
            if not big:
                break
            new = _narrow(long, big, n, accuracy, grid)
            bands.update(new)
            if all(new[f][3] >= big[f][3] for f in big):      # no progress: stop narrowing
                break
        return {f: (b[0], b[1]) for f, b in bands.items()}

    direct = {r["feature"]: (r["q"][0], r["q"][1]) for r in stats if 4 * n[r["feature"]] <= band_limit * accuracy}
    wide = [f for f in n if f not in direct]
    found = _pick(long, {**direct, **narrowed(wide)}, n) if n else {}
    missed = [f for f, v in found.items() if v is None]
    if missed:
        found.update(_pick(long, narrowed(missed), n))
    lost = [c for c in n if found.get(c) is None]
    if lost:
        raise RuntimeError(f"no median found for columns that have values: {lost[:5]}")
    return {c: ((found.get(c), n[c]) if c in n else (None, 0)) for c in cols}


def exact_medians(df: DataFrame, cols: list[str], accuracy: int = 10000) -> DataFrame:
    """``(feature, median double, n long)`` as a DataFrame (one row per column)."""
    med = median_map(df, cols, accuracy)
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("median", T.DoubleType()),
                           T.StructField("n", T.LongType())])
    return df.sparkSession.createDataFrame([(c, m, n) for c, (m, n) in med.items()], schema)
