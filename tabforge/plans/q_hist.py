"""Queries: histogram booster (LRN2, LRN5): the split-gain core against SQL,
and a fit on unimputed order features (missing values routed by the
learner)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import blocks, hist, sample
from ..operators.encode import CategoryEncoder
from ..sources.tables import read_table
from . import fixtures as fx
from .budgets import QUERIES as BUDGET
from .registry import query, r6


_ROOT_SQL = """
WITH r AS (SELECT CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END AS y,
                  CAST(l_quantity AS INTEGER) AS b0,
                  coalesce(NULLIF(CAST(round(l_discount * 100) AS INTEGER), 0), -1) AS b1
           FROM lineitem),
e AS (SELECT 0 AS f, b0 AS b, 0.5e0 - y AS g FROM r UNION ALL SELECT 1 AS f, b1 AS b, 0.5e0 - y AS g FROM r),
hst AS (SELECT f, b, sum(g) AS G, count(*) * 0.25e0 AS H FROM e GROUP BY f, b),
tot AS (SELECT sum(0.5e0 - y) AS Gt, count(*) * 0.25e0 AS Ht FROM r),
cum AS (SELECT f, b, sum(G) OVER (PARTITION BY f ORDER BY b ROWS UNBOUNDED PRECEDING) AS GLc,
               sum(H) OVER (PARTITION BY f ORDER BY b ROWS UNBOUNDED PRECEDING) AS HLc
        FROM hst WHERE b >= 0),
miss AS (SELECT f, G AS Gm, H AS Hm FROM hst WHERE b < 0),
c AS (SELECT cum.f, cum.b, GLc, HLc, coalesce(Gm, 0e0) AS Gm, coalesce(Hm, 0e0) AS Hm, Gt, Ht
      FROM cum LEFT JOIN miss ON cum.f = miss.f, tot),
d AS (SELECT f, b, false AS missing_left, GLc AS GL, HLc AS HL, Gt, Ht FROM c
      UNION ALL SELECT f, b, true AS missing_left, GLc + Gm AS GL, HLc + Hm AS HL, Gt, Ht FROM c)
SELECT CAST(f AS INTEGER) AS f, CAST(b AS INTEGER) AS b, missing_left,
       round(GL * GL / (HL + 1e0) + (Gt - GL) * (Gt - GL) / (Ht - HL + 1e0) - Gt * Gt / (Ht + 1e0), 6)
         AS gain
FROM d WHERE HL >= 1e0 AND Ht - HL >= 1e0
"""


@query("root_split_gain", sql=_ROOT_SQL)
def root_split_gain(spark, sf_dir):
    """Every split that the booster scores at the root."""
    found = _root_pass(spark, sf_dir, every=True)
    return found.filter("kind = 0").select("f", "b", "missing_left", r6("gain").alias("gain"))


def _root_pass(spark, sf_dir, every):
    li = read_table(spark, sf_dir, "lineitem")
    # Ordered codes: the quantity, and the discount in percent with 0 as a gap.
    rows = li.select(F.monotonically_increasing_id().alias("id"), (F.col("l_returnflag") == "R").cast("double").alias("y"),
                     F.col("l_quantity").cast("int").alias("q"),
                     F.nullif(F.round(F.col("l_discount") * 100).cast("int"), F.lit(0)).alias("d"))
    cols = ["q", "d"]
    layout = hist.layout_of(cols, dict.fromkeys(cols), hist.count_codes(rows, cols))
    table = blocks.pack(rows, cols, layout, "id", "y", None, blocks.TRAIN, 0.0)
    work = blocks.Pass(layout=layout, splitting=blocks.Splitting(1.0, 0.0, 0.0, 1.0), depth=1, recent=[], active=[0], every=every)
    return blocks.found(table, [work], 1)


@query("root_split_best", sql=f"""
SELECT f, b, missing_left, gain FROM ({_ROOT_SQL}) ORDER BY gain DESC, f, b, missing_left LIMIT 1
""")
def root_split_best(spark, sf_dir):
    """The split that the booster takes at the root."""
    return _root_pass(spark, sf_dir, every=False).select("f", "b", "missing_left", r6("gain").alias("gain"))


def _level_sql(rows: str, name: str) -> str:
    """CTEs that find the best split of every node of ``rows`` (node, y, q, d): ``<name>`` (node, f, v, nxt,
    missing_left, gain, gl, hl, g, h)."""
    return f"""
{name}_e AS (SELECT node, 0 AS f, q AS v, 0.5e0 - y AS g FROM {rows} UNION ALL SELECT node, 1 AS f, d AS v, 0.5e0 - y AS g FROM {rows}),
{name}_h AS (SELECT node, f, v, sum(g) AS g, count(*) * 0.25e0 AS h FROM {name}_e GROUP BY ALL),
{name}_t AS (SELECT node, sum(0.5e0 - y) AS gt, count(*) * 0.25e0 AS ht FROM {rows} GROUP BY node),
{name}_c AS (SELECT node, f, v, lead(v) OVER w AS nxt, sum(g) OVER w AS gl, sum(h) OVER w AS hl FROM {name}_h WHERE v IS NOT NULL
             WINDOW w AS (PARTITION BY node, f ORDER BY v)),
{name}_m AS (SELECT c.*, gt, ht, coalesce(m.g, 0e0) AS gm, coalesce(m.h, 0e0) AS hm FROM {name}_c c JOIN {name}_t USING (node)
             LEFT JOIN {name}_h m ON m.node = c.node AND m.f = c.f AND m.v IS NULL),
{name}_d AS (SELECT node, f, v, nxt, false AS missing_left, gl, hl, gt, ht FROM {name}_m
             UNION ALL SELECT node, f, v, nxt, true AS missing_left, gl + gm, hl + hm, gt, ht FROM {name}_m),
{name} AS (SELECT *, gl * gl / (hl + 1e0) + (gt - gl) * (gt - gl) / (ht - hl + 1e0) - gt * gt / (ht + 1e0) AS gain
           FROM {name}_d WHERE hl >= 1e0 AND ht - hl >= 1e0
           QUALIFY row_number() OVER (PARTITION BY node ORDER BY gl * gl / (hl + 1e0) + (gt - gl) * (gt - gl) / (ht - hl + 1e0) DESC,
                                      f, v, missing_left) = 1)"""


_TREE_SQL = f"""
WITH r0 AS (SELECT 0 AS node, CASE WHEN l_returnflag = 'R' THEN 1e0 ELSE 0e0 END AS y, CAST(l_quantity AS DOUBLE) AS q,
                   CAST(NULLIF(round(l_discount * 100), 0) AS DOUBLE) AS d FROM lineitem), {_level_sql("r0", "a")},
r1 AS (SELECT CASE WHEN coalesce(CASE WHEN a.f = 0 THEN q ELSE d END <= a.v, a.missing_left) THEN 1 ELSE 2 END AS node, y, q, d
       FROM r0, a WHERE a.gain > 0), {_level_sql("r1", "b")},
splits AS (SELECT * FROM a WHERE gain > 0 UNION ALL SELECT * FROM b WHERE gain > 0),
children AS (SELECT 2 * node + 1 AS node, gl AS g, hl AS h FROM splits UNION ALL SELECT 2 * node + 2, gt - gl, ht - hl FROM splits)
SELECT CAST(node AS INTEGER) AS node, CASE WHEN f = 0 THEN 'q' ELSE 'd' END AS feature, round(coalesce(nxt, 1e9), 6) AS threshold,
       missing_left, round(gain, 6) AS gain, CAST(NULL AS DOUBLE) AS leaf_value FROM splits
UNION ALL SELECT CAST(node AS INTEGER), NULL, NULL, NULL, NULL, round(-0.3e0 * g / (h + 1e0), 6) FROM children
WHERE node NOT IN (SELECT node FROM splits)
"""


@query("tree_nodes", sql=_TREE_SQL)
def tree_nodes(spark, sf_dir):
    """LRN2 + SNK6: the node table of a fitted tree of depth 2 on all line items, gaps included."""
    li = read_table(spark, sf_dir, "lineitem")
    rows = li.select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"), (F.col("l_returnflag") == "R").cast("int").alias("y"),
                     F.col("l_quantity").cast("double").alias("q"),
                     F.nullif(F.round(F.col("l_discount") * 100), F.lit(0)).cast("double").alias("d"))
    model = hist.fit_hist(rows, ["q", "d"], "y", "id", params=hist.HistParams(n_rounds=1, max_depth=2))
    nodes = model.node_table(spark)
    return nodes.select("node", "feature", r6(F.when(F.col("threshold") > 1e9, 1e9).otherwise(F.col("threshold"))).alias("threshold"), "missing_left",
                        r6("gain").alias("gain"), r6("leaf_value").alias("leaf_value"))


@query("fixed_tree_score", sql="""
SELECT l_orderkey, l_linenumber, round(1e0 / (1e0 + exp(-(
    CASE WHEN l_quantity < 10 THEN CASE WHEN d IS NULL OR d >= 0.05e0 THEN -0.5e0 ELSE 0.25e0 END
         WHEN l_quantity < 30 THEN 0.75e0 ELSE -1e0 END
  + CASE WHEN d IS NULL OR d < 0.03e0 THEN 0.1e0 ELSE -0.2e0 END))), 6) AS p
FROM (SELECT *, NULLIF(l_discount, 0e0) AS d FROM lineitem)
""")
def fixed_tree_score(spark, sf_dir):
    """LRN11: two given trees walked by the scoring expression, missing cells included."""
    trees = [hist.HistTree({0: (0, 0, False, 1.0), 1: (1, 1, False, 1.0), 2: (0, 1, False, 1.0)},
                           {3: 0.25, 4: -0.5, 5: 0.75, 6: -1.0}),
             hist.HistTree({0: (1, 0, True, 1.0)}, {1: 0.1, 2: -0.2})]
    model = hist.HistModel(cols=["l_quantity", "d"], cuts={"l_quantity": [10.0, 30.0], "d": [0.03, 0.05]},
                           params=hist.HistParams(max_depth=2), base_margin=0.0, trees=trees, best_iteration=1)
    li = read_table(spark, sf_dir, "lineitem").withColumn("d", F.nullif(F.col("l_discount"), F.lit(0.0)))
    scored = model.predict_proba(li, ["l_orderkey", "l_linenumber"])
    return scored.select("l_orderkey", "l_linenumber", r6("p").alias("p"))


_HIST_COLS = ["n_lines", "sum_qty", "avg_discount", "max_tax", "total_price", "status", "priority"]


def hist_fit(spark, sf_dir):
    of = fx.order_features(spark, sf_dir)
    train, val = sample.split_exact(of, "id", 0.8, 42)
    enc = CategoryEncoder(["status", "priority"]).fit(train)
    train, val = enc.transform(train), enc.transform(val)   # NULL codes stay NULL (missing)
    p = hist.HistParams(n_rounds=BUDGET.rounds, max_depth=BUDGET.depth, eta=0.3, max_bins=BUDGET.max_bins, subsample=0.8,
                        colsample_bytree=0.8, reg_alpha=0.1, gamma=0.1, patience=BUDGET.patience)
    model = hist.fit_hist(train, _HIST_COLS, "label", "id", params=p, val=val, categorical=["status", "priority"])
    return model, val


@query("hist_booster_history")
def hist_booster_history(spark, sf_dir):
    """LRN2 + LRN8/LRN9: eval PR-AUC per round of the histogram booster
    trained on unimputed features."""
    model, _ = hist_fit(spark, sf_dir)
    return hist.history_frame(spark, model).select("round", r6("value").alias("aucpr"))


@query("hist_booster_score")
def hist_booster_score(spark, sf_dir):
    """LRN2 + LRN11: val probabilities at the best iteration."""
    model, val = hist_fit(spark, sf_dir)
    return model.predict_proba(val, ["id", "label"]).select("id", "label", r6("p").alias("p"))
