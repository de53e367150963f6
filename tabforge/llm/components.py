"""Connected components of a link table, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.llm.common import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) to (node, root): nodes of one component share a root, its smallest node.

    Each round every node takes the smallest of itself and its neighbours as its new name, links
    are renamed, and loops and repeated links go; the links of a star end in one round, those of
    a path of randomly named nodes shrink by a constant factor. Names are composed along the way.
    """
    links = materialize(edges.filter(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    names = None
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_least"))
        step = materialize(
            least.select(F.col("a").alias("node"), F.least("a", "_least").alias("root")), "links-names"
        )
        if names is None:
            names = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("_root"))
            names = materialize(
                names.join(onward, "root", "left").select("node", F.coalesce("_root", "root").alias("root")), "links-names"
            )
        a = step.withColumnsRenamed({"node": "a", "root": "_a"})
        b = step.withColumnsRenamed({"node": "b", "root": "_b"})
        renamed = links.join(a, "a").join(b, "b").filter(F.col("_a") != F.col("_b"))
        links = materialize(
            renamed.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(), "links"
        )
        if links.isEmpty():
            return names
