"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlweave.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the smallest node it is linked with over any number of steps.

    ``links`` has two long columns ``a`` and ``b``; nodes without a link are not returned. Large-star and small-star
    steps in turn (Kiveris et al., 2014) until nothing changes. A node's neighbours meet only as a minimum, which is
    combined before the shuffle, and in a join on the node, which the session may split.
    """
    edges = written(links.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct(), "links")
    mark = None
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").selectExpr("b AS a", "m AS b")
        large = written(large.where("a <> b").distinct(), "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.selectExpr("b AS a", "m AS b").union(least.selectExpr("a", "m AS b"))
        edges = written(small.where("a <> b").distinct(), "small-star")
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark:
            break
        mark = now
    return edges.selectExpr("a AS node", "b AS label").union(edges.selectExpr("b AS node", "b AS label").distinct())
