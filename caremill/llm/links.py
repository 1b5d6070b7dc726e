"""Connected components of a table of links, by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caremill.llm.storage import dropped, stored


def _starred(rows: DataFrame, name: str) -> DataFrame:
    """(u, v, m): each row with the smallest of u and all its v. The minima are stored, so that the join can split
    the rows of a node that very many are linked to."""
    least = stored(rows.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
    return rows.join(least, "u")


def components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node that links lead to) of all nodes in ``links`` (a, b). Nothing is
    collected; a round is a few joins, and the number of rounds grows with the logarithm of the nodes."""
    edges = stored(links.selectExpr("greatest(a, b) AS u", "least(a, b) AS v").filter("u <> v").distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.selectExpr("v AS u", "u AS v"))
        large = stored(_starred(both, "large").filter("v > u").selectExpr("v AS u", "m AS v").distinct(), "large")
        small = _starred(large, "small")
        downward = small.filter("v <> m").selectExpr("v AS u", "m AS v")
        after = stored(downward.unionByName(small.selectExpr("u", "m AS v")).distinct(), "links")
        state = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        dropped(edges, large)
        edges = after
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.selectExpr("u AS node", "v AS component").unionByName(roots)
