"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round rewrites the links so that nodes point at ever smaller neighbours; the number of
rounds grows with the logarithm of the longest path. A round is two joins and aggregates of
narrow rows, written to the shared folder, so nothing is collected and lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docmart.llm.common import materialize


def _smallest(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included (combined map-side: hubs are safe)."""
    return links.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    m = materialize(_smallest(both), "component_min")
    return (both.filter("b > a").join(m, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct())


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    m = materialize(_smallest(down), "component_min")
    return (down.join(m, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(m.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())


def _mark(links: DataFrame) -> tuple:
    """What changes while the links still move."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component): every node of ``links`` (columns a, b) with its smallest reachable node.

    Nodes without links do not appear. An empty link table gives an empty result.
    """
    links = materialize(links.filter("a <> b").distinct(), "component_links")
    mark = _mark(links)
    while mark[0]:
        links = materialize(_small_star(materialize(_large_star(links), "component_large")),
                            "component_links")
        last, mark = mark, _mark(links)
        if mark == last:
            break
    roots = links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
