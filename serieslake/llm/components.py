"""Connected components of a link table, by alternating stars; no group is ever gathered in a task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from serieslake.session import materialize


def _smallest(edges: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours v.  Hubs are summed up by the tasks that hold them."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both.join(_smallest(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _smallest(down)
    spread = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return spread.unionByName(least.select("u", F.col("m").alias("v")))


def _settled(edges: DataFrame) -> bool:
    """Whether the edges, larger end first, are stars: no node has two links to smaller ones, or one and larger ones too."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")),
    )))
    return ends.groupBy("node").agg((F.sum("below") + F.max("above")).alias("n")).filter("n > 1").isEmpty()


def components(links: DataFrame, most_rounds: int = 50) -> DataFrame:
    """node, root for every node of ``links(a, b)``; root is the component's smallest node.

    Each round is written to the shared folder, so a lost executor costs one round at most.  Links
    with a null end are no links; repeated links and links to oneself do no harm.
    """
    edges = materialize(
        links.select(F.col("a").alias("u"), F.col("b").alias("v")).filter("u <> v").distinct(), "links"
    )
    for _ in range(most_rounds):
        large = _large_star(edges).filter("u <> v").distinct()
        edges = materialize(_small_star(large).filter("u <> v").distinct(), "stars")
        if _settled(edges):
            roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    raise RuntimeError(f"links did not settle in {most_rounds} rounds")
