"""Connected components of links, as joins and groupings of the link table alone.

Large-star and small-star rounds: every node hands its neighbours the smallest node it
knows, until each node hangs on its component's smallest. Minimums are aggregated before
the shuffle, so a hub's links don't meet in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.session import durable


def star(links: DataFrame, larger_only: bool) -> DataFrame:
    """One star round over links (a, b), a > b."""
    both = links if not larger_only else links.unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    # a table of its own: the join then deals out both sides and can split a hub
    least = durable(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least")), "least")
    joined = both.join(least, "a")
    moved = joined.select(
        F.greatest("b", "least").alias("a"), F.least("b", "least").alias("b"), F.col("a").alias("own"), "least"
    )
    if larger_only:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        return moved.where("a <> b").distinct()
    own = least.select("a", F.col("least").alias("b"))
    return moved.select("a", "b").unionByName(own).where("a <> b").distinct()


def settled(links: DataFrame) -> bool:
    """Does each node hang on one node that itself hangs on none?"""
    ends = links.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        links.select(F.col("b").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.max("down").alias("downs"))
    return per_node.where("ups > 1 or (ups > 0 and downs > 0)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """node, root: every node of a link and the smallest node it is joined with."""
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = durable(links.where("a <> b").distinct(), "links")
    while not settled(links):
        links = durable(star(durable(star(links, True), "large"), False), "small")
    root = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def extended(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The components of ``roots`` (a written table) after further links: only links
    between different roots are followed, so no round sees the old links again."""
    of_a = roots.select(F.col("node").alias("a"), F.col("root").alias("root_a"))
    of_b = roots.select(F.col("node").alias("b"), F.col("root").alias("root_b"))
    between = links.join(of_a, "a", "left").join(of_b, "b", "left")
    between = between.select(
        F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b")
    )
    tops = durable(components(between), "tops")
    renamed = tops.select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = roots.join(renamed, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    return old.unionByName(tops.join(roots, "node", "left_anti"))
