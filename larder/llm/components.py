"""Connected components of a link table, by alternating large and small
stars: each round points every node at the smallest id it can see.  Links stay
rows of a table between rounds; nothing but a count reaches the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.frames import stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """``links`` (a, b) with a > b, one row each way are joined to the
    smallest neighbour of ``a``."""
    if large:
        ways = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        out = ways.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("m"))
        out = (links.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
               .union(least.select("a", F.col("m").alias("b"))))
    return out.where("a > b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node with a link, over rows (a, b); root is the
    smallest node it is connected to."""
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .distinct(), "links")
    for _ in range(max_rounds):
        last = links
        links = stage(_star(_star(last, True), False), "links")
        # stars point straight at their roots: no node is both ends
        if not links.join(links.select(F.col("a").alias("b")).distinct(), "b", "left_semi").limit(1).count() and \
                not links.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
            break
    else:
        raise RuntimeError(f"links did not settle in {max_rounds} rounds")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
