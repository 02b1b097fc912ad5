"""Connected components of a graph given as a table of links, by alternating stars.

In a large-star step every node sends its larger neighbours to the least of its neighbourhood, in a small-star step the
smaller ones; the links shrink to one star per component.  A step is one aggregate (least neighbour per node, combined
before the shuffle) and one join, so a node with many links is a skewed join that adaptive execution splits.  Each round
is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.tables import stored


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_least(both), "u").where("v > u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    rest = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return rest.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node, root`` for every linked node but the roots themselves, from links ``u, v`` between longs.

    ``root`` is the least node reachable.  Links to itself are ignored; no links give an empty table.
    """
    links = stored(links.select("u", "v").where("u <> v").distinct(), "links")
    state = None
    for _ in range(most_rounds):
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now
        links = stored(_small_star(_large_star(links)), "links")
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")
