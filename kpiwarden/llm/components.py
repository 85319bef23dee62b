"""Connected components of a graph given as edges, by alternating stars.

Each round points the larger neighbours of every node, then the smaller ones, at the
least of them. Both halves are joins and grouped minima: a node with very many
neighbours is summed up before the shuffle, and its rows can be split over tasks in the
join. Rounds are few (logarithmic in the length of the longest chain). Every round is
written to the shared scratch folder, which also cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiwarden.sources.scratch import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node that has an edge; ``root`` is the least node reachable.

    Edges may repeat, be given either way round, or lead from a node to itself; rows
    with a null end are ignored.
    """
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    )
    links = stored(links.distinct(), "links")
    state = _state(links)
    while state[0]:
        links = stored(_small_star(_large_star(links)), "links")
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select("node", "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy("node").agg(F.min("root").alias("least"))
    least = least.select(F.col("node").alias("centre"), F.least("node", "least").alias("least"))
    joined = both.join(least, both["node"] == least["centre"]).where("root > node")
    return joined.select(F.col("root").alias("node"), F.col("least").alias("root"))


def _small_star(links: DataFrame) -> DataFrame:
    links = links.where("node != root")
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    least = least.select(F.col("node").alias("centre"), "least")
    joined = links.join(least, links["node"] == least["centre"])
    moved = joined.where("root != least").select(F.col("root").alias("node"), F.col("least").alias("root"))
    kept = least.select(F.col("centre").alias("node"), F.col("least").alias("root"))
    return moved.unionByName(kept).distinct()


def _state(links: DataFrame) -> tuple:
    """Changes whenever the set of links does."""
    mark = F.xxhash64("node", "root")
    row = links.agg(F.count(F.lit(1)), F.sum(mark.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftright(mark, 32))).first()
    return tuple(row)
