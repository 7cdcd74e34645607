"""Connected components of a link table by alternating large-star and small-star.

Links stay in Spark; per round only two numbers reach the driver, to see whether
the round changed anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segflow.llm.common import cut, scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of u is tied to the least of u and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.where("v > u").join(least, "u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of u, and u, is tied to the least of them (v < u)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    tied = (edges.join(least, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return tied.unionByName(least.select("u", F.col("m").alias("v")))


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(id, label): the least id reachable, for each id that has a link.

    Links to oneself and null ends are ignored; repeated links count once.
    """
    edges = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .where("u <> v").distinct())
    with scratch(links.sparkSession, "components") as keep:
        edges = keep(edges)
        state = None
        for _ in range(max_rounds):
            seen = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if seen == state or seen[0] == 0:
                break
            state = seen
            edges = keep(_small_star(_large_star(edges).distinct()).distinct())
        else:
            raise RuntimeError("components did not settle")
        return cut(edges.select(F.col("u").alias("id"), F.col("v").alias("label"))
                   .unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("label")))
                   .groupBy("id").agg(F.min("label").alias("label")))
