"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, drop_staged, staged


def _mark(edges: DataFrame):
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame, least_path: str) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # written before it is joined: AQE then splits the exchange of a node with very many neighbours
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least", least_path)
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) of every node of `edges` (u, v) that is not its component's smallest; no self-loops needed.

    Each round is written to the shared folder, so the lineage stays short and only counts reach the driver.
    An empty edge table gives an empty result; repeated edges and both directions do no harm; edges with a null end
    must not be given.
    """
    spark = edges.sparkSession
    path = work.fresh_path("edges")
    now = staged(edges.select("u", "v").where("u != v").distinct(), "edges", path)
    mark = _mark(now)
    while mark[0]:
        following, least = work.fresh_path("edges"), work.fresh_path("least")
        after = staged(_small_star(_large_star(now, least)), "edges", following)
        drop_staged(spark, path)
        drop_staged(spark, least)
        now, path = after, following
        if (new := _mark(now)) == mark:
            break
        mark = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
