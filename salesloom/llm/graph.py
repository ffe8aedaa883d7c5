"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import forget, written


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _stars_only(edges: DataFrame) -> bool:
    """Whether every node has larger neighbours only or a single one, which is smaller."""
    ends = _both_ways(edges).groupBy("u").agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return ends.where("low < u AND (high > u OR low != high)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(u, v): for every node of ``edges`` (u, v) but the smallest of its component, the
    smallest.  Each step is a minimum per node and a join, both of which combine or
    split hot nodes; it makes no more rows than it gets, and the number of steps grows with
    the logarithm of the size.  A step is written as a table, so small ones are read back
    in few tasks.  Repeated links and loops are allowed."""
    stars = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v"))
    while not _stars_only(stars):
        # large star: the larger neighbours of each node hang on its smallest neighbour
        both = _both_ways(stars)
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: a node and its smaller neighbours hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        before, stars = stars, written(large.join(low, "u").select(
            F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")))
        forget(before)
    return stars.distinct()
