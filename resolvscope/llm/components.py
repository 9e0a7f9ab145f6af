"""Connected components of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from resolvscope.session import work_path


def _kept(frame: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = work_path(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def spread_join(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join on a key whose rows on the left may be many.

    The right side holds each key once, from an aggregate. Dealing it by a hash of the key first makes the join shuffle
    both sides itself, and only then can adaptive execution split a key with many rows.
    """
    return left.join(right.repartition(F.xxhash64(key)), key, how)


def _stars(links: DataFrame) -> bool:
    """Whether every node has one role and one root: then each component is a star around its smallest node."""
    ends = links.select(F.col("low").alias("node"), F.lit(1).alias("below"), F.lit(0).alias("above"))
    ends = ends.unionAll(links.select(F.col("high").alias("node"), F.lit(0).alias("below"), F.lit(1).alias("above")))
    roles = ends.groupBy("node").agg(F.max("below").alias("below"), F.sum("above").alias("above"))
    return roles.where("below + above > 1").isEmpty()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of links (a, b) but the roots: root is the smallest node it reaches.

    Alternates two steps until the links are stars: each node sends its larger neighbours to its smallest one, then its
    smaller neighbours to the smallest. Each step is an aggregate and a join, so a node with very many links is
    pre-aggregated and its join can be split. The number of rounds grows with the logarithm of the longest chain; links that
    are stars already take none, and more than ``rounds`` raises.
    """
    links = _kept(links.where("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).distinct(), "links")
    for _ in range(rounds):
        if _stars(links):
            return links.select(F.col("high").alias("node"), F.col("low").alias("root"))
        both = links.select(F.col("low").alias("u"), F.col("high").alias("v")).unionAll(links.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = spread_join(both.where("v > u"), least, "u").where("v <> m").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct()
        large = _kept(large, "links")
        down = large.groupBy("high").agg(F.min("low").alias("m"))
        joined = spread_join(large, down, "high")
        small = joined.where("low <> m").select(F.col("m").alias("low"), F.col("low").alias("high")).unionAll(joined.select(F.col("m").alias("low"), "high"))
        links = _kept(small.distinct(), "links")
    raise ValueError("links did not settle")
