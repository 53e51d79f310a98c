"""Connected components by alternating large-star and small-star steps.

Every step is a ``min`` per node (pre-aggregated per task, so a hub is no hot
key) and a join of the links with one row per node, which Spark may split at a
hub. Each round is written below the shared scratch folder. The links end as
stars: each node with the least node of its component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ballotbox.llm.common import materialize

ROUNDS = 100
SHARE = 32          # links are far fewer than what they were found in


def _largest_first(links: DataFrame) -> DataFrame:
    return links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> node, component for every node with a link to another."""
    links = materialize(_largest_first(links).distinct(), "links", SHARE)
    seen = None
    for _ in range(ROUNDS):
        # large star: larger neighbours of u go to the least of u and its neighbours
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _largest_first(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        # small star: u and its smaller neighbours go to the least of them
        large = materialize(large.distinct(), "links", SHARE)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(least.select("a", F.col("m").alias("b"))))
        links = materialize(_largest_first(small).distinct(), "links", SHARE)
        now = tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == seen:
            return (links.select(F.col("a").alias("node"), F.col("b").alias("component"))
                    .union(links.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
        seen = now
    raise RuntimeError(f"components not found within {ROUNDS} rounds")
