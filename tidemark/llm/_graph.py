"""Connected components by alternating large-star / small-star rounds.

Each round is two aggregations and two joins over the links; the links are
written to the shared checkpoint folder between rounds. Nothing is collected
but one (count, checksum) row per round. Rounds grow with the logarithm of the
longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize

MAX_ROUNDS = 60


def _star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    big = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    big = big.filter("u != v").distinct()
    low = big.groupBy("u").agg(F.min("v").alias("m"))
    small = big.join(low, "u").select(
        F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
        F.col("m").alias("v"))
    heads = low.select("u", F.col("m").alias("v"))
    return small.union(heads).filter("u != v").distinct()


def components(links: DataFrame) -> DataFrame:
    """links (u long, v long, u != v) -> (node, root) for every node that has a
    link and is not its component's smallest; root is that smallest node."""
    links = materialize(links.select("u", "v").distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if tuple(mark) == seen or not mark[0]:
            break
        seen = tuple(mark)
        links = materialize(_star(links), "links")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
