"""Connected components over an edge table, in shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiframe.llm.common import discard, staged


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` has two columns ``u`` and ``v``; returns ``node, root`` for every node on an edge.

    Alternates the large-star and small-star steps until the edges stand still; each round is written to
    the shared folder, so a lost executor costs a round at most, and deleted once the next one is written. The root is the smallest node. Self
    loops and repeated edges are allowed, null ends are dropped, no edges give no rows.
    """
    now = staged(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    seen = None
    for _ in range(max_rounds):
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        seen = mark
        both = now.union(now.select("v", "u"))
        # written, so that AQE can split the join on a hub that a third of all nodes hang on
        low = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        last, now = now, staged(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "cc")
        discard(last, low)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
