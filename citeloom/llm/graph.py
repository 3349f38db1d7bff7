"""Connected components without collecting links or labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(v, root) for every vertex of the edges (u, v) of long ids; root is the least vertex.

    Large-star and small-star rounds (Kiveris et al. 2014): each halves distances to the
    root, and a star with many leaves is only ever aggregated, never gathered. Raises if
    the edges still change after ``max_rounds``. No edges give no rows.
    """
    e = cut(edges.where("u <> v").select(F.least("u", "v").alias("lo"), F.greatest("u", "v").alias("hi")).distinct())

    def digest(x: DataFrame):
        return tuple(x.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())

    last = digest(e)
    for _ in range(max_rounds):
        both = e.select(F.col("lo").alias("a"), F.col("hi").alias("b")).union(e.select(F.col("hi").alias("a"), F.col("lo").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("lo"), F.col("b").alias("hi")).where("lo <> hi").distinct()
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(down, "hi")
        e = cut(small.select(F.col("m").alias("lo"), "hi").union(small.select(F.least("m", "lo").alias("lo"), F.greatest("m", "lo").alias("hi"))).where("lo <> hi").distinct())
        now = digest(e)
        if now == last:
            roots = e.groupBy("hi").agg(F.min("lo").alias("root")).select(F.col("hi").alias("v"), "root")
            return roots.union(roots.select(F.col("root").alias("v"), "root").distinct())
        last = now
    raise RuntimeError("components did not settle; raise max_rounds")
