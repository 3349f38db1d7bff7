"""Rate limits: calls in a trailing window per user and resource."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing_calls(events: DataFrame, keys: list[str], ts: str, seconds: int) -> DataFrame:
    """Every event with ``calls``: events of its keys in the ``seconds`` up to it, both ends and
    the event itself included. Null times count with one another, as in SQL.

    Events are cut into buckets as long as the window, and each is also shown to the next
    bucket; so a key with a third of all events is counted by as many tasks as it has buckets.
    """
    span = seconds * 1_000_000
    x = events.withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    x = x.withColumn("_b", F.floor(F.col("_t") / span))
    both = F.explode(F.array(F.struct(F.lit(True).alias("own"), F.col("_b").alias("b")), F.struct(F.lit(False).alias("own"), (F.col("_b") + 1).alias("b")))).alias("_x")
    w = Window.partitionBy(*keys, "_x.b").orderBy("_t").rangeBetween(-span, 0)
    return x.select("*", both).withColumn("calls", F.count("*").over(w)).where("_x.own").drop("_t", "_b", "_x")


def exceeded(events: DataFrame, keys: list[str], ts: str, seconds: int, per_second: float) -> DataFrame:
    """Events whose trailing calls per second are above the limit (strictly)."""
    return trailing_calls(events, keys, ts, seconds).where(F.col("calls") / seconds > per_second)
