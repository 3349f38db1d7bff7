"""Incremental forms of the batch operators on Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import manifest
from ..sources import writers


def call_windows(events: DataFrame, user: str, resource: str, ts: str, every: str = "1 hour", late: str | None = "2 hours") -> DataFrame:
    """Calls per (user, resource) and tumbling window; the same plan in batch and streaming.
    In a stream, events later than ``late`` are dropped from closed windows."""
    x = events.withWatermark(ts, late) if late and events.isStreaming else events
    return x.groupBy(F.window(ts, every).alias("w"), F.col(user), F.col(resource)).agg(F.count("*").alias("calls")).select(F.col("w.start").alias("window_start"), user, resource, "calls")


def first_requests(requests: DataFrame, url: str, ts: str, late: str = "1 day") -> DataFrame:
    """Each URL once; a repeat within the watermark is dropped, state stays bounded by it."""
    if requests.isStreaming:
        return requests.withWatermark(ts, late).dropDuplicatesWithinWatermark([url])
    return requests.dropDuplicates([url])


def keep_manifest(rows: DataFrame, path: str, key: str, fields: list[str], checkpoint: str) -> StreamingQuery:
    """Upsert a stream of rows into a manifest table: versions alternate between two folders,
    so a batch that is run again reads what the last complete one wrote."""

    def batch(df: DataFrame, number: int) -> None:
        spark = df.sparkSession
        old = f"{path}/v={number - 1}"
        new = manifest.upsert(df, key, [F.xxhash64(*fields)], fields)
        if number > 0:
            new = manifest.merge(spark.read.parquet(old), new, key, fields)
        new.write.mode("overwrite").parquet(f"{path}/v={number}")

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def reload_organisations(rows: DataFrame, path: str, checkpoint: str, column: str = "organisation") -> StreamingQuery:
    """Every batch replaces the organisations it holds."""
    return rows.writeStream.foreachBatch(lambda df, _: writers.reload_partition(df, path, column)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
