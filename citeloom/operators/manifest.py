"""The crawl manifest: upserts, prefix buckets, per-organisation reloads, latest files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(rows: DataFrame, key: str, seq: list[Column], fields: list[str]) -> DataFrame:
    """Last write wins per key; null and empty keys are dropped. Aggregates map-side."""
    x = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return x.groupBy(key).agg(F.max_by(F.struct(*fields), F.struct(*seq)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in fields])


def merge(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with the same key; other old rows stay."""
    both = old.select(key, *fields, F.lit(0).alias("_s")).unionByName(new.select(key, *fields, F.lit(1).alias("_s")))
    return upsert(both, key, [F.col("_s"), F.xxhash64(*fields)], fields)


def buckets(rows: DataFrame, key: str, chars: int = 2) -> DataFrame:
    """(prefix, hashes): distinct keys by their first characters, sorted."""
    x = rows.where(F.col(key).isNotNull() & (F.col(key) != ""))
    return x.groupBy(F.substring(key, 1, chars).alias("prefix")).agg(F.array_sort(F.collect_set(key)).alias("hashes"))


def read_manifest(m: DataFrame) -> DataFrame:
    """(hash, data) of a manifest row with content map<prefix, array<hash>> and data map<hash, struct>;
    hashes without data keep a null."""
    h = m.select(F.explode("content").alias("prefix", "hs"), "data").select("prefix", F.explode("hs").alias("hash"), "data")
    return h.select("prefix", "hash", F.try_element_at("data", F.col("hash")).alias("data"))


def reload(old: DataFrame, new: DataFrame, organisation: str, column: str = "organisation") -> DataFrame:
    """Rows of one organisation replaced by new ones: doing it twice changes nothing."""
    keep = F.col(column).isNull() | (F.col(column) != organisation)
    return old.where(keep).unionByName(new.where(F.col(column) == organisation))


def dimension_ids(known: DataFrame, names: DataFrame, name: str, number: str) -> DataFrame:
    """(name, number) for all names: known ones keep their number, new ones follow the greatest
    in order of name. A dimension is small by nature: new names are numbered in one task."""
    from pyspark.sql import Window

    new = names.select(name).where(F.col(name).isNotNull()).distinct().join(known.select(name), name, "left_anti")
    top = known.agg(F.coalesce(F.max(number), F.lit(0)).alias("_top"))
    rank = F.row_number().over(Window.orderBy(name))
    new = new.withColumn("_r", rank).crossJoin(F.broadcast(top)).select(name, (F.col("_top") + F.col("_r")).cast("long").alias(number))
    return known.select(name, F.col(number).cast("long").alias(number)).unionByName(new)


def delete_organisation_of_policies(citations: DataFrame, organisation: str, policies: str = "policies") -> DataFrame:
    """Citations without those of which some policy belongs to ``organisation``."""
    return citations.where(~F.coalesce(F.exists(policies, lambda p: p["organisation"] == organisation), F.lit(False)))
