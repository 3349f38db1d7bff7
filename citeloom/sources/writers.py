"""Writers: gzipped JSON lines, CSV and JSON exports, idempotent reloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def json_lines(df: DataFrame, path: str) -> None:
    """Gzipped JSON lines; ValueError unless the path ends in .json.gz. Null fields are kept."""
    if not path.endswith(".json.gz"):
        raise ValueError("the path must end in .json.gz")
    df.write.mode("overwrite").option("compression", "gzip").option("ignoreNullFields", False).json(path)


def csv_export(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header, doubled quotes; ``single`` writes one file."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def json_export(df: DataFrame, path: str) -> None:
    """One JSON array in one file, null for no rows. For results that one task can hold."""
    from ..operators.search import json_array

    json_array(df).coalesce(1).write.mode("overwrite").text(path)


def two_outputs(df: DataFrame, first: str, second: str, derive) -> DataFrame:
    """Two outputs from one pass over ``df``: it is written to ``first`` as it is; what
    ``derive`` makes of the written rows goes to ``second`` and is returned. Both are gzipped
    JSON lines; an empty result is a readable, empty dataset."""
    json_lines(df, first)
    written = df.sparkSession.read.schema(df.schema).json(first)
    out = derive(written)
    json_lines(out, second)
    return df.sparkSession.read.schema(out.schema).json(second)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def columns_of(spark: SparkSession, path: str) -> dict[str, str]:
    """{column: type} of a stored table; empty if there is none."""
    return dict(spark.read.parquet(path).dtypes) if exists(spark, path) else {}


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.parquet(path).count() if exists(spark, path) else 0


def recreate(df: DataFrame, path: str) -> None:
    """Drop a stored table, if any, and write ``df`` in its place."""
    df.write.mode("overwrite").parquet(path)


def delete_where(spark: SparkSession, path: str, condition: Column, to: str) -> int:
    """Write the rows of a stored table that ``condition`` does not hold for (unknown counts as
    not) to ``to`` and return the rows kept; a table can't be read and replaced at once."""
    kept = spark.read.parquet(path).where(~F.coalesce(condition, F.lit(False)))
    recreate(kept.limit(0), to)
    return append_counted(kept, to)


def save_object(spark: SparkSession, content: bytes, path: str) -> None:
    """One object from bytes, replacing any of its name."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def append_counted(df: DataFrame, path: str) -> int:
    """Append to a Parquet table and return the rows written, counted while writing."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
    return seen.get["n"]


def reload_partition(df: DataFrame, path: str, column: str = "organisation") -> None:
    """Replace exactly the partitions that ``df`` holds; running it twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def index_records(df: DataFrame, index: str) -> DataFrame:
    """Records wrapped for an index: (_index, doc struct)."""
    return df.select(F.lit(index).alias("_index"), F.struct(*df.columns).alias("doc"))


def index_name(index: str, test: bool) -> str:
    return f"index-{index}" + ("-test" if test else "")


def datestamped(name: str, day: str) -> str:
    """``day`` before the first dot of a file name."""
    head, dot, tail = name.partition(".")
    return f"{head}_{day}{dot}{tail}" if dot else f"{name}_{day}"
