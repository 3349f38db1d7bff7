"""Session helpers: table access, record de-delivery and lineage cuts on shared storage."""

from __future__ import annotations

import atexit
import pathlib
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "8", partitions: int = 8) -> SparkSession:
    """A local session for tests, the bench and the command line."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that they need no install."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    here = pathlib.Path(__file__).resolve().parent
    out = pathlib.Path(tempfile.mkdtemp(prefix="citeloom-code-")) / f"{here.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(here.rglob("*.py")):
            z.write(f, f.relative_to(here.parent))
    sc.addPyFile(str(out))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_delivery(df: DataFrame, key: str, at: str | None = None) -> DataFrame:
    """One row per ``key``: the delivery with the latest ``at`` (ties by the whole row).

    Rows whose key is null are dropped: they name no record. An empty table stays empty.
    Aggregates map-side first, so a key delivered very often never meets in one task.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.where(F.col(key).isNotNull()).distinct()
    order = ([F.col(at)] if at in rest else []) + [F.xxhash64(*rest)]
    packed = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(packed)
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir. Only a local master may do without: its
    executors share the driver's temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = _LOCAL.setdefault("root", f"file://{tempfile.mkdtemp(prefix='citeloom-')}")
    return root


def scratch(spark: SparkSession) -> str:
    """A new folder name in the shared folder, removed when the driver's Python ends."""
    path = f"{checkpoint_root(spark)}/citeloom/{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


_LOCAL: dict[str, str] = {}
_WRITTEN: list[tuple[SparkSession, str]] = []


def cut(df: DataFrame, *partition_hint: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    The lineage ends at files that every executor can read again, so a lost executor costs
    only its own tasks. Files are removed when the driver's Python ends.
    """
    spark = df.sparkSession
    path = scratch(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _remove_written() -> None:
    for spark, path in _WRITTEN:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the JVM may be gone already
            return
