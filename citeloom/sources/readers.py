"""Readers: JSON lines, CSV, keyword files, manifests, latest files, document folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def json_lines(spark: SparkSession, path: str, schema: str, max_items: int | None = None, partitions: int | None = None) -> DataFrame:
    """JSON lines, plain or gzipped; a malformed line fails the read, a blank one is skipped.
    gzip is not splittable, so ``partitions`` spreads the rows after reading."""
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    df = df.limit(max_items) if max_items is not None else df
    return df.repartition(partitions) if partitions else df


def csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; quoted fields may hold line feeds and doubled quotes."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (r.schema(schema) if schema else r).csv(path)


def tables(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """All CSV files below a folder whose names end in ``suffix``, with the file of each row."""
    r = spark.read.option("header", True).option("recursiveFileLookup", True).option("pathGlobFilter", f"*{suffix}")
    return r.csv(folder).withColumn("file", F.col("_metadata.file_path"))


def first_rows(df: DataFrame, per: str, order: str) -> DataFrame:
    """The first row per group by ``order``, without a window over all rows."""
    rest = [c for c in df.columns if c != per]
    return df.groupBy(per).agg(F.min_by(F.struct(*rest), F.struct(order, F.xxhash64(*rest))).alias("_r")).select(per, *[f"_r.{c}" for c in rest])


def keyword_file(spark: SparkSession, path: str) -> list[str]:
    """Lower-cased lines of a keyword file without blank lines and # comments: a list that a
    query holds in its plan, so a small file by nature; all of it is read."""
    rows = spark.read.text(path).where((F.trim("value") != "") & ~F.col("value").startswith("#")).select(F.lower("value").alias("v"))
    return [r.v for r in rows.toLocalIterator()]


def location(url: str) -> str:
    """The path Spark reads for a URL: s3:// goes through the s3a file system, a bare path is local."""
    scheme, sep, rest = url.partition("://")
    return f"s3a://{rest}" if sep and scheme in ("s3", "manifests3") else url


def object_text(spark: SparkSession, folder: str, name: str) -> str | None:
    """The text of one object of a folder by its name; None if there is none."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location(folder)}/{name}")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    row = spark.read.text(str(path.toString()), wholetext=True).first()
    return row[0] if row else ""


def byte_range(spark: SparkSession, path: str, size: int) -> DataFrame:
    """(line_no, value): the whole lines within the first ``size`` bytes of one text file; a line
    that the range cuts is left out. The bytes are read once, by the driver: ``size`` is the
    caller's bound."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(location(path))
    stream = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(p)
    try:
        raw = bytes(stream.readNBytes(size))
        ended = stream.read() == -1
    finally:
        stream.close()
    lines = raw.split(b"\n")
    if not ended or lines[-1] == b"":
        lines.pop()  # cut by the range, or nothing after the last line feed
    return spark.createDataFrame([(i, x.decode("utf-8")) for i, x in enumerate(lines)], "line_no int, value string")


def byte_range_csv(spark: SparkSession, path: str, size: int, schema: str) -> DataFrame:
    """Rows of a CSV with a header within the first ``size`` bytes."""
    x = byte_range(spark, path, size).where("line_no > 0")
    return x.select(F.from_csv("value", schema, {"escape": '"'}).alias("r")).select("r.*")


def byte_range_json(spark: SparkSession, path: str, size: int, schema: str) -> DataFrame:
    """Rows of JSON lines within the first ``size`` bytes."""
    return byte_range(spark, path, size).where("value <> ''").select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def first_lines(spark: SparkSession, path: str, schema: str, most: int, required: list[str]) -> DataFrame:
    """Of the first ``most`` JSON lines of one file those in which every required key has a
    value; line_no counts from 0 over all lines."""
    x = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("_m"), F.spark_partition_id().alias("_p"))
    n = x.groupBy("_p").agg(F.count("*").alias("_n"), F.min("_m").alias("_first"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition of the file
    x = x.join(F.broadcast(n.select("_p", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"))), "_p")
    x = x.select((F.col("_base") + F.col("_m") - F.col("_first")).alias("line_no"), "value").where(F.col("line_no") < most)
    return x.select("line_no", F.from_json("value", schema).alias("r")).select("line_no", "r.*").dropna(subset=required)


def match_tables(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(Document id, WT_Ref_Id, ...) of all match files below a folder; the two columns, without
    rows, where there is none."""
    if files(spark, folder, f"*{suffix}").isEmpty():
        return spark.createDataFrame([], "`Document id` string, WT_Ref_Id string")
    return tables(spark, folder, suffix)


def manifest(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Manifests: one JSON document a file, or one a line."""
    from ..schemas import MANIFEST

    return spark.read.schema(MANIFEST).option("multiLine", not lines).json(path)


def files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """(path, modified, length) of the files below a folder; contents are not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(folder)
    return f.select("path", F.col("modificationTime").alias("modified"), "length")


def latest_file(spark: SparkSession, folder: str, glob: str = "*", by_name: bool = False) -> str | None:
    """Path of the newest file (or the greatest by name); None for an empty folder."""
    order = "path" if by_name else F.struct("modified", "path")
    return files(spark, folder, glob).agg(F.max_by("path", order)).first()[0]


def section_texts(spark: SparkSession, folder: str, sections: list[str]) -> DataFrame:
    """(document, section, text) for every document folder and section; a missing file is ''."""
    t = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).load(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    t = t.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("document"), F.regexp_extract("path", r"([^/]+?)(\.[^./]*)?$", 1).alias("section"), "text").where(~F.col("section").startswith("."))
    docs = t.select("document").distinct().select("document", F.explode(F.array(*[F.lit(s) for s in sections])).alias("section"))
    return docs.join(t, ["document", "section"], "left").select("document", "section", F.coalesce("text", F.lit("")).alias("text"))


# Names of pdfinfo's keys in the parsed document.
PDF_KEYS = {"title": "title", "author": "author", "creator": "creator", "creationdate": "created", "creation_date": "created", "file size": "file_size", "file_size": "file_size", "page rot": "page_rot", "page_rot": "page_rot"}


def pdf_info(text_col: str):
    """map<string,string> of pdfinfo output: split at the first colon, keys lower-cased and
    renamed by PDF_KEYS, others left out. A key that is given twice keeps its last value."""
    key = lambda x: F.lower(F.trim(F.substring_index(x, ":", 1)))
    names = F.create_map(*[F.lit(v) for kv in PDF_KEYS.items() for v in kv])
    lines = F.filter(F.split(F.col(text_col), "\n"), lambda x: x.contains(":") & F.map_contains_key(names, key(x)))
    pairs = F.transform(lines, lambda x: F.struct(F.try_element_at(names, key(x)).alias("key"), F.trim(F.regexp_extract(x, "^[^:]*:(.*)$", 1)).alias("value")))
    last = F.filter(pairs, lambda p, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda q: q["key"] == p["key"]))
    return F.map_from_entries(last)


def document_id(text_col: str):
    """Last part of the XMP DocumentID, of xmpMM before xapMM; null if there is none."""
    def of(ns: str):
        return F.nullif(F.regexp_extract(F.col(text_col), rf"<{ns}:DocumentID>([^<]*)<|{ns}:DocumentID=\"([^\"]*)\"", 1), F.lit(""))

    return F.element_at(F.split(F.coalesce(of("xmpMM"), of("xapMM")), ":"), -1)
