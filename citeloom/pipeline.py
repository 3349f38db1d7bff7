"""The stages of a citation pipeline as functions of folders, run one by one or as a whole.

    python -m citeloom.pipeline STAGE --root FOLDER --organisation NAME [--max-items N]

Stages exchange tables below ROOT and can be run again: each replaces what it wrote for its
organisation. The input of the first is crawled pages as JSON lines (url, html, site).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import long_title
from .operators import layout, matching, references, scrape
from .sources import readers, writers

Stage = Callable[[SparkSession, str, str, int | None], DataFrame]
STAGES: dict[str, Stage] = {}


def raw_path(path: str) -> str:
    """Where a parser leaves the raw form of what is normalised to ``path``."""
    return path.replace("_normalized", "_raw")


def stage(f: Stage) -> Stage:
    STAGES[f.__name__] = f
    return f


def _read(spark: SparkSession, root: str, name: str, organisation: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}").where(F.col("organisation") == organisation)


@stage
def crawl(spark: SparkSession, root: str, organisation: str, max_items: int | None) -> DataFrame:
    """Documents that crawled pages offer."""
    pages = scrape.extract_pages(readers.json_lines(spark, f"{root}/pages", "url string, html string, site string", max_items))
    return scrape.site_files(pages, scrape.requests(pages)).withColumn("organisation", F.lit(organisation))


@stage
def parse(spark: SparkSession, root: str, organisation: str, max_items: int | None) -> DataFrame:
    """Sections of the converted PDFs (JSON lines of doc and xml)."""
    xml = readers.json_lines(spark, f"{root}/xml", "doc string, xml string", max_items)
    found = layout.sections(layout.parse_pdf_xml(xml, "doc", "xml"), "reference")
    return found.withColumn("organisation", F.lit(organisation))


@stage
def extract(spark: SparkSession, root: str, organisation: str, max_items: int | None) -> DataFrame:
    """Labelled references of the sections."""
    x = references.structured(references.split_references(_read(spark, root, "parse", organisation), "doc", "section"))
    return x.withColumn("organisation", F.lit(organisation))


@stage
def match(spark: SparkSession, root: str, organisation: str, max_items: int | None) -> DataFrame:
    """Best publication of every reference, against the table ``publications`` (uber_id, title)."""
    refs = _read(spark, root, "extract", organisation).select("reference_id", "doc", long_title(F.col("Title")).alias("title"))
    m = matching.bm25_matches(refs, "reference_id", "title", spark.read.parquet(f"{root}/publications"), "uber_id", "title")
    return m.join(refs.select("reference_id", "doc"), "reference_id").withColumn("organisation", F.lit(organisation))


@stage
def cite(spark: SparkSession, root: str, organisation: str, max_items: int | None) -> DataFrame:
    """Citations folded per publication."""
    m = _read(spark, root, "match", organisation)
    return matching.fold_citations(m, "uber_id", F.col("reference_id"), F.col("doc"), ["reference_id", "score"]).withColumn("organisation", F.lit(organisation))


def run(spark: SparkSession, name: str, root: str, organisation: str, max_items: int | None = None) -> int:
    """Run one stage and return the rows its table holds for the organisation."""
    writers.reload_partition(STAGES[name](spark, root, organisation, max_items), f"{root}/{name}")
    return _read(spark, root, name, organisation).count()


def main(args: list[str]) -> int:
    p = argparse.ArgumentParser()
    p.add_argument("stage", choices=[*STAGES, "all"])
    p.add_argument("--root", required=True)
    p.add_argument("--organisation", required=True)
    p.add_argument("--max-items", type=int)
    a = p.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    for name in STAGES if a.stage == "all" else [a.stage]:
        print(name, run(spark, name, a.root, a.organisation, a.max_items))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
