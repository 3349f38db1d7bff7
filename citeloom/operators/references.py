"""References: from sections to split and labelled references and stored rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import component, first_title
from ..schemas import COMPONENTS

LABELS = {"Authors": "author", "Journal": "journal", "Volume": "volume", "Issue": "issue", "Pagination": "pages", "Title": "title", "PubYear": "year"}
Splitter = Callable[[Column], Column]


def rule_splitter(section: Column) -> Column:
    """array<struct<reference, attributes array<struct<token, label>>>> by rules: a reference
    starts at a number and a full stop at a line's start; words before the first four-digit
    year that ends a clause are authors up to the first ". ", then title; the year is year."""
    flat = F.regexp_replace(section, r"\n(?!\s*\[?\d+[.\])]\s)", " ")
    refs = F.filter(F.transform(F.split(flat, "\n"), lambda x: F.trim(F.regexp_replace(x, r"^\s*\[?\d+[.\])]\s+", ""))), lambda x: F.char_length(x) >= 20)

    def tokens(r: Column) -> Column:
        cut = F.instr(r, F.lit(". "))
        return F.transform(F.filter(F.split(r, r"\s+"), lambda w: w != ""), lambda w, i: F.struct(w.alias("token"), F.when(w.rlike(r"^\(?(18|19|20)\d\d[a-z]?[).,;:]?"), "year").when(F.size(F.split(F.substring(r, F.lit(1), cut), r"\s+")) > i, "author").otherwise("title").alias("label")))

    return F.transform(refs, lambda r: F.struct(r.alias("reference"), tokens(r).alias("attributes")))


def section_rows(docs: DataFrame, doc: str, sections: str) -> DataFrame:
    """(doc, keyword, section): map<keyword, array<text>> flattened; null and empty ones give no rows."""
    x = docs.select(F.col(doc).alias("doc"), F.explode(sections).alias("keyword", "_s"))
    return x.select("doc", "keyword", F.explode("_s").alias("section")).where("section <> ''")


def split_references(sections: DataFrame, doc: str, section: str, splitter: Splitter = rule_splitter, most: int | None = None) -> DataFrame:
    """(doc, position, reference, attributes) of whole sections; a splitter model with a limit of
    its own takes the first ``most`` characters of each."""
    text = F.col(section) if most is None else F.substring(section, 1, most)
    x = sections.select(F.col(doc).alias("doc"), F.posexplode(splitter(text)).alias("position", "_r"))
    return x.select("doc", "position", "_r.reference", "_r.attributes")


def structured(split: DataFrame) -> DataFrame:
    """The seven components of every reference that has any, with a reproducible id."""
    x = split.select("doc", "position", "reference", *[component(F.col("attributes"), LABELS[c]).alias(c) for c in COMPONENTS])
    return x.where(F.greatest(*[F.length(c) for c in COMPONENTS]) > 0).withColumn("reference_id", F.xxhash64("doc", "position", "reference"))


def stored(refs: DataFrame) -> DataFrame:
    """Reference rows cut to their columns' sizes: titles to 1024 characters, others to 256; a
    year that is no whole number is null."""
    cut = {c: 1024 if c == "Title" else 256 for c in COMPONENTS if c != "PubYear"}
    return refs.select("reference_id", *[F.substring(c, 1, n).alias(c) for c, n in cut.items()], F.expr("try_cast(PubYear AS INT)").alias("PubYear"))


def normalise_documents(df: DataFrame) -> DataFrame:
    """Parsed documents with their source metadata in one row; the title falls back to the first
    title candidate, then to the first page heading."""
    s = F.col("source_metadata")
    return df.select(
        "file_hash", "keywords", "text", "sections", s["url"].alias("url"), s["source_page"].alias("source_page"), first_title(s["title"], F.col("title_candidates"), s["page_headings"]).alias("title"),
        s["authors"].alias("authors"), s["year"].alias("year"), s["subjects"].alias("subjects"), F.col("pdf_metadata.created").alias("created"), s["types"].alias("types"),
    )


def without_sections(df: DataFrame, metadata: str = "metadata") -> DataFrame:
    """Document metadata as references carry it: without its sections."""
    return df.withColumn(metadata, F.col(metadata).dropFields("sections"))


def text_documents(df: DataFrame, fields: list[str]) -> DataFrame:
    """(file_hash, text, fields) of documents with a text; what the PDF says about itself
    (pdf_metadata) goes before what its source says (source_metadata)."""

    def merged(f: str) -> Column:
        have = [s for s in ("pdf_metadata", "source_metadata") if f in df.schema[s].dataType.fieldNames()]
        return F.coalesce(*[F.nullif(F.col(f"{s}.{f}"), F.lit("")) for s in have], F.lit(None)).alias(f)

    return df.where(F.col("text") != "").select("file_hash", "text", *[merged(f) for f in fields])
