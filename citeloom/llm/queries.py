"""Queries of the llm subpackage over the tables of TESTDATA.md."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut, one_delivery, table
from . import linkage, lookalike, mixing, names, neardup, packing, scans, sitelines, subjects, tokens

Query = Callable[[SparkSession, str], DataFrame]


def _document_links(spark: SparkSession, d: str):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return neardup.near_duplicates(docs, "doc_id", "text", neardup.word_shingles, 0.5, rows=3, bands=32)


def _article_links(spark: SparkSession, d: str):
    arts = table(spark, d, "articles").select("article_id", "title").distinct()
    form = lookalike.fit((arts, "title"))
    same = arts.select("article_id", form.column(F.col("title")).alias("title"))
    return neardup.near_duplicates(same, "article_id", "title", neardup.char_shingles, 0.6, rows=5, bands=48)


def _pairs(links: DataFrame, members: DataFrame, name: str) -> DataFrame:
    p = neardup.record_pairs(links, members).where("id_a <> id_b").distinct()
    return p.select(F.lit(name).alias("table_name"), "id_a", "id_b")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(*_document_links(spark, d), "documents").unionByName(_pairs(*_article_links(spark, d), "articles"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = neardup.groups(*_document_links(spark, d)).withColumn("table_name", F.lit("documents"))
    arts = neardup.groups(*_article_links(spark, d)).withColumn("table_name", F.lit("articles"))
    return docs.unionByName(arts).select("table_name", F.col("id").alias("record_id"), "class_id", "links")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    arts = table(spark, d, "articles").select("article_id", "title")
    refs = table(spark, d, "structured_refs").select("reference_id", "title")
    form = lookalike.fit((arts, "title"), (refs, "title"))
    a = lookalike.same_look_pairs(arts, "article_id", "title", form).withColumn("table_name", F.lit("articles"))
    r = lookalike.same_look_pairs(refs, "reference_id", "title", form).withColumn("table_name", F.lit("structured_refs"))
    return a.unionByName(r).select("table_name", "id_a", "id_b")


def p3_titles(spark: SparkSession, d: str) -> DataFrame:
    arts = one_delivery(table(spark, d, "articles").select("article_id", "title", "loaded_at"), "article_id", "loaded_at")
    refs = one_delivery(table(spark, d, "structured_refs").select("reference_id", "title", "loaded_at"), "reference_id", "loaded_at")
    form = lookalike.fit((arts, "title"), (refs, "title"))
    a = arts.select(F.lit("articles").alias("table_name"), F.col("article_id").alias("record_id"), "title")
    r = refs.select(F.lit("structured_refs").alias("table_name"), F.col("reference_id").alias("record_id"), "title")
    return a.unionByName(r).withColumn("consistent_title", form.column(F.col("title")))


def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    arts = table(spark, d, "articles").select("article_id", "title")
    refs = table(spark, d, "structured_refs").select("reference_id", "title")
    form = lookalike.fit((arts, "title"), (refs, "title"))
    a = lookalike.same_look_classes(arts, "article_id", "title", form).withColumn("table_name", F.lit("articles"))
    r = lookalike.same_look_classes(refs, "reference_id", "title", form).withColumn("table_name", F.lit("structured_refs"))
    return a.unionByName(r).select("table_name", F.col("id").alias("record_id"), "class_id", "spellings")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = names.same_entity_pairs(names.entities(table(spark, d, "contributors")))
    return pairs.toDF("contributor_id_a", "contributor_id_b")


def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    return names.entities(table(spark, d, "contributors")).toDF("contributor_id", "entity")


def _scan_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return scans.vocabulary([(table(spark, d, "documents"), "text"), (table(spark, d, "pdf_sections"), "sections")])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    v = _scan_vocabulary(spark, d)
    docs = scans.noise_lines(table(spark, d, "documents"), "doc_id", "text", v)
    secs = scans.noise_lines(table(spark, d, "pdf_sections"), "section_id", "sections", v, references=True)
    both = docs.withColumn("table_name", F.lit("documents")).unionByName(secs.withColumn("table_name", F.lit("pdf_sections")))
    return both.select("table_name", "record_id", "line_no", "noise_kind")


def p5_repaired(spark: SparkSession, d: str) -> DataFrame:
    v = _scan_vocabulary(spark, d)
    docs = scans.repair(table(spark, d, "documents"), "doc_id", "text", v)
    secs = scans.repair(table(spark, d, "pdf_sections"), "section_id", "sections", v, references=True)
    both = docs.withColumn("table_name", F.lit("documents")).unionByName(secs.withColumn("table_name", F.lit("pdf_sections")))
    return both.select("table_name", "record_id", "text", "scanned")


def _matches(spark: SparkSession, d: str) -> DataFrame:
    pubs = table(spark, d, "publications")
    arts = table(spark, d, "articles").select("article_id", "title", "authors", "pub_year")
    refs = table(spark, d, "structured_refs").select("reference_id", "title", "authors", "pub_year", "journal", "volume", "pagination")
    form = lookalike.fit((pubs, "title"), (arts, "title"), (refs, "title"))
    index = linkage.Publications(pubs, form)
    none = F.lit(None).cast("string")
    # Both tables go through in one pass: the last bit of an id tells them apart.
    refs = refs.select((F.col("reference_id") * 2).alias("id"), "title", "authors", F.col("pub_year").alias("year"), "journal", F.col("volume").alias("vol"), F.col("pagination").alias("page"))
    arts = arts.select((F.col("article_id") * 2 + 1).alias("id"), "title", "authors", F.col("pub_year").alias("year"), none.alias("journal"), none.alias("vol"), none.alias("page"))
    m = index.match(refs.unionByName(arts).where("id IS NOT NULL"))
    name = F.when(F.col("rid") % 2 == 0, "structured_refs").otherwise("articles")
    return m.select(name.alias("table_name"), "uber_id", F.shiftright("rid", 1).alias("rid"), "confidence")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("table_name", "uber_id", F.col("rid").alias("record_id"))


def p6_matches(spark: SparkSession, d: str) -> DataFrame:
    return _matches(spark, d).select("table_name", "uber_id", F.col("rid").alias("record_id"), "confidence")


def _site_lines(spark: SparkSession, d: str) -> sitelines.SiteLines:
    return sitelines.SiteLines(table(spark, d, "documents"), "doc_id", "text", "source")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _site_lines(spark, d).repeated()


def p7_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return _site_lines(spark, d).cleaned()


def _sized(spark: SparkSession, d: str) -> DataFrame:
    return cut(tokens.token_counts(table(spark, d, "documents"), "doc_id", "text", "source"))


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(_sized(spark, d), table(spark, d, "pack_sizes"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "pack_sizes")
    return packing.fill_report(packing.pack(_sized(spark, d), sizes), sizes)


def p8_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of any filling: every document once, nothing above the capacity, only
    documents above it cut, every token in its place."""
    sizes = table(spark, d, "pack_sizes").select("pack_id", "capacity_tokens").distinct()
    sized = _sized(spark, d)
    packed = cut(packing.pack(sized, sizes))
    full = packed.groupBy("pack_id", "container_id").agg(F.sum("tokens").alias("t")).join(F.broadcast(sizes), "pack_id").groupBy("pack_id").agg(F.sum((F.col("t") > F.col("capacity_tokens")).cast("long")).alias("overfull"))
    per = packed.groupBy("pack_id", "doc_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("pieces"), F.max(F.col("first_token") + F.col("tokens")).alias("end"))
    per = per.join(sized.select("doc_id", F.col("tokens").alias("n")), "doc_id").join(F.broadcast(sizes), "pack_id")
    g = per.groupBy("pack_id").agg(F.count("*").alias("documents"), F.sum(((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).cast("long")).alias("split_needlessly"), F.sum(F.abs(F.col("n") - F.col("t")) + F.abs(F.col("n") - F.col("end"))).alias("tokens_lost"))
    return g.join(full, "pack_id").select("pack_id", "documents", "overfull", "split_needlessly", "tokens_lost")


def p9_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What must hold of any mixture, for every target: no document used more often than
    allowed, none from another source, uses in the order of their positions."""
    targets, sized = table(spark, d, "mix_targets"), _sized(spark, d)
    m = cut(mixing.mixture(sized, targets))
    want = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("max_repeats").cast("long").alias("allowed"))
    per = m.groupBy("source", "doc_id").agg(F.max("use").alias("uses"), F.count("*").alias("n"), F.min_by("use", "position").alias("first"))
    per = per.join(sized.select("doc_id", F.col("source").alias("own")), "doc_id").join(F.broadcast(want), "source")
    bad = lambda c: F.sum(c.cast("long"))
    g = per.groupBy("source").agg(bad((F.col("n") > F.col("allowed")) | (F.col("n") != F.col("uses"))).alias("used_more"), bad(F.col("own") != F.col("source")).alias("wrong_source"), bad(F.col("first") != 1).alias("out_of_order"))
    return want.join(g, "source", "left").select("source", "allowed", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("used_more", "wrong_source", "out_of_order")])


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixture(_sized(spark, d), table(spark, d, "mix_targets"))


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    sized, targets = _sized(spark, d), table(spark, d, "mix_targets")
    return mixing.shares(mixing.mixture(sized, targets), sized, targets)


def _subjects(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    model = subjects.fit(docs, table(spark, d, "subject_labels"), table(spark, d, "subject_areas"))
    return subjects.subjects_of(docs, model)


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return _subjects(spark, d).select("doc_id", "subject")


def p10_composition(spark: SparkSession, d: str) -> DataFrame:
    s = _subjects(spark, d)
    per = s.groupBy("subject").agg(F.count("*").alias("documents"), F.sum(1 / F.col("n_subjects")).alias("weight"))
    return table(spark, d, "subject_areas").select("subject").distinct().join(per, "subject", "left").select("subject", F.coalesce("documents", F.lit(0)).alias("documents"), F.round(F.coalesce("weight", F.lit(0.0)), 3).alias("weight"))


def queries() -> dict[str, Query]:
    return {k: v for k, v in globals().items() if k[0] == "p" and k[1].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    from .oracles import SQL

    return dict(SQL)
