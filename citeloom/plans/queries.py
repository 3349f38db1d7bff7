"""Core query registry: name -> (spark, sf_dir) -> DataFrame; every query runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fulltext, text, urls
from ..operators import evaluate, layout, limits, manifest, matching, search
from ..operators.multivalue import value_rows
from ..session import cut, one_delivery, table
from ..streaming import incremental
from .oracles import SQL

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
KEYWORDS = ["review", "harvest", "water", "records"]


def query(f: Query) -> Query:
    REGISTRY[f.__name__] = f
    return f


def queries() -> dict[str, Query]:
    from . import stage_queries  # noqa: F401  registers its own

    return dict(REGISTRY)


def oracle_sql() -> dict[str, str]:
    from .stage_oracles import STAGE_SQL

    return SQL | STAGE_SQL


def _articles(s: SparkSession, d: str, *cols: str) -> DataFrame:
    return table(s, d, "articles").select("article_id", *cols).distinct()


def _pubs(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "publications").select("uber_id", "title").where("title IS NOT NULL").distinct()


def _sections(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "pdf_sections").select("section_id", "sections").distinct()


@query
def p2_found(s: SparkSession, d: str) -> DataFrame:
    arts = one_delivery(table(s, d, "articles").select("article_id", "authors", "types", "subjects", "loaded_at"), "article_id", "loaded_at")
    return value_rows(arts, "article_id", {"authors": True, "types": False, "subjects": False})


@query
def clean_text_titles(s: SparkSession, d: str) -> DataFrame:
    c = text.clean_text(F.col("title"))
    return _pubs(s, d).select("uber_id", c.alias("cleaned"), F.char_length(c).cast("long").alias("chars"))


@query
def exact_match_pairs(s: SparkSession, d: str) -> DataFrame:
    return matching.exact_containment(_sections(s, d), "section_id", "sections", _pubs(s, d), "uber_id", "title")


def _citations(s: SparkSession, d: str) -> DataFrame:
    """Publications with the sections that cite them by exact title."""
    return exact_match_pairs(s, d).groupBy("uber_id").agg(F.array_sort(F.collect_set("section_id")).alias("policies"))


@query
def exact_match_citations(s: SparkSession, d: str) -> DataFrame:
    m = exact_match_pairs(s, d)
    f = matching.fold_citations(m, "uber_id", F.col("section_id"), F.col("section_id"), ["matched_title"])
    return f.select("uber_id", "matched_title", "associated_policies_count", F.array_join(F.col("policies").cast("array<string>"), ",").alias("policies")).orderBy(F.desc("associated_policies_count"), "uber_id")


@query
def fuzzy_tfidf_top1(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "structured_refs").select("reference_id", "title")
    return matching.tfidf_matches(refs, "reference_id", "title", _pubs(s, d), "uber_id", "title").select("reference_id", "uber_id", "similarity")


@query
def fuzzy_tfidf_top10(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "structured_refs").select("reference_id", "title")
    return matching.tfidf_matches(refs, "reference_id", "title", _pubs(s, d), "uber_id", "title", least=0.6, top=10).select("reference_id", "uber_id", "similarity", F.col("rank").cast("long").alias("rank"))


@query
def bm25_min_should_match(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "structured_refs").select("reference_id", text.long_title(F.col("title")).alias("title"))
    return matching.bm25_matches(refs, "reference_id", "title", _pubs(s, d), "uber_id", "title")


@query
def citations_fold(s: SparkSession, d: str) -> DataFrame:
    refs = table(s, d, "structured_refs").select("reference_id", "document_id", "title").distinct().withColumnRenamed("title", "extracted_title")
    m = fuzzy_tfidf_top1(s, d).join(refs, "reference_id")
    order = F.struct("reference_id", "document_id", "extracted_title")
    f = matching.fold_citations(m, "uber_id", order, F.col("document_id"), ["reference_id", "extracted_title", "similarity"])
    return f.select("uber_id", "reference_id", "extracted_title", "similarity", "associated_policies_count", F.array_join(F.col("policies").cast("array<string>"), ",").alias("policies"))


def _policies(s: SparkSession, d: str) -> DataFrame:
    return _articles(s, d, "title", "organisation", "pub_year", "url").select(F.col("article_id").alias("policy_id"), "title", F.col("organisation").alias("source_org"), F.col("pub_year").alias("year"), "url")


def _found(s: SparkSession, d: str, terms: str) -> DataFrame:
    return search.ranked(_policies(s, d), fulltext.lexemes((F.col("title"), "A")), terms)


@query
def search_policies_rank(s: SparkSession, d: str) -> DataFrame:
    return search.Page.of(search.POLICY_SORTS, size=200).take(_found(s, d, "study and"), "policy_id").select("policy_id", "title", "source_org", "year", "rank")


@query
def search_policies_year(s: SparkSession, d: str) -> DataFrame:
    return search.Page.of(search.POLICY_SORTS, "year", "asc", 25, 2).take(_found(s, d, "study"), "policy_id").select("policy_id", "title", "source_org", "year")


@query
def search_policies_count(s: SparkSession, d: str) -> DataFrame:
    return _found(s, d, "workers health").agg(F.count("policy_id").alias("n"))


@query
def websearch_or(s: SparkSession, d: str) -> DataFrame:
    return _found(s, d, "diesel or vaccination").select("policy_id")


@query
def websearch_not(s: SparkSession, d: str) -> DataFrame:
    return _found(s, d, "study -health").select("policy_id")


@query
def websearch_phrase(s: SparkSession, d: str) -> DataFrame:
    return _found(s, d, '"modelling study"').select("policy_id")


@query
def search_citations_page(s: SparkSession, d: str) -> DataFrame:
    """Sorted by the number of citing policies: the page is cut before policies are joined."""
    pubs = table(s, d, "publications").select("uber_id", "title", "journal_title", "pub_year").distinct()
    c = cut(_citations(s, d))
    hits = search.ranked(pubs, fulltext.lexemes((F.col("title"), "A"), (F.col("journal_title"), "C")), "of and").join(c, "uber_id").where("size(policies) > 0").withColumn("policies_count", F.size("policies"))
    page = search.Page.of(search.CITATION_SORTS, "associated_policies_count", "desc", 50).take(hits, "uber_id")
    known = table(s, d, "pdf_sections").select(F.col("section_id").alias("policy_id"), "organisation").distinct()
    out = search.with_policies(page, "uber_id", known, ["policy_id", "organisation"])
    names = F.array_join(F.transform("policies", lambda p: F.concat_ws(":", p["policy_id"].cast("string"), F.coalesce(p["organisation"], F.lit("")))), ",")
    return out.select("uber_id", "title", F.col("policies_count").cast("long").alias("policies_count"), names.alias("policies"))


@query
def export_citations_flat(s: SparkSession, d: str) -> DataFrame:
    rows = _pubs(s, d).groupBy("uber_id").agg(F.min("title").alias("title")).join(_citations(s, d), "uber_id", "left")
    known = table(s, d, "pdf_sections").select(F.col("section_id").alias("policy_id"), F.col("doc_id").alias("policy_doc")).distinct()
    return search.flat_rows(rows, "uber_id", known).select("uber_id", "title", F.col("policy_id").cast("string").alias("policy_id"), F.col("policy_doc").cast("string").alias("policy_doc"))


@query
def export_citations_nested(s: SparkSession, d: str) -> DataFrame:
    rows = _pubs(s, d).groupBy("uber_id").agg(F.min("title").alias("title")).join(_citations(s, d), "uber_id", "left")
    return rows.select("uber_id", "title", F.when(F.col("policies").isNotNull(), F.to_json("policies")).alias("policies"))


@query
def legacy_field_or_search(s: SparkSession, d: str) -> DataFrame:
    hit = search.any_field_matches("modelling study, ignored", F.col("title"), F.col("organisation"), F.col("types"))
    return _articles(s, d, "title", "organisation", "types").where(hit).select("article_id")


@query
def terms_set_search(s: SparkSession, d: str) -> DataFrame:
    want = search.terms_per_field("health,annual,workers", "title,types,title")
    return _articles(s, d, "title", "types").where(search.all_terms_of_one_field(want)).select("article_id")


def _lines(s: SparkSession, d: str) -> DataFrame:
    return layout.text_lines(table(s, d, "documents"), "doc_id", "text")


@query
def keyword_in_context(s: SparkSession, d: str) -> DataFrame:
    return layout.keyword_in_context(_lines(s, d), KEYWORDS).select("doc", "keyword", F.col("line_no").cast("long").alias("line_no"), F.col("hits").cast("long").alias("hits"), F.md5("context").alias("context_md5"))


@query
def keyword_lines(s: SparkSession, d: str) -> DataFrame:
    return layout.keyword_hits(_lines(s, d), KEYWORDS).select("doc", "keyword", F.col("line_no").cast("long").alias("line_no"))


@query
def font_stats(s: SparkSession, d: str) -> DataFrame:
    return layout.font_stats(_lines(s, d)).select("doc", F.col("mean_size").cast("long").alias("mean_size"), F.col("upper_mean_size").cast("long").alias("upper_mean_size"), F.array_join(F.col("sizes").cast("array<string>"), ",").alias("sizes"))


@query
def title_candidates(s: SparkSession, d: str) -> DataFrame:
    return layout.title_candidates(_lines(s, d)).select("doc", F.col("rank").cast("long").alias("rank"), F.col("text").alias("title"))


@query
def normalise_titles(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d, "title", "page_title", "page_headings")
    return a.select("article_id", text.first_title(F.col("title"), F.col("page_headings")).alias("title"), text.first_title(F.lit(""), F.col("page_headings")).alias("heading"))


@query
def publication_authors(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "publications").select("uber_id", "authors").distinct()
    return p.select("uber_id", text.author_string(F.col("authors")).alias("authors"))


@query
def pdf_url_valid(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d, "url", "source_page")
    return a.select("article_id", urls.is_pdf_url(F.col("url")).alias("url_is_pdf"), urls.is_pdf_url(F.col("source_page")).alias("page_is_pdf"), urls.filename(F.col("url")).alias("filename"))


@query
def allowed_hosts(s: SparkSession, d: str) -> DataFrame:
    from ..operators.scrape import keep_allowed

    refused = ["docs.kretimport.example", "docs.haertkramia.example"]
    return keep_allowed(_articles(s, d, "url"), "url", refused)[0].groupBy(urls.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query
def dedupe_urls(s: SparkSession, d: str) -> DataFrame:
    return _articles(s, d, "source_page").where("source_page IS NOT NULL").select(urls.bare(F.col("source_page")).alias("url")).distinct()


@query
def manifest_upsert(s: SparkSession, d: str) -> DataFrame:
    a = table(s, d, "articles").select("file_hash", "article_id", "title", "date_scraped")
    return manifest.upsert(a, "file_hash", [F.col("date_scraped"), F.col("article_id")], ["article_id", "title"])


@query
def manifest_buckets(s: SparkSession, d: str) -> DataFrame:
    b = manifest.buckets(table(s, d, "articles"), "file_hash")
    return b.select("prefix", F.array_join("hashes", ",").alias("hashes"))


@query
def reload_organisation(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d, "organisation", "title")
    new = a.where("organisation = 'kretimport_evidence_centre'").withColumn("title", F.upper("title"))
    return manifest.reload(a, new, "kretimport_evidence_centre").groupBy("organisation").agg(F.count("*").alias("n"), F.sum((F.col("title") == F.upper("title")).cast("long")).alias("upper_titles"))


@query
def rate_limit_trailing(s: SparkSession, d: str) -> DataFrame:
    e = limits.trailing_calls(table(s, d, "events"), ["user_id", "event_type"], "ts", 3600)
    return e.where("calls >= 2").select("event_id", "user_id", "event_type", "calls")


@query
def rate_limit_windowed(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    x = incremental.call_windows(e, "user_id", "event_type", "ts")
    return x.select(F.unix_seconds("window_start").alias("window_start"), "user_id", "event_type", "calls")


@query
def json_roundtrip(s: SparkSession, d: str) -> DataFrame:
    e = table(s, d, "events").select("event_id", F.from_json("props", "k long").alias("p"))
    return e.select("event_id", F.col("p.k").alias("k"), F.to_json("p").alias("props"))


def _cited(s: SparkSession, d: str) -> DataFrame:
    """References and publications with one volume and pages, and their titles."""
    r = table(s, d, "structured_refs").select("reference_id", "organisation", F.col("title").alias("predicted"), "volume", "pagination", F.col("pub_year").alias("ref_year")).distinct()
    p = table(s, d, "publications").select("uber_id", F.col("title").alias("actual"), F.col("journal_volume").alias("volume"), F.col("page_info").alias("pagination"), "pub_year").distinct()
    return r.join(p, ["volume", "pagination"])


@query
def eval_levenshtein(s: SparkSession, d: str) -> DataFrame:
    x = _cited(s, d).where("predicted IS NOT NULL AND actual IS NOT NULL")
    x = x.withColumn("share", text.edit_share(text.clean_text(F.col("predicted")), text.clean_text(F.col("actual"))))
    return x.groupBy("organisation").agg(F.count("*").alias("n"), F.round(F.avg("share"), 6).alias("mean"), F.round(F.avg((F.col("share") == 0).cast("double")), 6).alias("strict"), F.round(F.avg((F.col("share") < 0.2).cast("double")), 6).alias("lenient"))


@query
def eval_split_counts(s: SparkSession, d: str) -> DataFrame:
    """Predicted (numbered lines) against actual (references stored) counts, by organisation."""
    n = layout.text_lines(_sections(s, d), "section_id", "sections").where(F.col("text").rlike(r"^[0-9]+\. ")).groupBy("doc").agg(F.count("*").alias("predicted"))
    sec = table(s, d, "pdf_sections").select(F.col("section_id").alias("doc"), "doc_id", "organisation").distinct()
    act = table(s, d, "structured_refs").select("reference_id", F.col("document_id").alias("doc_id")).distinct().groupBy("doc_id").agg(F.count("*").alias("actual"))
    x = sec.join(n, "doc").join(act, "doc_id").withColumn("off", text.percent_off(F.col("predicted"), F.col("actual")))
    return x.groupBy("organisation").agg(F.round(F.median("off"), 6).alias("median_off"), F.round(F.avg((F.col("off") <= 50).cast("double")), 6).alias("within_half"))


def _similarities(s: SparkSession, d: str) -> DataFrame:
    x = _cited(s, d).where("predicted IS NOT NULL AND actual IS NOT NULL")
    x = x.select("reference_id", "uber_id", F.char_length("predicted").alias("chars"), F.round(1 - text.edit_share(text.clean_text(F.col("predicted")), text.clean_text(F.col("actual"))), 6).alias("sim"), (F.coalesce(F.substring("ref_year", 1, 4), F.lit("")) == F.coalesce(F.col("pub_year").cast("string"), F.lit("-"))).alias("positive"))
    return x


@query
def similarity_percentiles(s: SparkSession, d: str) -> DataFrame:
    x = _similarities(s, d)
    return x.groupBy("positive").agg(*[F.round(F.percentile("sim", F.lit(p)), 6).alias(f"p{int(100 * p):02d}") for p in (0.01, 0.05, 0.95, 0.99)])


@query
def similarity_histogram(s: SparkSession, d: str) -> DataFrame:
    b = F.least(F.floor(F.col("sim") * 20), F.lit(19)).cast("long")
    return _similarities(s, d).groupBy(b.alias("bin"), "positive").agg(F.count("*").alias("n"))


@query
def threshold_grid(s: SparkSession, d: str) -> DataFrame:
    return evaluate.threshold_grid(_similarities(s, d), "sim", "chars", "positive", [0.5, 0.6, 0.7, 0.8, 0.9], [20, 40, 60, 80])


@query
def threshold_pivot(s: SparkSession, d: str) -> DataFrame:
    g = threshold_grid(s, d)
    return g.groupBy("sim_over").pivot("len_over", [20, 40, 60, 80]).agg(F.first("recall")).select("sim_over", *[F.col(str(x)).alias(f"len_{x}") for x in (20, 40, 60, 80)])


@query
def match_outcomes(s: SparkSession, d: str) -> DataFrame:
    t = fuzzy_tfidf_top1(s, d).select("reference_id", F.col("uber_id").alias("predicted"))
    e = _cited(s, d).groupBy("reference_id").agg(F.min("uber_id").alias("actual"))
    r = table(s, d, "structured_refs").select("reference_id").distinct()
    x = r.join(e, "reference_id", "left").join(t, "reference_id", "left")
    return x.groupBy(evaluate.match_outcome(F.col("actual"), F.col("predicted")).alias("outcome")).agg(F.count("*").alias("n"))


@query
def gold_pair_eval(s: SparkSession, d: str) -> DataFrame:
    gold = _cited(s, d).select("reference_id", "uber_id")
    return evaluate.pair_scores(gold, fuzzy_tfidf_top1(s, d), ["reference_id", "uber_id"])


@query
def merge_results(s: SparkSession, d: str) -> DataFrame:
    """Exact and fuzzy matches in one frame, with the documents' URLs and publications' titles."""
    fuzzy = fuzzy_tfidf_top1(s, d).join(table(s, d, "structured_refs").select("reference_id", "document_id").distinct(), "reference_id").select(F.col("document_id").alias("doc_id"), "uber_id", "similarity", F.lit("Fuzzy match").alias("algorithm"))
    sec = table(s, d, "pdf_sections").select("section_id", "doc_id").distinct()
    exact = exact_match_pairs(s, d).join(sec, "section_id").select("doc_id", "uber_id", F.lit("Exact match").alias("algorithm"))
    both = fuzzy.unionByName(exact, allowMissingColumns=True)
    doc = table(s, d, "documents").select("doc_id", "url")
    pub = _pubs(s, d).groupBy("uber_id").agg(F.min("title").alias("title"))
    x = both.join(doc, "doc_id", "left").join(pub, "uber_id", "left")
    return x.groupBy("algorithm", "doc_id", "uber_id", "url", "title").agg(F.count("*").alias("n"), F.round(F.max("similarity"), 6).alias("similarity"))


@query
def sample_halves(s: SparkSession, d: str) -> DataFrame:
    """A sample of 200 references in two halves, the same on every run: first by digest."""
    h = F.md5(F.concat(F.lit("seed-0-"), F.col("reference_id").cast("string")))
    r = table(s, d, "structured_refs").select("reference_id").distinct().withColumn("h", h).orderBy("h", "reference_id").limit(200)
    rank = F.row_number().over(Window.orderBy("h", "reference_id"))
    return r.select("reference_id", F.when(rank <= 100, "positive").otherwise("negative").alias("half"))
