"""Queries that run the stages' own readers, writers, parsers and scorers over whole tables.

Where no table holds an operator's input (files, XML of converted PDFs, HTML pages), the input is
built from a table first: written by the writers into the shared folder, or put together as a
column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, urls
from ..operators import evaluate, layout, manifest, references, scrape, search
from ..session import cut, scratch, table
from ..sources import readers, writers
from .queries import _articles, _citations, _cited, _found, _pubs, _sections, _similarities, fuzzy_tfidf_top1, query

PAGE_LINES = 40


# Sources and sinks


@query
def scan_json_lines(s: SparkSession, d: str) -> DataFrame:
    """Gzipped JSON lines written and read back with a column whitelist."""
    path = f"{scratch(s)}.json.gz"
    writers.json_lines(table(s, d, "structured_refs").select("reference_id", "title", "authors", "pub_year"), path)
    return readers.json_lines(s, path, "reference_id long, title string, pub_year string", partitions=8)


@query
def scan_csv(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    writers.csv_export(table(s, d, "publications").select("uber_id", "title", "journal_title"), path)
    return readers.csv(s, path, "uber_id long, title string, journal_title string")


@query
def scan_match_tables(s: SparkSession, d: str) -> DataFrame:
    """Match files of several folders as one frame: rows, and distinct publications, by algorithm."""
    root = scratch(s)
    exact = cut(_citations(s, d).select("uber_id", F.explode("policies").alias("policy")))
    for name, part in (("exact", exact), ("fuzzy", fuzzy_tfidf_top1(s, d).select("uber_id", F.col("reference_id").alias("policy")))):
        writers.csv_export(part.select(F.col("policy").alias("Document id"), F.col("uber_id").alias("WT_Ref_Id")), f"{root}/{name}")
    x = readers.match_tables(s, root, ".csv")
    algorithm = F.regexp_extract("file", "/(exact|fuzzy)/", 1).alias("algorithm")
    none = readers.match_tables(s, root, ".tsv").select(F.lit("none").alias("algorithm"), "WT_Ref_Id")
    return x.select(algorithm, "WT_Ref_Id").unionByName(none).groupBy("algorithm").agg(F.count("*").alias("n"), F.countDistinct("WT_Ref_Id").alias("publications"))


@query
def first_row_of_files(s: SparkSession, d: str) -> DataFrame:
    path = scratch(s)
    src = table(s, d, "publications").where("pub_type IS NOT NULL").select("uber_id", "pub_type", F.col("pub_type").alias("kind"))
    src.repartition("kind").write.partitionBy("kind").option("header", True).csv(path)
    x = readers.tables(s, path, ".csv").select(F.regexp_extract("file", "kind=([^/]*)/", 1).alias("folder"), F.col("uber_id").cast("long").alias("uber_id"), "pub_type")
    return readers.first_rows(x, "folder", "uber_id").select("pub_type", "uber_id")


@query
def scan_manifest(s: SparkSession, d: str) -> DataFrame:
    """Manifests, one per organisation and prefix, written as JSON, read and looked up."""
    a = table(s, d, "articles").select("file_hash", "organisation", "article_id", "title", "url", "date_scraped").where("organisation IS NOT NULL")
    m = manifest.upsert(a, "file_hash", [F.col("date_scraped"), F.col("article_id")], ["organisation", "title", "url"])
    g = m.withColumn("prefix", F.substring("file_hash", 1, 2)).groupBy("organisation", "prefix").agg(F.collect_list("file_hash").alias("hs"), F.map_from_entries(F.collect_list(F.struct("file_hash", F.struct("title", "url")))).alias("data"))
    path = f"{scratch(s)}.json.gz"
    writers.json_lines(g.select(F.struct("organisation").alias("metadata"), F.create_map("prefix", "hs").alias("content"), "data"), path)
    x = manifest.read_manifest(readers.manifest(s, path, lines=True))
    return x.select("prefix", F.col("hash").alias("file_hash"), urls.storage_key("docs", F.col("hash")).alias("key"), F.col("data.title").alias("title"), F.col("data.url").alias("url"))


@query
def scan_first_lines(s: SparkSession, d: str) -> DataFrame:
    """Of the first 400 lines of a file those with a title and a pmid, with their line numbers."""
    path = scratch(s)
    head = table(s, d, "publications").select("uber_id", "title", "pmid").distinct().orderBy("uber_id", "title", "pmid").limit(500)
    head.coalesce(1).sortWithinPartitions("uber_id", "title", "pmid").write.json(path)
    return readers.first_lines(s, path, "uber_id long, title string, pmid string", 400, ["title", "pmid"]).select("line_no", "uber_id")


@query
def stored_table_life(s: SparkSession, d: str) -> DataFrame:
    """A table created, filled in two parts, deleted from by a condition, and counted."""
    path, to = scratch(s), scratch(s)
    p = table(s, d, "publications").select("uber_id", "pub_type", "pub_year")
    before = writers.exists(s, path)
    writers.recreate(p.limit(0), path)
    n = writers.append_counted(p.where("uber_id % 2 = 0"), path) + writers.append_counted(p.where("uber_id % 2 = 1"), path)
    kept = writers.delete_where(s, path, F.col("pub_year") < 2000, to)
    row = (before, writers.exists(s, path), n, writers.count_rows(s, path), kept, ",".join(sorted(writers.columns_of(s, to))))
    return s.createDataFrame([row], "existed boolean, exists boolean, written long, stored long, kept long, columns string")


@query
def indexed_records(s: SparkSession, d: str) -> DataFrame:
    x = writers.index_records(table(s, d, "publications").select("uber_id", "pmid", "doi"), writers.index_name("metadata", True))
    return x.select(F.col("_index").alias("index"), F.col("doc.uber_id").alias("uber_id"), F.to_json("doc", {"ignoreNullFields": "false"}).alias("doc"))


@query
def nested_delete(s: SparkSession, d: str) -> DataFrame:
    """Citations without those that a section of one organisation takes part in."""
    sec = table(s, d, "pdf_sections").select(F.col("section_id").alias("policy_id"), "organisation").distinct()
    c = search.with_policies(cut(_citations(s, d)), "uber_id", sec, ["policy_id", "organisation"])
    return manifest.delete_organisation_of_policies(c, "kretimport_evidence_centre").select("uber_id", F.size("policies").cast("long").alias("n"))


@query
def export_policies_ranked(s: SparkSession, d: str) -> DataFrame:
    """All policies that match, best first, exported as CSV and read back."""
    path = scratch(s)
    writers.csv_export(_found(s, d, "study health").select("policy_id", "source_org", "rank").orderBy(F.desc("rank"), "policy_id"), path)
    return readers.csv(s, path, "policy_id long, source_org string, rank double")


# Documents and references


@query
def split_references(s: SparkSession, d: str) -> DataFrame:
    x = references.split_references(_sections(s, d), "section_id", "sections")
    return x.select(F.col("doc").alias("section_id"), F.col("position").cast("long").alias("position"), "reference", F.size("attributes").cast("long").alias("tokens"))


@query
def structured_references(s: SparkSession, d: str) -> DataFrame:
    """Two outputs from one pass: split references, then their components, read back."""
    root = scratch(s)
    split = references.split_references(_sections(s, d), "section_id", "sections")
    x = writers.two_outputs(split, f"{root}/split.json.gz", f"{root}/structured.json.gz", references.structured)
    return x.select(F.col("doc").alias("section_id"), F.col("position").cast("long").alias("position"), "Authors", "Title", "PubYear")


@query
def stored_references(s: SparkSession, d: str) -> DataFrame:
    """References cut to their columns' sizes, with whole-number years."""
    names = {"title": "Title", "authors": "Authors", "journal": "Journal", "volume": "Volume", "issue": "Issue", "pagination": "Pagination", "pub_year": "PubYear"}
    r = table(s, d, "structured_refs").select("reference_id", *[F.col(a).alias(b) for a, b in names.items()]).distinct()
    x = references.stored(r).select("*", F.col("PubYear").cast("string").alias("year")).drop("PubYear")
    return x.select("reference_id", F.col("Title").alias("title"), F.col("Authors").alias("authors"), F.col("Journal").alias("journal"), F.col("Pagination").alias("pagination"), "year")


@query
def section_rows(s: SparkSession, d: str) -> DataFrame:
    """Documents' map of keyword to sections, flattened again."""
    g = table(s, d, "pdf_sections").select("section_id", "keyword", "sections").distinct().select("section_id", F.create_map(F.coalesce("keyword", F.lit("")), F.array("sections")).alias("m"))
    return references.section_rows(g, "section_id", "m").select(F.col("doc").alias("section_id"), "keyword", F.md5("section").alias("section_md5"))


@query
def normalised_documents(s: SparkSession, d: str) -> DataFrame:
    """Parsed documents with their source metadata in one row, and as text documents with what
    the PDF says first."""
    a = table(s, d, "articles").select("article_id", "file_hash", "title", "pub_year", "url", "source_page", "page_headings", "authors", "subjects", "types", "page_title").distinct()
    meta = F.struct("url", "source_page", "title", "page_headings", "authors", F.col("pub_year").alias("year"), F.split("subjects", ";").alias("subjects"), F.split("types", ";").alias("types"))
    p = a.select("article_id", F.coalesce("file_hash", F.lit("")).alias("file_hash"), F.lit(None).cast("map<string,array<string>>").alias("keywords"), F.coalesce("page_title", F.lit("")).alias("text"), F.lit(None).cast("map<string,array<string>>").alias("sections"), meta.alias("source_metadata"), F.filter(F.array("page_title"), lambda x: x.isNotNull()).alias("title_candidates"), F.struct(F.col("page_title").alias("title"), F.lit("2020").alias("created")).alias("pdf_metadata"))
    n = references.normalise_documents(p).groupBy("file_hash", "url", "title", "year").agg(F.count("*").alias("n"))
    t = references.text_documents(p, ["title", "url"]).groupBy("file_hash", "title", "url").agg(F.count("*").alias("m"))
    return n.groupBy("title").agg(F.sum("n").alias("documents")).join(t.groupBy("title").agg(F.sum("m").alias("text_documents")), "title", "full").select("title", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("documents", "text_documents")])


def _pdf_xml(s: SparkSession, d: str) -> DataFrame:
    """(doc_id, xml): documents as the XML of a converted PDF; the first line has size 24, others
    that do not end with a full stop 16, the rest 12; a page holds PAGE_LINES lines."""
    safe = F.regexp_replace("text", r"[\x00-\x08\x0b\x0c\x0e-\x1f\x{fffe}\x{ffff}]", "")

    def line(x: Column, i: Column) -> Column:
        e = F.replace(F.replace(F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit("\r"), F.lit("&#13;"))
        font = F.when(i == 0, "0").when(x.endswith("."), "2").otherwise("1")
        return F.concat(F.when((i > 0) & (i % PAGE_LINES == 0), "</page><page>").otherwise(""), F.lit('<text font="'), font, F.lit('">'), e, F.lit("</text>"))

    fonts = "".join(f'<fontspec id="{i}" size="{n}" family="Times"/>' for i, n in enumerate((24, 16, 12)))
    body = F.array_join(F.transform(F.split(safe, "\n", -1), line), "")
    return table(s, d, "documents").where("text IS NOT NULL").select("doc_id", F.concat(F.lit(f"<pdf2xml><page>{fonts}"), body, F.lit("</page></pdf2xml>")).alias("xml"))


def _pdf_lines(s: SparkSession, d: str) -> DataFrame:
    return cut(layout.parse_pdf_xml(_pdf_xml(s, d), "doc_id", "xml").withColumn("doc", F.col("doc").cast("long")))


@query
def pdf_pages(s: SparkSession, d: str) -> DataFrame:
    """Page texts of parsed XML without lines of digits only."""
    return layout.page_text(_pdf_lines(s, d), skip_numbers=True).select("doc", F.col("page").cast("long").alias("page"), F.md5("text").alias("text_md5"))


@query
def document_full_text(s: SparkSession, d: str) -> DataFrame:
    return layout.full_text(_pdf_lines(s, d)).select("doc", F.md5("text").alias("text_md5"))


@query
def pdf_font_stats(s: SparkSession, d: str) -> DataFrame:
    return layout.font_stats(_pdf_lines(s, d)).select("doc", F.col("mean_size").cast("long").alias("mean_size"), F.col("upper_mean_size").cast("long").alias("upper_mean_size"), F.array_join(F.col("sizes").cast("array<string>"), ",").alias("sizes"))


@query
def pdf_lines_by_size(s: SparkSession, d: str) -> DataFrame:
    """Lines of one font size by document, and the bold ones, of which a converted PDF has none."""
    x = _pdf_lines(s, d)
    n = layout.lines_of_size(x, 16).groupBy("doc").agg(F.count("*").alias("n"), F.min("line_no").cast("long").alias("first_line"))
    b = layout.bold_lines(x).groupBy("doc").agg(F.count("*").alias("bold"))
    return n.join(b, "doc", "left").select("doc", "n", "first_line", F.coalesce("bold", F.lit(0)).cast("long").alias("bold"))


@query
def keyword_by_page(s: SparkSession, d: str) -> DataFrame:
    """Every line with the keyword, and of each page the last one with two lines on either side."""
    x = _pdf_lines(s, d)
    every, last = layout.keyword_by_page(x, "harvest"), layout.keyword_by_page(x, "harvest", 2)
    both = every.withColumn("kind", F.lit("hit")).unionByName(last.withColumn("kind", F.lit("last")))
    return both.select("kind", "doc", F.col("page").cast("long").alias("page"), F.col("line_no").cast("long").alias("line_no"), F.md5("context").alias("context_md5"))


@query
def keyword_dict(s: SparkSession, d: str) -> DataFrame:
    x = layout.keyword_dict(layout.keyword_in_context(_pdf_lines(s, d), ["harvest", "water"], 1))
    return x.select("doc", *[F.md5(F.array_join(F.try_element_at("contexts", F.lit(k)), "|")).alias(k) for k in ("harvest", "water")])


@query
def grab_sections(s: SparkSession, d: str) -> DataFrame:
    return layout.sections(_pdf_lines(s, d), "review").select("doc", F.md5("section").alias("section_md5"), F.char_length("section").cast("long").alias("chars"))


@query
def pdf_metadata(s: SparkSession, d: str) -> DataFrame:
    """pdfinfo's output and XMP, put together from publications, as fields."""
    p = table(s, d, "publications").select("uber_id", "title", "uuid", "journal_title").distinct()
    info = F.concat(F.lit("Title:  "), F.coalesce("title", F.lit("")), F.lit("\nCreator: "), F.coalesce("journal_title", F.lit("")), F.lit("\nPages: 3\nCreationDate: Mon: 1\nno key"))
    xmp = F.concat(F.lit("<x><xmpMM:DocumentID>uuid:a:"), F.coalesce("uuid", F.lit("")), F.lit("</xmpMM:DocumentID></x>"))
    x = p.select("uber_id", info.alias("info"), xmp.alias("xmp")).select("uber_id", readers.pdf_info("info").alias("m"), readers.document_id("xmp").alias("did"))
    return x.select("uber_id", *[F.col("m")[k].alias(k) for k in ("title", "creator", "created")], F.map_contains_key("m", "pages").alias("has_pages"), "did")


# Crawled pages


def _plain_title() -> Column:
    return F.trim(F.regexp_replace("title", "[^A-Za-z0-9 ,.:?-]", ""))


SITE_OF = ["who_iris", "nice", "gov_uk", "msf", "parliament", "unicef", "acme"]


def _site_pages(s: SparkSession, d: str) -> DataFrame:
    """(url, html, site): pages in the form of each site, put together from articles."""
    a = table(s, d, "articles").select("article_id", "title", "pub_year", F.col("url").alias("file")).distinct().where("title IS NOT NULL AND file IS NOT NULL").withColumn("t", _plain_title()).where("t <> ''")
    a = a.withColumn("site", F.element_at(F.array(*[F.lit(x) for x in SITE_OF]), (F.pmod("article_id", F.lit(len(SITE_OF))) + 1).cast("int"))).withColumn("y", F.coalesce(F.substring("pub_year", 1, 4), F.lit("")))
    c = lambda *x: F.concat(*[F.col(i[1:]) if i.startswith("$") else F.lit(i) for i in x])
    head = ("<html><head><title>", "$t", " | site</title></head><body>")
    body = {
        "who_iris": c(*head, "<table><tr><td>dc.title</td><td>", "$t", "</td></tr><tr><td>dc.subject.mesh</td><td>Air</td></tr></table><div class='file-link x'><a href='", "$file", "'>Open</a></div>"),
        "nice": c(*head, "<h1>", "$t", "</h1><p class='published-date'><time datetime='", "$y", "-05-01'>May</time></p><a class='track-link' href='/no'>x</a><a href='", "$file", "'>Save as PDF</a>"),
        "gov_uk": c(*head, "<h1>\n  ", "$t", " \n</h1><section class='attachment-details'><h2><a href='", "$file", "'>File</a></h2></section><a href='/other.pdf'>no</a>"),
        "msf": c(*head, "<div class='field-item even'><p><a class='btn' href='", "$file", "'><img alt='", "$t", "'></a></p><p>none</p></div>"),
        "parliament": c(*head, "<a href='", "$file", "'>pdf</a><a href='/x.html'>page</a>"),
        "unicef": c(*head, "<h1>", "$t", "</h1><p><a href='", "$file", "'>pdf</a><a href='/x'>page</a></p>"),
        "acme": c(*head, "<a class='doc-download-link' href='", "$file", "'>", "$t", "</a>"),
    }
    html = F.coalesce(*[F.when(F.col("site") == k, v) for k, v in body.items()])
    own = a.select(F.concat(F.lit("https://pages.example/"), F.col("site"), F.lit("/"), F.col("article_id")).alias("url"), F.concat(html, F.lit("</body></html>")).alias("html"), "site")
    result = c("<html><body><ul id='results'><li><h4><a href='/parliament/", "$article_id", "'> ", "$t", " </a></h4><p class='resultdetails'> 01 May ", "$y", "</p><p class='resultdetails'>Report </p></li></ul><p class='next'><a href='?page=2'>Next</a></p></body></html>")
    listing = a.where("site = 'parliament'").select(F.concat(F.lit("https://pages.example/parliament/list-"), F.col("article_id")).alias("url"), result.alias("html"), "site")
    cards = c("<html><body><h3 class='card__heading'><a href='/guidance/", "$article_id", "'>", "$t", "</a></h3><ul><li><a href='/p2'>Next page</a></li></ul></body></html>")
    more = a.where("site = 'nice'").select(F.concat(F.lit("https://pages.example/nice/list-"), F.col("article_id")).alias("url"), cards.alias("html"), "site")
    return own.unionByName(listing).unionByName(more)


@query
def site_files(s: SparkSession, d: str) -> DataFrame:
    pages = cut(scrape.extract_pages(_site_pages(s, d)))
    return scrape.site_files(pages, scrape.requests(pages)).select("source_page", "site", "pdf", "title", "year", "types", "page_title")


@query
def site_requests(s: SparkSession, d: str) -> DataFrame:
    return scrape.requests(scrape.extract_pages(_site_pages(s, d))).select("url", "site", "kind", "href", "title", "year", "types")


@query
def page_titles(s: SparkSession, d: str) -> DataFrame:
    """Titles, headings and distinct PDF links of pages."""
    pages = cut(scrape.extract_pages(_site_pages(s, d)))
    links = scrape.pdf_links(pages).groupBy("url").agg(F.count("*").alias("pdfs"))
    return pages.join(links, "url", "left").select("url", F.col("title").alias("page_title"), F.size("headings").cast("long").alias("headings"), F.coalesce("pdfs", F.lit(0)).cast("long").alias("pdfs"))


@query
def who_articles(s: SparkSession, d: str) -> DataFrame:
    pages = scrape.extract_pages(_site_pages(s, d)).where("site = 'who_iris'")
    return scrape.articles(pages).select("url", "title", "pdf", F.array_join("subjects", ",").alias("subjects"))


@query
def new_files(s: SparkSession, d: str) -> DataFrame:
    """Files that an earlier crawl has not stored, with where they go."""
    a = table(s, d, "articles").select("article_id", "file_hash", "pdf", "date_scraped").distinct()
    new = scrape.new_files(a.where("date_scraped >= timestamp'2020-01-01'"), a.where("date_scraped < timestamp'2020-01-01'"), "file_hash", "pdf")
    return new.select("article_id", "file_hash", urls.storage_key("docs", F.col("file_hash")).alias("key"))


@query
def response_kinds(s: SparkSession, d: str) -> DataFrame:
    """Responses told apart by content type and URL, and failures by the name of their error."""
    a = _articles(s, d, "url", "url_filename")
    kinds = ["application/pdf; charset=x", "application/octet-stream", "text/html", None]
    errors = ["HttpError", "DNSLookupError", "TCPTimedOutError", "IgnoreRequest by robots.txt", "ValueError", None]
    pick = lambda xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.pmod("article_id", F.lit(len(xs))) + 1).cast("int"))
    x = a.withColumn("error", pick(errors)).withColumn("ct", pick(kinds))
    return x.select("article_id", urls.is_pdf_response(F.col("ct"), F.col("url")).alias("is_pdf"), scrape.failure_kind("error").alias("failure"), urls.disposition_title(F.concat(F.lit('attachment; filename="'), F.col("url_filename"), F.lit('"'))).alias("title"))


@query
def storage_locations(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d, "file_hash", "url_filename")
    url = F.concat(F.when(F.col("article_id") % 3 == 0, "s3://").when(F.col("article_id") % 3 == 1, "manifests3://").otherwise("https://"), F.lit("bucket/"), urls.storage_key("docs", F.col("file_hash")))
    p = urls.storage_parts(url)
    return a.select("article_id", p["bucket"].alias("bucket"), p["key"].alias("key"), text.datestamped(F.col("url_filename"), F.lit("2020-01-31")).alias("stamped"), urls.file_digest(F.col("url_filename").cast("binary")).alias("digest"))


# Search and display


@query
def search_citations_count(s: SparkSession, d: str) -> DataFrame:
    pubs = table(s, d, "publications").select("uber_id", "title", "journal_title").distinct()
    from ..functions import fulltext

    hits = search.ranked(pubs, fulltext.lexemes((F.col("title"), "A"), (F.col("journal_title"), "C")), "of and")
    return search.cited(hits, _citations(s, d), "uber_id").agg(F.count("uber_id").alias("n"))


@query
def search_response(s: SparkSession, d: str) -> DataFrame:
    """Responses of three requests: a page with its count, and two errors."""
    hits = cut(_found(s, d, "study").select("policy_id", "title", "rank"))
    rows = []
    for name, sort, terms in (("page", "title", "study"), ("sort", "foo", "study"), ("empty", None, " ")):
        r = search.respond(hits, search.POLICY_SORTS, "policy_id", terms, sort, "asc", 10, fields=["policy_id", "title"])
        rows.append((name, r["status"], r.get("message"), r.get("count", 0), ",".join(str(x["policy_id"]) for x in r.get("data", []))))
    return s.createDataFrame(rows, "request string, status string, message string, n long, ids string")


@query
def legacy_search_page(s: SparkSession, d: str) -> DataFrame:
    """Matches of any field in order of title, second page, with the distinct count beside."""
    hit = search.any_field_matches("study", F.col("title"), F.col("organisation"), F.col("types"))
    x = _articles(s, d, "title", "organisation", "types").where(hit)
    n = x.agg(F.countDistinct("article_id").alias("matches"))
    page = x.orderBy(F.col("title").asc_nulls_last(), "article_id", "types").offset(25).limit(25)
    return page.crossJoin(F.broadcast(n)).select("article_id", "title", "matches")


@query
def display_rows(s: SparkSession, d: str) -> DataFrame:
    a = _articles(s, d, "title", "pub_year", "url", "organisation").where("url IS NOT NULL")
    page = (F.pmod("article_id", F.lit(9)) + 1).cast("int")
    org = F.element_at(F.array(*[F.lit(x) for x in ("who_iris", "nice", "acme")]), (F.pmod("article_id", F.lit(3)) + 1).cast("int"))
    pages = F.array_join(F.transform(text.page_numbers(F.lit(210), page), lambda x: x.cast("string")), " ")
    return a.select("article_id", text.display_title(F.col("title")).alias("title"), F.coalesce("pub_year", F.lit("Unknown")).alias("year"), text.display_organisation(org).alias("org"), text.pages_shown(F.lit(210), page).alias("shown"), pages.alias("pages"))


@query
def publication_display(s: SparkSession, d: str) -> DataFrame:
    p = table(s, d, "publications").select("uber_id", "authors", "modified").distinct()
    return p.select("uber_id", text.display_authors(F.col("authors")).alias("authors"), text.json_value(F.col("modified").cast("timestamp")).alias("modified"))


@query
def contact_forms(s: SparkSession, d: str) -> DataFrame:
    """Which entries of contributors, read as a form, would be accepted."""
    c = table(s, d, "contributors").select("contributor_id", "lastname", "affiliation", "authors").distinct()
    mail = F.concat(F.coalesce("lastname", F.lit("")), F.when(F.col("contributor_id") % 3 == 0, "@mail").otherwise("@mail.example"))
    return c.select("contributor_id", text.valid_contact([F.col("affiliation"), F.coalesce("lastname", "authors")], mail).alias("valid"))


@query
def author_words(s: SparkSession, d: str) -> DataFrame:
    """Authors of references dealt to search words: comma separated, then by blanks."""
    r = table(s, d, "structured_refs").select("reference_id", "authors").distinct().where("authors IS NOT NULL")
    w = F.filter(F.flatten(F.transform(F.split("authors", ","), lambda x: F.split(x, " "))), lambda x: x != "")
    return r.select("reference_id", F.size(w).cast("long").alias("n"), F.array_join(w, "|").alias("words"))


# Evaluation


def _predicted_subjects(s: SparkSession, d: str) -> DataFrame:
    """Labelled documents with their least label as actual, and as predicted subject the one of
    whose description the text holds most words (ties to the least name; none: null)."""
    lab = table(s, d, "subject_labels").where("subject IS NOT NULL").groupBy("doc_id").agg(F.min("subject").alias("actual"))
    docs = table(s, d, "documents").select("doc_id", "source", "text").join(lab, "doc_id")
    words = table(s, d, "subject_areas").select("subject", F.explode(F.array_distinct(text.words(F.col("description"), r"[\p{L}]{4,}"))).alias("w"))
    hits = docs.select("doc_id", F.explode(F.array_distinct(text.words(F.col("text"), r"[\p{L}]{4,}"))).alias("w")).join(F.broadcast(words), "w").groupBy("doc_id", "subject").agg(F.count("*").alias("n"))
    best = hits.groupBy("doc_id").agg(F.min_by("subject", F.struct(-F.col("n"), "subject")).alias("predicted"))
    return docs.select("doc_id", "source", "actual").join(best, "doc_id", "left")


@query
def eval_confusion(s: SparkSession, d: str) -> DataFrame:
    return evaluate.confusion(_predicted_subjects(s, d), "actual", "predicted")


@query
def eval_report(s: SparkSession, d: str) -> DataFrame:
    return evaluate.class_report(_predicted_subjects(s, d), "actual", "predicted")


@query
def eval_by_source(s: SparkSession, d: str) -> DataFrame:
    return evaluate.accuracy_by(_predicted_subjects(s, d), "source", "doc_id", "actual", "predicted")


@query
def eval_by_source_and_subject(s: SparkSession, d: str) -> DataFrame:
    x = _predicted_subjects(s, d).withColumn("label", F.col("actual"))
    return evaluate.accuracy_by(x, ["source", "label"], "doc_id", "actual", "predicted")


@query
def eval_columns(s: SparkSession, d: str) -> DataFrame:
    """Accuracy of the columns of references that name one publication by volume and pages."""
    x = _cited(s, d).withColumn("year", F.col("pub_year").cast("string")).withColumns({c: text.clean_text(F.col(c)) for c in ("actual", "predicted")})
    return evaluate.accuracy_of_columns(x, {"title": ("actual", "predicted"), "year": ("year", "ref_year")}, 0.2)


@query
def eval_split_total(s: SparkSession, d: str) -> DataFrame:
    """Counts of split references against numbered lines: median per cent off, for each
    organisation and for all."""
    split = references.split_references(_sections(s, d), "section_id", "sections").groupBy("doc").agg(F.count("*").alias("predicted"))
    n = layout.text_lines(_sections(s, d), "section_id", "sections").where(F.col("text").rlike(r"^\[?[0-9]+[.\])] ")).groupBy("doc").agg(F.count("*").alias("actual"))
    sec = table(s, d, "pdf_sections").select(F.col("section_id").alias("doc"), "organisation").distinct().where("organisation IS NOT NULL")
    x = sec.join(split, "doc").join(n, "doc").withColumn("off", text.percent_off(F.col("predicted"), F.col("actual")))
    g = x.rollup("organisation").agg(F.grouping("organisation").alias("_g"), F.bround(F.median("off"), 3).alias("median_off"), F.count("*").alias("n"))
    return g.select(F.when(F.col("_g") == 1, "all").otherwise(F.col("organisation")).alias("organisation"), "median_off", "n")


@query
def eval_binary(s: SparkSession, d: str) -> DataFrame:
    x = _similarities(s, d).withColumn("yes", (F.col("sim") > 0.7) & (F.col("chars") > 40))
    return evaluate.binary_scores(x, "positive", "yes")


@query
def file_comparison(s: SparkSession, d: str) -> DataFrame:
    """One organisation's references beside their publications: lengths and rounded distance."""
    x = _cited(s, d).where("organisation = 'kretimport_evidence_centre'").dropna(subset=["actual", "predicted"])
    x = x.withColumns({c: text.clean_text(F.col(c)) for c in ("actual", "predicted")})
    return x.select("reference_id", "uber_id", F.char_length("actual").cast("long").alias("actual_chars"), F.char_length("predicted").cast("long").alias("predicted_chars"), text.half_even(text.edit_distance_or_zero(F.col("actual"), F.col("predicted")), 2).alias("distance"))


@query
def unmatched_publications(s: SparkSession, d: str) -> DataFrame:
    """Publications that no reference is matched with."""
    p = _pubs(s, d).select("uber_id").distinct()
    return p.join(fuzzy_tfidf_top1(s, d).select("uber_id").distinct(), "uber_id", "left_anti")


@query
def organisation_numbers(s: SparkSession, d: str) -> DataFrame:
    """Numbers of organisations: those known before 2012 keep theirs, new ones follow."""
    a = table(s, d, "articles").select("organisation", "date_scraped").where("organisation IS NOT NULL")
    none = s.createDataFrame([], "organisation string, number long")
    known = cut(manifest.dimension_ids(none, a.where("date_scraped < timestamp'2012-01-01'"), "organisation", "number"))
    return manifest.dimension_ids(known, a, "organisation", "number")


@query
def zipped_predictions(s: SparkSession, d: str) -> DataFrame:
    """Split references beside their components by position."""
    split = references.split_references(_sections(s, d), "section_id", "sections")
    parts = references.structured(split).groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "PubYear"))), lambda e: e["PubYear"]).alias("years"))
    whole = split.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("position", "reference"))), lambda e: e["reference"]).alias("refs"))
    z = whole.join(parts, "doc").select("doc", F.posexplode(F.arrays_zip("refs", "years")).alias("position", "z"))
    return z.select(F.col("doc").alias("section_id"), F.col("position").cast("long").alias("position"), F.md5("z.refs").alias("reference_md5"), F.col("z.years").alias("year"))
