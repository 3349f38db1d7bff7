import pytest
from pyspark.sql import functions as F

from citeloom import pipeline
from citeloom.functions import text, urls
from citeloom.operators import evaluate, layout, manifest, matching, references, scrape, search
from citeloom.sources import readers, writers

LINES = "doc string, page int, line_no int, size int, bold boolean, text string, face string"
NICE = """<html><head><title>x</title></head><body><h1>StoneChecker for kidney stone evaluation</h1><p class="published-date"><time datetime="2019-04-03">3 April</time></p>{}</body></html>"""


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_file_link_fallbacks_and_year(spark):
    pages = [
        ("http://n/1", NICE.format('<a class="track-link" href="/b">B</a><a href="/a">Save as PDF</a>'), "nice"),
        ("http://n/2", NICE.format('<a class="track-link" href="/b">B</a><a id="nice-download" href="/c">C</a>'), "nice"),
        ("http://n/3", NICE.format('<a id="nice-download" href="/c">C</a>'), "nice"),
        ("http://n/4", NICE.format("<p>none</p>"), "nice"),
        ("http://n/5", "<p class='x'>unclosed <a href='/a.pdf'>", "no_such_site"), ("http://n/6", None, None),
    ]
    p = scrape.extract_pages(spark.createDataFrame(pages, "url string, html string, site string"))
    got = {r.source_page: (r.pdf, r.title, r.year) for r in scrape.site_files(p).collect()}
    t = "StoneChecker for kidney stone evaluation"
    assert got == {"http://n/1": ("http://n/a", t, "2019"), "http://n/2": ("http://n/b", t, "2019"), "http://n/3": ("http://n/c", t, "2019")}
    assert p.count() == 6


def test_listing_details_pass_on(spark):
    listing = "<ul id='results'><li><h4><a href='/d'> Title </a></h4><p class='resultdetails'>01 May 2018</p><p class='resultdetails'> Report </p></li><li><h4><a href='/e'>Other</a></h4><p class='resultdetails'>2 Jun 2017</p></li></ul>"
    p = scrape.extract_pages(spark.createDataFrame([("http://p/l", listing, "parliament"), ("http://p/d", "<a href='x.pdf'>x</a><a href='y'>y</a>", "parliament")], "url string, html string, site string"))
    asked = scrape.requests(p)
    assert {(r.href, r.title, r.year, r.types) for r in asked.collect()} == {("http://p/d", "Title", "2018", "Report"), ("http://p/e", "Other", "2017", None)}
    got = scrape.site_files(p, asked).collect()
    assert [(r.pdf, r.title, r.year, r.types) for r in got] == [("http://p/x.pdf", "Title", "2018", "Report")]
    msf = "<div class='field-item'><p><a class='btn' href='/a.pdf'><img alt='Annual'></a></p><p><a class='btn' href='/b.doc'>no</a></p></div>"
    p = scrape.extract_pages(spark.createDataFrame([("http://m/", msf, "msf")], "url string, html string, site string"))
    assert [(r.pdf, r.title) for r in scrape.site_files(p).collect()] == [("http://m/a.pdf", "Annual")]
    items = spark.createDataFrame([("h1", "a.pdf"), ("h2", ""), ("h3", "c.pdf"), (None, "d.pdf")], "h string, pdf string")
    assert {r.pdf for r in scrape.new_files(items, items.where("h = 'h1'"), "h", "pdf").collect()} == {"c.pdf", "d.pdf"}


def test_ranges_of_files(spark, tmp_path):
    f = tmp_path / "x.jsonl"
    f.write_text('{"a":1,"b":"é"}\n{"a":2}\n\n{"b":"z"}\n{"a":5,"b":"w"}')
    rows = [(r.a, r.b) for r in readers.byte_range_json(spark, str(f), 27, "a int, b string").collect()]
    assert rows == [(1, "é"), (2, None)]
    assert readers.byte_range(spark, str(f), 10_000).count() == 5 and readers.byte_range(spark, str(f), 3).count() == 0
    got = [(r.line_no, r.a) for r in readers.first_lines(spark, str(f), "a int, b string", 5, ["a", "b"]).orderBy("line_no").collect()]
    assert got == [(0, 1), (4, 5)] and readers.first_lines(spark, str(f), "a int, b string", 4, ["a", "b"]).count() == 1
    (tmp_path / "x.csv").write_text('id,t\n1,"a, ""b"""\n2,c\n3,cut')
    assert [(r.id, r.t) for r in readers.byte_range_csv(spark, str(tmp_path / "x.csv"), 22, "id int, t string").collect()] == [(1, 'a, "b"'), (2, "c")]
    assert readers.object_text(spark, str(tmp_path), "nothing") is None and readers.object_text(spark, str(tmp_path), "x.csv").startswith("id,t")
    writers.save_object(spark, b"abc", str(tmp_path / "o"))
    assert (tmp_path / "o").read_bytes() == b"abc"
    assert readers.location("s3://b/k") == "s3a://b/k" and readers.location("/x") == "/x"
    assert readers.match_tables(spark, str(tmp_path), ".none").columns == ["Document id", "WT_Ref_Id"]


def test_empty_outputs_stay_readable(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, t string")
    out = writers.two_outputs(df, str(tmp_path / "a.json.gz"), str(tmp_path / "b.json.gz"), lambda x: x.where("id > 5").select("t"))
    assert out.count() == 0 and spark.read.schema("id int, t string").json(str(tmp_path / "a.json.gz")).count() == 2
    path = str(tmp_path / "t")
    assert not writers.exists(spark, path) and writers.count_rows(spark, path) == 0 and writers.columns_of(spark, path) == {}
    writers.recreate(df, path)
    assert writers.delete_where(spark, path, F.col("t") == "a", str(tmp_path / "u")) == 1
    assert writers.count_rows(spark, path) == 2 and set(writers.columns_of(spark, path)) == {"id", "t"}


def test_lines_of_a_page(spark):
    rows = [("d", 1, i, 10 + i % 2, i == 3, t, "T") for i, t in enumerate(["Water a", "water b", "x", "see water.", "waters"])] + [("d", 2, 5, 10, False, "water", "T")]
    lines = spark.createDataFrame(rows, LINES)
    assert [r.line_no for r in layout.keyword_by_page(lines, "water").orderBy("line_no").collect()] == [1, 3, 5]
    assert [(r.page, r.line_no, r.context) for r in layout.keyword_by_page(lines, "water", 1).orderBy("page").collect()] == [(1, 3, "x\nsee water.\nwaters"), (2, 5, "water")]
    assert layout.lines_of_size(lines, 11).count() == 2 and [r.line_no for r in layout.bold_lines(lines).collect()] == [3]
    assert layout.full_text(lines).first().text.count("\n") == 5
    d = layout.keyword_dict(layout.keyword_in_context(lines, ["x"], 1)).first().contexts
    assert d == {"x": ["water b\nx\nsee water."]}
    assert layout.page_text(spark.createDataFrame([("d", 1, 0, 9, False, "12", "T")], LINES), skip_numbers=True).first().text == "\n"


def test_documents(spark):
    df = spark.sql("SELECT 'h' AS file_hash, 'body' AS text, named_struct('title', 'P', 'created', '') AS pdf_metadata, named_struct('title', 'S', 'url', 'u') AS source_metadata UNION ALL SELECT 'e', '', NULL, NULL")
    r = references.text_documents(df, ["title", "url", "author"]).collect()
    assert [(x.file_hash, x.title, x.url, x.author) for x in r] == [("h", "P", "u", None)]
    m = spark.sql("SELECT named_struct('a', 1, 'sections', 's') AS metadata")
    assert references.without_sections(m).schema["metadata"].dataType.fieldNames() == ["a"]


def test_small_functions(spark):
    assert one(spark, text.edit_distance_or_zero(F.lit("abcd"), F.lit("abcx"))) == 0.25
    assert one(spark, text.half_even(F.lit(0.0625), 3)) == 0.062
    assert one(spark, text.blank(F.lit(float("nan")))) == "" and one(spark, text.blank(F.lit(3))) == "3"
    assert one(spark, text.datestamped(F.lit("a.json.gz"), F.lit("2020-01-02"))) == "a_2020-01-02.json.gz"
    assert one(spark, text.valid_contact([F.lit("x")], F.lit("a@b.c"))) and not one(spark, text.valid_contact([F.lit(None).cast("string")], F.lit("a@b.c")))
    assert one(spark, text.page_numbers(F.lit(0), F.lit(1))) == [1] and one(spark, text.page_numbers(F.lit(500), F.lit(10))) == [1, 0, 8, 9, 10, 11, 12, 0, 20]
    assert one(spark, text.json_value(F.lit("2020-01-02 03:04:05").cast("timestamp"))) == "2020-01-02T03:04:05"
    assert tuple(one(spark, urls.storage_parts(F.lit("s3://b/k/x.pdf")))) == ("b", "k/x.pdf") and one(spark, urls.storage_parts(F.lit("http://b/k"))) is None
    assert one(spark, urls.file_digest(F.lit("a").cast("binary"))) == "0cc175b9c0f1b6a831c399e269772661"


def test_evaluation(spark):
    df = spark.createDataFrame([("ab", "ab"), ("abcd", "abcx"), ("", "x"), (None, None)], "a string, p string")
    r = {x.component: x for x in evaluate.accuracy_of_columns(df, {"t": ("a", "p")}, 0.3).collect()}
    assert (r["all"].n, r["t"].filled, r["t"].strict, r["t"].lenient, r["t"].distance) == (4, 2, 0.5, 1.0, 0.062)
    b = evaluate.binary_scores(spark.createDataFrame([(True, True), (True, False), (False, False), (False, True), (False, False)], "a boolean, p boolean"), "a", "p").first()
    assert (b.negative_recall, b.positive_precision, b.f1) == (0.667, 0.5, 0.6)
    x = spark.createDataFrame([("p", "s", 1, "a", "a"), ("p", "t", 2, "", "b"), (None, "t", 3, "a", "a")], "g string, k string, i int, a string, b string")
    assert {(r.g, r.k, r.items, r.with_actual) for r in evaluate.accuracy_by(x, ["g", "k"], "i", "a", "b").collect()} == {("p", "s", 1, 1), ("p", "t", 1, 0)}


def test_responses_and_dimensions(spark):
    hits = spark.createDataFrame([(i, f"t{i}", 1.0) for i in range(30)], "id int, title string, rank double")
    r = search.respond(hits, {"rank": "rank", "title": "title"}, "id", "x", page=2, size=25)
    assert r["count"] == 30 and len(r["data"]) == 5 and r["status"] == "success"
    assert search.respond(hits, {"rank": "rank"}, "id", "x", order="up")["message"] == "Invalid ordering operation" and search.respond(hits, {"rank": "rank"}, "id", None)["status"] == "error"
    known = spark.createDataFrame([("b", 7)], "name string, no long")
    new = spark.createDataFrame([("c",), ("a",), ("b",), (None,), ("a",)], "name string")
    assert {r.name: r.no for r in manifest.dimension_ids(known, new, "name", "no").collect()} == {"b": 7, "a": 8, "c": 9}


def test_an_empty_corpus_is_an_error(spark):
    refs = spark.createDataFrame([(1, "x")], "r int, t string")
    for rows in ([], [(1, None)], [(1, "")]):
        with pytest.raises(ValueError):
            matching.tfidf_matches(refs, "r", "t", spark.createDataFrame(rows, "p int, title string"), "p", "title")
    with pytest.raises(ValueError):
        matching.bm25_matches(refs, "r", "t", refs, "r", "missing")


def test_a_hot_word_and_many_anchors(spark):
    """Every text holds the anchor word of one title; with and without the broadcast the same rows."""
    docs = spark.createDataFrame([(i, f"some words about anchorword and other things number {i} " + ("the quick brown anchorword jumps over the lazy dog here" if i % 3 == 0 else "")) for i in range(60)], "d int, t string")
    pubs = spark.createDataFrame([(1, "The quick brown anchorword jumps over the lazy dog")], "p int, t string")
    a, b = (sorted((r.d, r.p) for r in matching.exact_containment(docs, "d", "t", pubs, "p", "t", most_words=n, pubs_above=k).collect()) for n, k in ((0, 0), (100, 0)))
    plain = sorted((r.d, r.p) for r in matching.exact_containment(docs, "d", "t", pubs, "p", "t").collect())
    assert plain == a == b == [(i, 1) for i in range(0, 60, 3)]


def test_the_stages_in_a_row(spark, tmp_path):
    root = str(tmp_path)
    title = "Effects of clean water on the health of rural workers in northern districts"
    xml = f'<pdf2xml><page><fontspec id="0" size="20" family="T"/><fontspec id="1" size="10" family="T"/><text font="0">References</text><text font="1">1. Lee B. {title}. 2010.</text><text font="1">2. Dee C. An unrelated piece of work on nothing. 2011.</text></page></pdf2xml>'
    spark.createDataFrame([("http://a/1", '<a class="doc-download-link" href="x.pdf">T</a>', "acme")], "url string, html string, site string").write.json(f"{root}/pages")
    spark.createDataFrame([("d1", xml)], "doc string, xml string").write.json(f"{root}/xml")
    others = [(i, f"filler title number {i} about word{i} and other{i} topics") for i in range(2, 200)]
    spark.createDataFrame([(1, title), *others], "uber_id long, title string").write.parquet(f"{root}/publications")
    for _ in range(2):
        assert [pipeline.run(spark, s, root, "org") for s in pipeline.STAGES][:3] == [1, 1, 2]
    c = spark.read.parquet(f"{root}/cite").collect()
    assert [(r.uber_id, r.associated_policies_count, r.policies) for r in c] == [(1, 1, ["d1"])]
    assert pipeline.raw_path("s3://b/x_normalized/y") == "s3://b/x_raw/y"
