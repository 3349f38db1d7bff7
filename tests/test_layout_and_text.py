from pyspark.sql import functions as F

from citeloom.functions import text, urls
from citeloom.operators import layout, references

SCHEMA = "doc string, page int, line_no int, size int, bold boolean, text string, face string"


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first().x


def test_scalars(spark):
    assert one(spark, text.clean_text(F.lit("A - b\nC"))) == "a  b c"
    assert one(spark, text.title_case(F.lit("WORLD Malaria"))) == "World malaria"
    assert one(spark, text.title_case(F.lit("éa"))) == "éa"
    assert one(spark, text.display_title(F.lit(None).cast("string"))) == "Title unavailable"
    assert one(spark, text.first_title(F.lit(""), F.array().cast("array<string>"), F.array(F.lit("H")))) == "H"
    assert one(spark, text.first_title(F.lit(""), F.array(F.lit("")), F.array(F.lit("H")))) == ""
    assert one(spark, text.edit_distance_or_zero(F.lit(""), F.lit("abc"))) == 0
    assert one(spark, text.edit_share(F.lit(""), F.lit("abc"))) == 1.0
    assert one(spark, text.edit_share(F.lit(""), F.lit(""))) == 0.0
    assert one(spark, text.percent_off(F.lit(3), F.lit(0))) == 300
    long = " ".join("abcdefghij" for _ in range(60))
    assert one(spark, text.long_title(F.lit(long))) == " ".join(long[:512].split()[:-1])
    assert one(spark, text.author_string(F.array(F.struct(F.lit(None).cast("string").alias("lastname"), F.lit(None).cast("string").alias("initials"))))) == "Unknown ?"
    assert one(spark, text.pages_shown(F.lit(30), F.lit(1))) == "Showing 1 - 25 of 30"


def test_pdf_urls(spark):
    cases = {"": False, "a.pdf": True, "/x/A.PDF": True, "http://h/a.pdf?x=1": True, "mailto:a.pdf": False, "http://h/a?f=b.pdf": False, "http://[::1": False}
    df = spark.createDataFrame([(u,) for u in [*cases, None]], "u string")
    got = {r.u: r.ok for r in df.select("u", urls.is_pdf_url(F.col("u")).alias("ok")).collect()}
    assert got == {**cases, None: False}
    assert one(spark, urls.disposition_title(F.lit('attachment; filename="a b.pdf"'))) == "a b.pdf"


def test_fonts(spark):
    lines = spark.createDataFrame([("d", 1, 0, 17, True, "Page 1 - Title 1", "Times"), ("d", 2, 1, 17, True, "Page 2 - Title 2", "Times"), ("d", 2, 2, 12, False, "Page 2 - Text 1", "Times")], SCHEMA)
    r = layout.font_stats(lines).first()
    assert (r.mean_size, r.upper_mean_size, r.sizes) == (16, 17, [12, 17])
    assert [x.text for x in layout.title_candidates(lines, 2).orderBy("rank").collect()] == ["Page 1 - Title 1", "Page 2 - Title 2"]


def test_keyword_context(spark):
    df = spark.createDataFrame([(1, "Key here key\nb\nc\nkeys\ne")], "id int, t string")
    got = [(r.line_no, r.hits, r.context) for r in layout.keyword_in_context(layout.text_lines(df, "id", "t"), ["key"]).collect()]
    assert got == [(0, 2, "Key here key\nb\nc")]


def test_section_to_next_heading(spark):
    rows = [("d", 0, 0, 20, False, "References", "T"), ("d", 0, 1, 10, False, "one", "T"), ("d", 1, 2, 10, False, "two", "T"), ("d", 1, 3, 10, False, "x", "T"), ("d", 2, 4, 20, False, "Annex", "T"), ("d", 2, 5, 10, False, "no", "T")]
    lines = spark.createDataFrame(rows, SCHEMA)
    assert layout.sections(lines, "reference").first().section == "References\none\ntwo\nx"
    assert layout.sections(lines, "Reference").count() == 0


def test_pdf_xml(spark):
    xml = '<pdf2xml><page><fontspec id="0" size="12" family="Times"/><text font="0">Test</text><text font="0">Partly <b>bold</b> line.</text></page><page><text font="9">x</text></page></pdf2xml>'
    df = spark.createDataFrame([("a", xml), ("b", "<broken"), ("c", None)], "id string, xml string")
    got = [(r.page, r.line_no, r.size, r.text) for r in layout.parse_pdf_xml(df, "id", "xml").orderBy("line_no").collect()]
    assert got == [(1, 0, 12, "Test"), (1, 1, 12, "Partly  bold  line."), (2, 2, None, "x")]


def test_components(spark):
    toks = [("Medecins", "author"), ("Sans", "author"), (".", "o"), ("TB", "title"), ("Spot", "title"), ("Report", "title"), ("2011", "year")]
    df = spark.createDataFrame([("d", 0, "r", toks), ("d", 1, "s", [])], "doc string, position int, reference string, attributes array<struct<token:string,label:string>>")
    got = references.structured(df).collect()
    assert len(got) == 1 and (got[0].Title, got[0].Authors, got[0].PubYear) == ("TB Spot Report", "Medecins Sans", "2011")
    split = references.split_references(spark.createDataFrame([("d", "1. Bo Lee. A title of a work. 2010.\n2. Cy Dee. Another\ntitle here. 2011.")], "doc string, s string"), "doc", "s")
    assert [r.reference for r in split.orderBy("position").collect()] == ["Bo Lee. A title of a work. 2010.", "Cy Dee. Another title here. 2011."]
    assert {r.PubYear for r in references.structured(split).collect()} == {"2010.", "2011."}
