import pytest
from pyspark.sql import functions as F

from citeloom.operators import evaluate, limits, manifest, scrape
from citeloom.sources import readers, writers
from citeloom.streaming import incremental

DETAIL = """<html><head><title>T &amp; x</title></head><body><h1>Head</h1><h2><a href="q">in link</a></h2>
<table><tr><td>dc.title</td><td>Air control</td><td>en</td></tr><tr><td>dc.subject.mesh</td><td>Air</td></tr><tr><td>dc.subject.mesh</td><td>Law</td></tr>
<tr><td>dc.date.issued</td><td>2019-05</td></tr></table><div class="file-link"><a href="/foo.pdf">Open</a></div><a href="x.html">no</a></body></html>"""


def test_html(spark):
    df = spark.createDataFrame([("http://h/a/b", DETAIL, "who_iris"), ("http://h/l", '<div class="artifact-title"><a href="2.html">Two</a></div>', "who_iris"), ("u", None, None)], "url string, html string, site string")
    pages = scrape.extract_pages(df)
    by = {r.url: r for r in pages.collect()}
    assert by["http://h/a/b"].title == "T & x" and by["http://h/a/b"].headings == ["Head"]
    assert by["http://h/a/b"].fields["subject mesh"] == ["Air", "Law"]
    assert by["http://h/l"].links[0].href == "http://h/2.html?show=full" and by["http://h/l"].links[0].kind == "article"
    a = {r.url: r for r in scrape.articles(pages).collect()}["http://h/a/b"]
    assert (a.title, a.year, a.pdf, a.subjects) == ("Air control", "2019", "http://h/foo.pdf", ["Air", "Law"])


def test_manifest(spark):
    old = spark.createDataFrame([("aa1", "old"), ("bb", "keep")], "hash string, v string")
    new = spark.createDataFrame([("aa1", "new"), ("aa2", "x"), (None, "n"), ("", "e")], "hash string, v string")
    got = {r.hash: r.v for r in manifest.merge(old, new, "hash", ["v"]).collect()}
    assert got == {"aa1": "new", "bb": "keep", "aa2": "x"}
    assert {r.prefix: r.hashes for r in manifest.buckets(new, "hash").collect()} == {"aa": ["aa1", "aa2"]}


def test_scores(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "a")], "x string, y string")
    r = {z.label: (z.precision, z.recall, z.support) for z in evaluate.class_report(df, "x", "y").collect()}
    assert r == {"a": (1.0, 0.5, 2), "b": (0.5, 1.0, 1)}
    empty = spark.createDataFrame([], "i int")
    assert evaluate.pair_scores(empty, empty, ["i"]).first().f1 == 0.0


def test_json_round_trip_and_reload(spark, tmp_path):
    df = spark.createDataFrame([("o1", 1, None), ("o2", 2, "b")], "organisation string, n int, s string")
    with pytest.raises(ValueError):
        writers.json_lines(df, str(tmp_path / "x.json"))
    p = str(tmp_path / "x.json.gz")
    writers.json_lines(df, p)
    assert sorted(readers.json_lines(spark, p, df.schema.simpleString()[7:-1].replace(":", " ")).collect()) == sorted(df.collect())
    t = str(tmp_path / "t")
    for _ in range(2):
        writers.reload_partition(df, t)
        writers.reload_partition(df.where("organisation = 'o1'").withColumn("n", F.lit(5)), t)
    assert sorted((r.organisation, r.n) for r in spark.read.parquet(t).collect()) == [("o1", 5), ("o2", 2)]
    assert writers.append_counted(df, str(tmp_path / "c")) == 2


def test_files_and_folders(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "ref.txt").write_text("text")
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "other.txt").write_text("y")
    got = {(r.document, r.section): r.text for r in readers.section_texts(spark, str(tmp_path), ["ref"]).collect()}
    assert got == {("a", "ref"): "text", ("b", "ref"): ""}
    assert readers.latest_file(spark, str(tmp_path), by_name=True).endswith("other.txt")
    (tmp_path / "k.txt").write_text("# c\nRef\n\nB\n")
    assert readers.keyword_file(spark, str(tmp_path / "k.txt")) == ["ref", "b"]
    info = spark.createDataFrame([("Title: A: b\nPages: 3\nbad",)], "t string").select(readers.pdf_info("t").alias("m")).first().m
    assert info == {"title": "A: b"}


def test_stream_equals_batch(spark, tmp_path):
    rows = [("u", "r", "2024-01-01 00:10:00"), ("u", "r", "2024-01-01 00:20:00"), ("u", "r", "2024-01-01 01:00:00"), ("v", "r", "2024-01-01 05:00:00")]
    df = spark.createDataFrame(rows, "user string, res string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = incremental.call_windows(s, "user", "res", "ts").writeStream.format("memory").queryName("calls").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(spark.table("calls").collect()) == sorted(incremental.call_windows(df, "user", "res", "ts").collect())
    m = incremental.keep_manifest(s.select("user", "res"), str(tmp_path / "m"), "user", ["res"], str(tmp_path / "cp"))
    m.awaitTermination()
    assert {r.user for r in spark.read.parquet(str(tmp_path / "m")).collect()} == {"u", "v"}


def test_trailing_calls(spark):
    rows = [(i, "u", i) for i in range(301)] + [(900, "u", 400), (901, "v", 100), (902, "u", 200)]  # tenths of a second
    df = spark.createDataFrame(rows, "id int, user string, s long").withColumn("ts", F.timestamp_micros(F.col("s") * 100_000))
    got = {r.id: r.calls for r in limits.trailing_calls(df, ["user"], "ts", 10).collect()}
    want = {i: sum(1 for _, u2, s2 in rows if u2 == u and s - 100 <= s2 <= s) for i, u, s in rows}
    assert got == want
    assert limits.exceeded(df, ["user"], "ts", 10, 10.0).count() == sum(n / 10 > 10 for n in want.values())
