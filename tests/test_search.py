import pytest
from pyspark.sql import functions as F

from citeloom.functions import fulltext
from citeloom.operators import search


def rank(spark, hits, query):
    v = F.array(*[F.struct(F.lit(w).alias("lexeme"), F.lit(p).alias("pos"), F.lit(fulltext.WEIGHT[k]).alias("weight")) for w, p, k in hits])
    r = spark.range(1).select(fulltext.matches(v, fulltext.parse(query)).alias("m"), fulltext.cover_rank(v, fulltext.parse(query)).alias("r")).first()
    return r.m, r.r


def test_golden_rank(spark):
    m, r = rank(spark, [("africa", 23, "A"), ("malaria", 34, "C")], "malaria,africa")
    assert m and r == pytest.approx(0.030303031, abs=1e-7)


def test_query_language(spark):
    hits = [("the", 1, "A"), ("red", 2, "A"), ("cat", 3, "A")]
    for q, want in [("red cat", True), ('"red cat"', True), ('"the cat"', False), ("dog or cat", True), ("cat -red", False), ("cat -dog", True), ("", False), (None, False), ("!!", False)]:
        assert rank(spark, hits, q)[0] is want, q


def test_pages():
    P = search.Page.of
    assert P(search.POLICY_SORTS, page=0).offset == P(search.POLICY_SORTS, page=1).offset == 0
    assert P(search.POLICY_SORTS, page=3).offset == 50
    assert not P(search.POLICY_SORTS, order="asc").ascending  # without a sort the order is ignored
    for bad in ({"sort": "foo"}, {"order": "up"}):
        with pytest.raises(ValueError):
            P(search.POLICY_SORTS, **bad)


def test_null_order_and_ties(spark):
    df = spark.createDataFrame([(1, None), (2, "2001"), (3, "1999"), (4, "2001")], "id int, year string")
    ids = lambda p: [r.id for r in p.take(df, "id").collect()]
    assert ids(search.Page.of(search.POLICY_SORTS, "year", "asc")) == [3, 2, 4, 1]
    assert ids(search.Page.of(search.POLICY_SORTS, "year", "desc")) == [1, 2, 4, 3]


def test_nested_and_flat_policies(spark):
    rows = spark.createDataFrame([("a", ["p1", "px"]), ("b", []), ("c", None)], "uuid string, policies array<string>")
    pol = spark.createDataFrame([("p1", "T")], "policy_id string, name string")
    nested = {r.uuid: r.policies for r in search.with_policies(rows, "uuid", pol, ["policy_id", "name"]).collect()}
    assert len(nested["a"]) == 1 and nested["b"] is None and nested["c"] is None
    flat = sorted((r.uuid, r.policy_id) for r in search.flat_rows(rows, "uuid", pol).collect())
    assert flat == [("a", "p1"), ("b", None), ("c", None)]


def test_json_array_of_nothing(spark):
    df = spark.createDataFrame([], "a int")
    assert search.json_array(df).first().json == "null"


def test_terms_per_field():
    assert search.terms_per_field("bar,foo,baz,nice,J.Doe", "text,title,text,organisation,authors") == {"text": ["bar", "baz"], "title": ["foo"], "organisation": ["nice"], "authors": ["j", "doe"]}
    assert {k: len(v) for k, v in search.terms_per_field("bar baz,pizza celery brocoli mayo,foo kix", "text,title,text").items()} == {"text": 4, "title": 4}
