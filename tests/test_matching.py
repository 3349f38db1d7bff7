import math
import random
from collections import Counter

import pytest

from citeloom.operators import lookups, matching
from pyspark.sql import functions as F


def frames(spark, docs, pubs):
    return spark.createDataFrame(docs, "id long, section string"), spark.createDataFrame(pubs, "uber_id long, title string")


@pytest.mark.parametrize("title,least,n", [("Ebola", 3, 0), ("Malaria", 3, 1), ("MalariaX", 3, 0), ("Malaria", 8, 0)])
def test_exact_fixture(spark, title, least, n):
    d, p = frames(spark, [(123, "Malaria")], [(1, title)])
    assert matching.exact_containment(d, "id", "section", p, "uber_id", "title", least).count() == n


def test_exact_is_containment_against_brute_force(spark):
    texts = ["on the spread of malaria in towns and cities", "xmalaria in townsx", "Malaria - in towns", None, "", "the malaria in town"]
    titles = ["malaria in towns", "spread of malaria", "in towns", "alaria in town", None, "malaria in towns"]
    d, p = frames(spark, list(enumerate(texts)), list(enumerate(titles)))
    got = {(r.id, r.uber_id) for r in matching.exact_containment(d, "id", "section", p, "uber_id", "title", 8).collect()}
    import re

    clean = lambda x: re.sub("[^A-Za-z0-9 ]", "", re.sub(r"\s+", " ", x.replace("\n", " "))).lower()
    want = {(i, j) for i, a in enumerate(texts) if a is not None for j, b in enumerate(titles) if b and len(clean(b)) >= 8 and clean(b) in clean(a)}
    assert got == want


def tfidf(spark, titles, query, least=0.75):
    p = spark.createDataFrame(list(enumerate(titles)), "uber_id long, title string")
    r = spark.createDataFrame([(9, query)], "reference_id long, title string")
    return matching.tfidf_matches(r, "reference_id", "title", p, "uber_id", "title", least).collect()


def test_tfidf_fixtures(spark):
    assert tfidf(spark, ["Malaria", "Zika"], "Ebola") == []
    assert tfidf(spark, ["Malaria", "Zika"], "Malaria")[0].similarity == 1.0
    assert tfidf(spark, ["Malaria", "Zika"], "Malaria is caused by mosquitos")[0].similarity == 1.0
    assert tfidf(spark, ["Malaria is caused by mosquitos"], "Malaria") == []
    got = tfidf(spark, ["Malaria is caused by mosquitos"], "Malaria", 0.4)
    assert got[0].similarity == pytest.approx(1 / math.sqrt(5), abs=1e-6)
    assert tfidf(spark, ["Malaria", "Malaria"], "malaria")[0].uber_id == 0


def test_tfidf_needs_titles(spark):
    with pytest.raises(ValueError):
        matching.require_titles(spark.createDataFrame([(1, None)], "uber_id long, title string"), "title")


def test_bm25_minimum_share(spark):
    p = spark.createDataFrame([(1, "a b c d e f g h"), (2, "a b c d e")], "uber_id long, title string")
    r = spark.createDataFrame([(7, "a b c d e"), (8, "a b c x y"), (9, None)], "reference_id long, title string")
    got = {x.reference_id: x.uber_id for x in matching.bm25_matches(r, "reference_id", "title", p, "uber_id", "title", least=0.0).collect()}
    assert got == {7: 2}


def test_fold_keeps_order_and_repeats(spark):
    m = spark.createDataFrame([(0, "m1", "A", 1.0), (1, "m2", "B", 2.0), (2, "m1", "A", 3.0)], "seq int, match_id string, doc string, similarity double")
    got = {r.match_id: (r.similarity, r.associated_policies_count, r.policies) for r in matching.fold_citations(m, "match_id", F.col("seq"), F.col("doc"), ["similarity"]).collect()}
    assert got == {"m1": (1.0, 2, ["A", "A"]), "m2": (2.0, 1, ["B"])}


def crowd(seed, n=400):
    """Titles of two own words and of six out of thirty, and six that all hold."""
    r = random.Random(seed)
    return [(i, " ".join([f"own{i}", f"sole{i}", *r.sample([f"topic{k}" for k in range(30)], 6), *"does the programme help these people".split()])) for i in range(n)]


def counted(monkeypatch):
    """Filled with the number of pairs whenever a search compares titles."""
    met, scored = [], lookups.Titles.scored

    def count(self, pairs, score):
        met.append(pairs.count())
        return scored(self, pairs, score)

    monkeypatch.setattr(lookups.Titles, "scored", count)
    return met


def brute_bm25(asked, pubs, least, share=0.8, k1=1.2, b=0.75):
    docs = {i: Counter(t.split()) for i, t in pubs}
    avg = sum(len(t.split()) for _, t in pubs) / len(pubs)
    df = Counter(w for d in docs.values() for w in d)
    out = {}
    for q, t in asked:
        c = Counter(t.split())
        for p, d in docs.items():
            hit = sum(k for w, k in c.items() if w in d)
            s = sum(k * math.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * (k1 + 1) * d[w] / (d[w] + k1 * (1 - b + b * sum(d.values()) / avg)) for w, k in c.items() if w in d)
            if hit >= max(math.floor(share * sum(c.values())), 1) and s > least and (q not in out or (round(s, 6), -p) > (out[q][1], -out[q][0])):
                out[q] = (p, round(s, 6))
    return out


def common(seed, n, most):
    """Titles of few different words, repeats too: every word is common."""
    r = random.Random(seed)
    return [(i, " ".join(r.choices([f"w{k}" for k in range(25)], range(1, 26), k=r.randint(1, most)))) for i in range(n)]


def searched(spark, search, asked, pubs, **more):
    a, p = spark.createDataFrame(asked, "reference_id long, title string"), spark.createDataFrame(pubs, "uber_id long, title string")
    return search(a, "reference_id", "title", p, "uber_id", "title", **more).collect()


def test_bm25_common_words_make_few_candidates(spark, monkeypatch):
    met, pubs = counted(monkeypatch), crowd(1)
    asked = [(i, t.replace("does the ", "")) for i, t in pubs]
    got = searched(spark, matching.bm25_matches, asked, pubs, least=8.0)
    assert {r.reference_id: r.uber_id for r in got} == {i: i for i, _ in pubs}
    assert met and met[0] < 0.05 * len(pubs) ** 2


@pytest.mark.parametrize("least", [0.5, 4.0, 9.0])
def test_bm25_is_exact_where_every_word_is_common(spark, least):
    pubs, asked = common(2, 300, 9), common(3, 120, 9)
    want = brute_bm25(asked, pubs, least)
    got = {r.reference_id: (r.uber_id, r.score) for r in searched(spark, matching.bm25_matches, asked, pubs, least=least)}
    assert {q: p for q, (p, _) in got.items()} == {q: p for q, (p, _) in want.items()}
    assert all(got[q][1] == pytest.approx(want[q][1], abs=2e-6) for q in want) and want


def test_tfidf_common_words_make_few_candidates(spark, monkeypatch):
    met, pubs = counted(monkeypatch), crowd(1)
    asked = [(i, t.replace("does the ", "")) for i, t in pubs]
    got = searched(spark, matching.tfidf_matches, asked, pubs, least=0.6, top=10)
    assert {r.reference_id: r.uber_id for r in got if r.rank == 1} == {i: i for i, _ in pubs}
    assert met and met[0] < 0.05 * len(pubs) ** 2


@pytest.mark.parametrize("least", [0.3, 0.6, 0.85])
def test_tfidf_is_exact_where_every_word_is_common(spark, least):
    pubs, asked = common(4, 300, 9), [(i, t + " unheard" * (i % 2)) for i, t in common(5, 80, 9)]
    df = Counter(w for _, t in pubs for w in set(t.split()))

    def vector(t):
        v = {w: k * (math.log((1 + len(pubs)) / (1 + df[w])) + 1) for w, k in Counter(t.split()).items() if w in df}
        return {w: x / math.sqrt(sum(y * y for y in v.values())) for w, x in v.items()}

    docs = [(p, vector(t)) for p, t in pubs]
    want = {(q, p): s for q, t in asked for v in [vector(t)] for p, d in docs if (s := round(sum(x * d.get(w, 0) for w, x in v.items()), 6)) > least}
    got = {(r.reference_id, r.uber_id): r.similarity for r in searched(spark, matching.tfidf_matches, asked, pubs, least=least, top=1000)}
    assert got.keys() == want.keys() and want
    assert all(got[k] == pytest.approx(want[k], abs=2e-6) for k in want)
