"""Near-duplicates, look-alikes and names against brute force, with awkward rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from citeloom.llm import graph, linkage, lookalike, names, neardup


def shingle_sets(texts, n=3):
    out = []
    for t in texts:
        w = re.findall(r"[^\W_]+", (t or "").lower())
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    return out


def brute(texts, least):
    s = shingle_sets(texts)
    return {(i, j) for i in range(len(s)) for j in range(i + 1, len(s)) if s[i] and s[j] and len(s[i] & s[j]) / len(s[i] | s[j]) >= least}


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [[word() for _ in range(60)] for _ in range(20)]
    out = []
    for b in base:
        out.append(" ".join(b))
        for edits in (1, 3, 12):
            c = list(b)
            for _ in range(edits):
                c[rng.randrange(len(c))] = word()
            out.append(" ".join(c).upper() if edits == 1 else ", ".join(c))
    hot = [word() for _ in range(50)]  # a third of the rows are copies of one text or near them
    out += [" ".join(hot)] * 20 + [" ".join(hot[:-1] + [word()]) for _ in range(20)]
    return out + [None, "", "one two", "  ", "é " * 30000]


def pairs_of(spark, texts, block=2000):
    df = spark.createDataFrame([(i, t, "x", 1.0) for i, t in enumerate(texts)] + [(0, texts[0], "again", 2.0)], "id long, text string, node string, keys double")
    links, members = neardup.near_duplicates(df, "id", "text", neardup.word_shingles, 0.5, rows=3, bands=32, block=block)
    return links, members


def test_pairs_equal_brute_force(spark, texts):
    links, members = pairs_of(spark, texts)
    got = {(r.id_a, r.id_b) for r in neardup.record_pairs(links, members).where("id_a <> id_b").distinct().collect()}
    want = brute(texts, 0.5)
    assert got <= want and len(got) >= 0.99 * len(want)


def test_small_blocks_lose_nothing(spark, texts):
    a = {(r.id_a, r.id_b) for r in neardup.record_pairs(*pairs_of(spark, texts)).distinct().collect()}
    b = {(r.id_a, r.id_b) for r in neardup.record_pairs(*pairs_of(spark, texts, block=5)).distinct().collect()}
    assert a == b


def test_insertion_into_a_text_with_many_copies(spark):
    """A longer copy of a text that has many copies shares only shingles that are common."""
    text = " ".join(f"w{i}" for i in range(60))
    longer = text + " " + " ".join(f"new{i}" for i in range(42))
    links, members = pairs_of(spark, [text] * 40 + [longer] + [f"other{i} text{i} number{i} {i}" for i in range(60)])
    got = {(r.id_a, r.id_b) for r in neardup.record_pairs(links, members).where("id_a <> id_b").distinct().collect()}
    assert {(i, 40) for i in range(40)} <= got


def test_pairs_that_share_little_but_a_house_phrase(spark):
    """A phrase of 83 words stands in every text; 40 pairs of them have 0.6 or more through it."""
    house = " ".join(f"house{i}" for i in range(83))
    texts = []
    for p in range(40):
        own = " ".join(f"own{p}x{i}" for i in range(16))
        texts += [f"{own} {house}", f"{own} {house} " + " ".join(f"more{p}x{i}" for i in range(60))]
    texts += [f"{house} " + " ".join(f"only{k}x{i}" for i in range(300)) for k in range(120)]
    want = {(2 * p, 2 * p + 1) for p in range(40)}
    assert want <= brute(texts, 0.6)
    links, members = pairs_of(spark, texts)
    got = {(r.id_a, r.id_b) for r in neardup.record_pairs(links, members).where("id_a <> id_b").distinct().collect()}
    everything = brute(texts, 0.5)
    assert got <= everything and len(got) >= 0.98 * len(everything) and len(want & got) >= 0.95 * len(want)


def test_groups(spark, texts):
    g = {r.id: (r.class_id, r.links) for r in neardup.groups(*pairs_of(spark, texts)).collect()}
    assert g[0][0] == 0 and g[1][0] == 0
    hot = len(texts) - 45
    assert {g[i][0] for i in range(hot, hot + 40)} == {hot}
    assert 122 not in g  # no shingle, no class


def test_titles_and_groups_cover_both_tables(spark, tmp_path):
    from citeloom.llm import queries

    at = "timestamp'2020-01-01'"
    arts = spark.createDataFrame([(1, "fine effects of clean water"), (2, "fine effects of clean waters"), (2, "fine effects of clean waters"), (3, None)], "article_id long, title string")
    refs = spark.createDataFrame([(1, "\ufb01ne effects of clean water"), (5, "fine effects of clean water"), (6, None)], "reference_id long, title string")
    arts.selectExpr("*", f"{at} AS loaded_at").write.parquet(f"{tmp_path}/articles.parquet")
    refs.selectExpr("*", f"{at} AS loaded_at").write.parquet(f"{tmp_path}/structured_refs.parquet")
    spark.createDataFrame([(1, "a b c d e f g"), (4, "a b c d e f g"), (9, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    titles = {(r.table_name, r.record_id): r.consistent_title for r in queries.p3_titles(spark, str(tmp_path)).collect()}
    assert set(titles) == {("articles", i) for i in (1, 2, 3)} | {("structured_refs", i) for i in (1, 5, 6)}
    assert titles["structured_refs", 1] == titles["structured_refs", 5] == titles["articles", 1]
    groups = {(r.table_name, r.record_id): r.class_id for r in queries.p1_groups(spark, str(tmp_path)).collect()}
    assert groups == {("documents", 1): 1, ("documents", 4): 1, ("articles", 1): 1, ("articles", 2): 1}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "id long, text string")
    links, members = neardup.near_duplicates(df, "id", "text", neardup.word_shingles, 0.5, 3, 32)
    assert links.count() == 0 and members.count() == 0
    form = lookalike.fit((df, "text"))
    assert lookalike.same_look_pairs(df, "id", "text", form).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    got = {r.v: r.root for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {got[i] for i in range(101)} == {0} and {got[1000 + i] for i in range(200)} == {1000} and len(got) == 301


LOOKS = ["fine effect", "ﬁne effect", "fine effect", "fi​ne effect", "finе effect", "ｆｉｎｅ effect", "Fine effect", "finé effect", "finé effect", "fine effect.", "fine effect", None, "", " "]


def test_same_look(spark):
    df = spark.createDataFrame(list(enumerate(LOOKS)), "id long, title string")
    form = lookalike.fit((df, "title"))
    got = {(r.id_a, r.id_b) for r in lookalike.same_look_pairs(df, "id", "title", form).collect()}
    same = [0, 1, 2, 3, 4, 5, 10]
    assert got == {(i, j) for i in same for j in same if i < j and LOOKS[i] != LOOKS[j]} | {(7, 8)}
    again = df.select(form.column(form.column(F.col("title"))).alias("b"), form.column(F.col("title")).alias("a")).collect()
    assert all(r.a == r.b for r in again)  # a fixed point


def test_frequency_chooses_the_representative():
    assert lookalike.rewrite_rules({"a": 1, "а": 9})["a"] == "а"
    assert lookalike.rewrite_rules({"a": 9, "а": 1})["а"] == "a"
    mixed = lookalike.rewrite_rules({"E": 90, "Ε": 3, "Έ": 3, "É": 1})  # accented letters follow their bare letter
    assert mixed["Έ"] == "É" and mixed["Ε"] == "E"


def test_radius_join_is_exact(spark):
    rng = random.Random(1)
    base = ["".join(rng.choice("aeioulmnrst") for _ in range(rng.randrange(3, 11))) for _ in range(60)]
    pool = set(base)
    for b in base:
        c = list(b)
        c[rng.randrange(len(c))] = rng.choice("xyz")
        pool |= {"".join(c), b[1:], b + "q", b[:2] + b[3:4] + b[2:3] + b[4:]}
    pool = sorted(x for x in pool if x)
    df = spark.createDataFrame([(f"p:{x}", i + 1) for i, x in enumerate(pool)], "name string, n long")
    got = {(r.a[2:], r.b[2:]) for r in names.radius_pairs(df).collect()}
    want = {(a, b) for a in pool for b in pool if a < b and names.edits(a, b, 2) <= names.radius(min(len(a), len(b)))}
    assert got == want


PEOPLE = [
    (1, "Stodrulell", "L", None, "Care Office, Prurttin"), (2, None, None, "Leila Stodrulell", "Prurttin"), (3, None, None, "STODRULELL, L.", None), (4, "L.", "Stodrulell", None, "Prurttin"), (5, "Stodrulel", "L.A.", None, "Prurttin"),
    (6, "Stodrulell", "B", None, "Elsewhen"), (7, None, None, "Bob Trautmanner", None), (8, None, None, "Trautmanner, Robert", None),
    (9, None, None, "MoH Findkeilford", None), (10, None, None, "The Ministry of Health of Findkeilford", "x"), (11, None, None, "MHW Findkeilford", None), (12, None, None, "Findkeilford Min. of Health & Welfare", None),
    (13, None, None, None, None), (14, "", " ", "", ""), (1, "Stodrulell", "L", None, "Care Office, Prurttin"), (15, None, None, "é" * 3000, None),
]


def test_people_and_bodies(spark):
    df = spark.createDataFrame(PEOPLE, "contributor_id long, lastname string, initials string, authors string, affiliation string")
    e = {r.id: r.entity for r in names.entities(df, at=None).collect()}
    assert len({e[i] for i in (1, 2, 3, 4, 5)}) == 1 and e[6] != e[1]
    assert e[7] == e[8] and e[9] == e[10] and e[11] == e[12] and e[9] != e[11]
    assert 13 not in e and 14 not in e
    assert names.same_entity_pairs(names.entities(df.limit(0), at=None)).count() == 0


def test_records_look_up_the_same_keys_however_many_are_common(spark):
    r = random.Random(5)
    few, own = ["north", "river", "health", "cost", "of", "care"], [f"own{chr(97 + i)}" for i in range(20)]
    titles = [" ".join(r.sample(few, 4) + r.sample(own, i % 3)) for i in range(90)]
    pubs = spark.createDataFrame([(i, t, [], 2000, None, None, None, i) for i, t in enumerate(titles)], "uber_id long, title string, authors array<struct<lastname:string>>, pub_year int, journal_title string, journal_volume string, page_info string, modified long")
    rows = [(i // 2 if i < 4 else i, t, "Smith J" if i % 5 else None, "2000", None, None, "7-9" if i % 4 == 0 else None) for i, t in enumerate([*titles, None, "", "north", "north north river"])]
    records = spark.createDataFrame(rows, "id long, title string, authors string, year string, journal string, vol string, page string")
    form = lookalike.fit((pubs, "title"))
    sent, joined = (linkage.Publications(pubs, form, most=15, most_runs=4, held=h) for h in (2_000_000, 0))
    assert len(sent.common) and joined.joined is not None
    a = linkage.shape(records, False, sent.common, form.rules).collect()
    b = linkage.shape_by_join(records, joined.joined, form.rules).collect()
    plainly = lambda x: sorted(repr({k: sorted(v) if k == "keys" else v for k, v in row.asDict().items()}) for row in x)
    assert plainly(a) == plainly(b)
    assert sorted(sent.match(records).collect()) == sorted(joined.match(records).collect())
