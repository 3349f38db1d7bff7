"""Scans, site lines, packing, mixing, subjects and linkage on small inputs."""

import random


import pytest
from pyspark.sql import functions as F

from citeloom.llm import linkage, lookalike, mixing, packing, scans, sitelines, subjects, tokens

VOCAB = scans.Vocabulary({w: 100 for w in "community modern modem diesel increased returned antibody long-term long term families report improve the of in people".split()} | {"outbreak": 50})
SCAN = "Report on diesel | 12\n\nThe cornmunity increa5ed the use of diese| in the out-\nbreak and of modern means in the long-\nterm report of the modem people in town\nRep0rt 0n diesel | 13\nThe farnilics returried it.\n- 14 -"


def test_line_noise():
    got = set(scans.line_noise(SCAN, VOCAB))
    assert {(1, "furniture"), (6, "furniture"), (8, "furniture"), (3, "hyphen"), (3, "ocr"), (7, "ocr")} == got
    assert scans.line_noise("One line that is long but never wrapped.", VOCAB) == []


def test_repair_reflows(spark):
    df = spark.createDataFrame([(1, SCAN), (1, SCAN), (2, "One line."), (3, None), (4, "")], "doc_id long, text string")
    got = {r.record_id: (r.text, r.scanned) for r in scans.repair(df, "doc_id", "text", VOCAB).collect()}
    assert got[2] == ("One line.", False) and got[3] == (None, False) and got[4] == ("", False)
    fixed = got[1][0]
    assert "community increased the use of diesel in the outbreak" in fixed and "long-term report" in fixed and "12" not in fixed and "14" not in fixed


def test_scan_frames(spark):
    df = spark.createDataFrame([(1, SCAN), (2, None), (3, ""), (4, "x" * 200_000), (None, SCAN)], "doc_id long, text string")
    v = scans.vocabulary([(df, "text")])
    assert {r.record_id for r in scans.noise_lines(df, "doc_id", "text", v).collect()} <= {1}
    assert {r.record_id: r.scanned for r in scans.repair(df.where("doc_id > 1"), "doc_id", "text", v).collect()} == {2: False, 3: False, 4: False}
    assert scans.noise_lines(df.limit(0), "doc_id", "text", v).count() == 0


def test_scan_counts_do_not_depend_on_size(spark):
    """A word counted a few times keeps its count among six million others."""
    fill = spark.range(30).select(F.col("id").cast("long").alias("doc_id"), F.repeat(F.lit("of "), 200_000).alias("text"))
    text = "The first line of the page is about the archive\nand the second line names the rnunicipality of it\nwhile the third line closes the paragraph here."
    rows = spark.createDataFrame([(100, text), (101, "municipality " * 5)], "doc_id long, text string")
    v = scans.vocabulary([(fill.unionByName(rows), "text")])
    got = scans.noise_lines(rows, "doc_id", "text", v).where("noise_kind = 'ocr'").collect()
    assert [(r.record_id, r.line_no) for r in got] == [(100, 2)]


def test_repaired_covers_documents_and_sections(spark, tmp_path):
    from citeloom.llm import queries

    spark.createDataFrame([(1, SCAN), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, SCAN), (7, SCAN)], "section_id long, sections string").write.parquet(f"{tmp_path}/pdf_sections.parquet")
    got = {(r.table_name, r.record_id): r.scanned for r in queries.p5_repaired(spark, str(tmp_path)).collect()}
    assert got == {("documents", 1): True, ("documents", 2): False, ("pdf_sections", 1): True, ("pdf_sections", 7): True}


def brute_lines(rows, least=0.05, docs=4):
    import re

    key = lambda x: re.sub(r"\s+", " ", re.sub(r"\d+", "0", x.strip().lower()))
    lines = [(d, s, i, key(x)) for d, t, s in rows if t and s for i, x in enumerate(t.split("\n"), 1) if len(x.strip()) >= 20]
    n, seen = {}, {}
    for _, _, s in rows:
        n[s] = n.get(s, 0) + 1
    for d, s, _, k in lines:
        seen.setdefault((s, k), set()).add(d)
    return {(d, i) for d, s, i, k in lines if len(seen[(s, k)]) >= docs and len(seen[(s, k)]) >= least * n[s]}


def test_site_lines_equal_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for d in range(120):
        site = "big" if d % 3 else "small"
        body = [" ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(6)) for _ in range(3)]
        foot = f"COPYRIGHT  {rng.randrange(999)} by the {site} office" if d % 4 else f"Copyright {d} by the {site} Office"
        rows.append((d, "\n".join([body[0], foot, *body[1:], foot, "short"]), site))
    rows += [(500, None, "big"), (501, "", "big"), (502, "No source here at all, a line", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    s = sitelines.SiteLines(df, "doc_id", "text", "source")
    assert {(r.doc_id, r.line_no) for r in s.repeated().collect()} == brute_lines(rows)
    clean = {r.doc_id: r for r in s.cleaned().collect()}
    assert len(clean) == len(rows) and clean[1].lines_removed == 2 and "opyright" not in clean[1].text.lower() and clean[500].text is None
    assert sitelines.SiteLines(df.limit(0), "doc_id", "text", "source").repeated().count() == 0


def test_differencing_balances():
    where, sums = packing.differencing([8, 7, 6, 5, 4], 2)
    assert sorted(sums) == [14, 16] and len(where) == 5
    rng = random.Random(3)
    for _ in range(30):
        sizes = sorted((rng.randrange(0, 101) for _ in range(rng.randrange(1, 60))), reverse=True)
        w = packing.fill(sizes, 100)
        load = {}
        for x, s in zip(w, sizes):
            load[x] = load.get(x, 0) + s
        assert max(load.values()) <= 100 and sum(load.values()) == sum(sizes)


def test_packing_keeps_every_token(spark):
    sized = spark.createDataFrame([(i, 10 + i * 7 % 300) for i in range(300)] + [(900, 1024), (901, 0), (902, None), (903, 2500)], "doc_id long, tokens long")
    sizes = spark.createDataFrame([(1, 512), (2, 2048), (3, None)], "pack_id int, capacity_tokens int")
    p = packing.pack(sized, sizes, window=16)
    whole = {r.pack_id: (r.t, r.d) for r in p.groupBy("pack_id").agg(F.sum("tokens").alias("t"), F.countDistinct("doc_id").alias("d")).collect()}
    total = sized.agg(F.sum("tokens")).first()[0]
    assert whole == {1: (total, 304), 2: (total, 304)}
    caps = {1: 512, 2: 2048}
    assert all(r.t <= caps[r.pack_id] for r in p.groupBy("pack_id", "container_id").agg(F.sum("tokens").alias("t")).collect())
    split = {r.doc_id for r in p.where("piece > 1").select("doc_id").distinct().collect()}
    assert split == {900, 903}
    assert packing.pack(sized.limit(0), sizes).count() == 0


def test_mixture_shares_and_repeats(spark):
    sized = spark.createDataFrame([(i, "a" if i % 3 else "b", 100 + i % 50) for i in range(3000)] + [(9000, "c", 50), (9001, "no target", 500)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.3, 1), ("b", 0.5, 3), ("c", 0.1, 2), ("void", 0.1, 4), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(sized, targets, total=200_000)
    s = {r.source: r for r in mixing.shares(m, sized, targets).collect()}
    assert s["c"].tokens == 100 and s["void"].tokens == 0
    assert s["a"].actual_share == pytest.approx(0.375, abs=0.01) and s["b"].actual_share == pytest.approx(0.625, abs=0.01)
    assert s["b"].most_uses <= 3 and s["a"].most_uses == 1
    pos = [r.position for r in m.collect()]
    assert pos == sorted(pos) and 0 <= pos[0] and pos[-1] <= 1
    # scarce sources come later: the second half holds more of them than the first
    half = {r.h: r.b / r.n for r in m.groupBy((F.col("position") > 0.5).alias("h")).agg(F.sum(F.when(F.col("source") == "b", F.col("tokens")).otherwise(0)).alias("b"), F.sum("tokens").alias("n")).collect()}
    assert half[True] > half[False]
    assert mixing.mixture(sized.limit(0), targets).count() == 0


def test_tokens_match_the_tokenizer(spark):
    df = spark.createDataFrame([(1, "Hello world's 12 cats"), (2, None), (3, "")], "doc_id long, text string")
    got = {r.doc_id: r.tokens for r in tokens.token_counts(df, "doc_id", "text").collect()}
    assert got == {1: len(tokens.encoding(tokens.RANKS).encode_ordinary("Hello world's 12 cats")), 2: 0, 3: 0}


def test_subjects_hold_out():
    rng = random.Random(5)
    words = {s: [f"{s}{i}" for i in range(30)] for s in ("law", "sport", "water")}
    frame = "the office of this town has shown that use grew in".split()

    def sentence(s):
        return " ".join(rng.sample(frame, 6) + rng.sample(words[s], 3)) + "."

    def doc(kinds):
        return " ".join(sentence(s) for s in kinds)

    train = [({s}, doc([s] * 8)) for s in words for _ in range(25)] + [({"law", "sport"}, doc(["law"] * 5 + ["sport"] * 3)) for _ in range(15)]
    train += [({"sport"}, doc(["law"] * 8))]  # a wrong label
    m = subjects.SubjectModel([t for _, t in train], [s for s, _ in train], list(words))
    test = [({s}, doc([s] * 6 + ["law" if s != "law" else "water"])) for s in words for _ in range(10)] + [({"law", "water"}, doc(["law"] * 5 + ["water"] * 3)) for _ in range(10)]
    pred, _ = m.predict([t for _, t in test])
    got = [{m.subjects[j] for j in range(3) if p[j]} for p in pred]
    assert sum(a == b for a, (b, _) in zip(got, test)) >= 0.95 * len(test)
    assert not m.predict([None, "", "... !!"])[0].any()
    assert not subjects.SubjectModel([], [], ["law"]).predict(["law law law."])[0].any()


def test_linkage(spark):
    title = "Effects of {} programmes on {} in the towns of {}land"
    pubs = [(i, title.format(f"zeta{i}", f"quor{i % 7}", f"Plim{i}"), [(f"Smoth{i}", "A"), ("Lee", None)], 2000 + i % 20, "Journal of Town Health", str(i), f"{i}-{i + 9}", None) for i in range(60)]
    pubs += [(100, pubs[5][1], [("Other", "B")], 2019, "Annals", "99", "900-910", None)]
    p = spark.createDataFrame(pubs, "uber_id long, title string, authors array<struct<lastname:string,initials:string>>, pub_year int, journal_title string, journal_volume string, page_info string, modified timestamp")
    rec = [
        (1, pubs[3][1].upper(), "Smoth3 A", "2003", None, None, None),
        (2, None, "A. Smoth4, et al", "2004", "J Town Health", "4", "4-13"),
        (3, pubs[5][1], "B Other", "2019b", None, None, None),
        (4, pubs[5][1], "Smoth5, A.", "in press", None, None, None),
        (5, "A wholly different work on other matters", "Nobody N", "1990", None, None, None),
        (6, None, None, None, None, None, None),
        (7, "", "", "", "", "", ""),
        (8, pubs[9][1].replace("programmes", "programes").replace("towns", "twons"), None, "2010", None, None, None),
    ]
    r = spark.createDataFrame(rec, "id long, title string, authors string, year string, journal string, vol string, page string")
    form = lookalike.fit((p, "title"), (r, "title"))
    ix = linkage.Publications(p, form)
    got = {x.rid: x.uber_id for x in ix.match(r).collect()}
    assert got == {1: 3, 2: 4, 3: 100, 4: 5, 8: 9}
    assert ix.match(r.limit(0)).count() == 0


@pytest.mark.parametrize("authors", [0, 2, 3])
def test_titles_of_common_words_are_found_whatever_their_authors(spark, authors):
    """All words stand in far more titles than a posting list holds; runs of them do not."""
    rng = random.Random(9)
    words = [f"common{i}" for i in range(25)]
    pubs = [(i, " ".join(rng.sample(words, 9)), [{"lastname": f"name{i}x{k}", "initials": "A"} for k in range(authors)], 1990 + i % 20, None, None, None, None) for i in range(2000)]
    p = spark.createDataFrame(pubs, "uber_id long, title string, authors array<struct<lastname:string,initials:string>>, pub_year int, journal_title string, journal_volume string, page_info string, modified timestamp")
    r = spark.createDataFrame([(i, pubs[i][1], None, str(pubs[i][3]), None, None, None) for i in range(0, 2000, 20)], "id long, title string, authors string, year string, journal string, vol string, page string")
    got = linkage.Publications(p, lookalike.fit((p, "title"))).match(r).collect()
    assert sum(x.rid == x.uber_id for x in got) >= 97


def test_words_meet_their_forms_by_skeleton():
    for read, printed in (("trcatrncnt", "treatment"), ("rnodem", "modem"), ("c0mmun1ty", "community"), ("iücreased", "iticreased"), ("hke", "like")):
        assert scans.word_skeleton(read) == scans.word_skeleton(printed)
        assert scans.misreading(read, printed) is not None
    assert scans.misreading("modern", "modem") == (1, 1, False) and scans.misreading("cat", "dog") is None and scans.misreading("same", "same") is None
    v = scans.Vocabulary({"treatment": 900, "modern": 50, "modem": 50})
    assert v.intended("Trcatrncnt", {}) == "treatment" and v.intended("modem", {}) is None and v.intended("unknown", {}) is None
