"""Title matching: exact containment, TF-IDF cosine and BM25 with a minimum of shared words.

None compares all pairs. Containment is found through the rarest inner word of a title;
the similarity searches look up sets of words that few publications hold (``lookups``),
which is exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import clean_text, words
from ..session import cut
from . import lookups


def require_titles(pubs: DataFrame, title: str) -> None:
    """ValueError for a corpus without any title."""
    if title not in pubs.columns or pubs.where(F.col(title).isNotNull() & (F.col(title) != "")).isEmpty():
        raise ValueError("the corpus has no titles")


def exact_containment(docs: DataFrame, doc_id: str, text: str, pubs: DataFrame, pub_id: str, title: str, least: int = 40, most_words: int = 1_000_000, pubs_above: int = 100_000) -> DataFrame:
    """(doc_id, pub_id, title): cleaned titles of at least ``least`` characters that stand in
    the cleaned text, not bounded by words. Null texts and titles match nothing; equal
    titles of different publications all match; rows delivered twice count once."""
    d = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("d"), clean_text(F.col(text)).alias("t")).where("t IS NOT NULL")
    p = pubs.select(F.col(pub_id).alias("p"), clean_text(F.col(title)).alias("c")).where((F.char_length("c") >= least) & (F.col("c") != "")).distinct()
    # The first and last word may be parts of words in the text; those between are whole.
    inner = F.filter(F.split("c", " "), lambda x: x != "")
    p = p.withColumn("w", F.when(F.size(inner) > 2, F.array_distinct(F.slice(inner, 2, F.size(inner) - 2))).otherwise(F.array()))
    each = p.select("p", "c", F.explode("w").alias("w"))
    freq = each.groupBy("w").agg(F.count("*").alias("n"))
    anchors = each.join(freq, "w").groupBy("p", "c").agg(F.min_by("w", F.struct("n", -F.length("w"), "w")).alias("w"))
    # Only ids meet by word; a text moves once per candidate, not once per word.
    tokens = d.select("d", F.explode(F.array_distinct(F.split("t", " "))).alias("w")).where("w <> ''")
    if pubs_above < pubs.count():
        # Too many anchors for Spark to send whole: words that no title is anchored to need not
        # move. At most a million distinct anchor words, checked, go to every task; beyond that
        # the join itself drops the others after the exchange.
        anchors = cut(anchors)
        asked = anchors.select("w").distinct()
        if asked.count() <= most_words:
            tokens = tokens.join(F.broadcast(asked), "w", "left_semi")
    found = tokens.join(anchors, "w").select("d", "p", "c").distinct().join(d, "d").where(F.col("t").contains(F.col("c"))).select("d", "p", "c")
    # Titles of one or two words are looked up by their first characters at every place.
    short = p.where(F.size("w") == 0).select("p", "c", F.substring("c", 1, least).alias("w"))
    if not short.isEmpty():
        places = F.filter(F.transform(F.sequence(F.lit(1), F.greatest(F.char_length("t") - least + 1, F.lit(1))), lambda i: F.substring(F.col("t"), i, F.lit(least))), lambda x: F.char_length(x) == least)
        found = found.union(d.select("d", "t", F.explode(F.array_distinct(places)).alias("w")).join(short, "w").where(F.col("t").contains(F.col("c"))).select("d", "p", "c"))
    return found.distinct().select(F.col("d").alias(doc_id), F.col("p").alias(pub_id), F.col("c").alias("matched_title"))


def _asked(refs: DataFrame, ref_id: str, toks: Column) -> tuple[DataFrame, DataFrame]:
    """(q, id): the title of every reference by a digest of its words; (id, s): these titles once
    each. Of several titles of a reference the greatest counts: a blank is less than any
    character of a word, so texts are in the order of their lists of words."""
    q = refs.select(F.col(ref_id).alias("q"), F.array_join(toks, " ").alias("s")).groupBy("q").agg(F.max("s").alias("s")).where("s <> ''")
    q = cut(q.select("q", F.xxhash64("s").alias("id"), "s"))
    return q.select("q", "id"), q.groupBy("id").agg(F.max("s").alias("s"))


def _published(pubs: DataFrame, pub_id: str, toks: Column) -> DataFrame:
    return cut(pubs.select(F.col(pub_id).alias("id"), F.array_join(toks, " ").alias("s")).groupBy("id").agg(F.max("s").alias("s")))


def _held(p: DataFrame) -> DataFrame:
    """(id, t, dl, tf): how often a title of dl words holds a word."""
    w = F.split("s", " ")
    return p.where("s <> ''").select("id", F.size(w).alias("dl"), F.explode(w).alias("t")).groupBy("id", "t", "dl").agg(F.count("*").alias("tf"))


def tfidf_matches(refs: DataFrame, ref_id: str, ref_title: str, pubs: DataFrame, pub_id: str, title: str, least: float = 0.8, top: int = 1, min_chars: int = 0) -> DataFrame:
    """(ref_id, pub_id, similarity): the ``top`` publications of each reference by cosine above
    ``least`` (strictly), ties by publication id.

    Words of two or more characters; weight tf * (ln((1 + N) / (1 + df)) + 1); words outside the
    corpus are dropped before normalising, so a title may match a part of it fully.
    ValueError for a corpus without titles.
    """
    require_titles(pubs, title)
    p = _published(pubs.where(F.col(title).isNotNull() & (F.col(title) != "")), pub_id, words(F.col(title)))
    ids, q = _asked(refs.where(F.col(ref_title).isNotNull() & (F.char_length(ref_title) >= max(min_chars, 1))), ref_id, words(F.col(ref_title)))
    total = p.count()
    idf = lambda df: F.log((1 + F.lit(total)) / (1 + df)) + 1
    vocabulary = _held(p).groupBy("t").agg(F.count("*").alias("df")).select("t", "df", idf(F.col("df")).alias("idf"), F.lit(0.0).alias("top"))
    titles = lookups.Titles(p, q, vocabulary, idf, total)
    enough = max(least, 0.0) ** 2 - 1e-5

    def vector(tf: dict, rare: dict, common: dict) -> list[tuple[float, str, float]]:
        v = [(common[t][1], t) if t in common else (rare[t], t) for t in tf if t in common or t in rare]
        return [(i, t, tf[t] * i) for i, t in sorted(v, reverse=True)]

    # By Cauchy and Schwarz what two titles share must hold ``least`` squared of the squared norm
    # of each, and of the product of both.
    def lookup(tf: dict, rare: dict, common: dict) -> tuple:
        v = vector(tf, rare, common)
        whole = sum(w * w for _, _, w in v) or 1.0
        return [(*common[t][::2], w * w, 0) for _, t, w in v if t in common], enough * whole, 0, whole

    def cosine(tf: dict, rare: dict, tf2: dict, rare2: dict, common: dict) -> float | None:
        a, b = vector(tf, rare, common), vector(tf2, rare2, common)
        na, nb = (math.sqrt(sum(w * w for _, _, w in x)) for x in (a, b))
        other = {t: w / nb for _, t, w in b}
        dot = sum(w / na * other[t] for _, t, w in a if t in other)
        return dot if dot > least - 1e-5 else None

    pairs = titles.pairs(lookup, lookup, lambda x, y: x * y >= enough - 1e-5)
    scored = titles.scored(pairs, cosine).select("q", "p", F.round("score", 6).alias("similarity")).where(F.col("similarity") > least)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("similarity"), "p"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= top).withColumnRenamed("q", "id")
    return ids.join(best, "id").select(F.col("q").alias(ref_id), F.col("p").alias(pub_id), "similarity", "rank")


def bm25_matches(refs: DataFrame, ref_id: str, ref_title: str, pubs: DataFrame, pub_id: str, title: str, share: float = 0.8, least: float = 50.0, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """(ref_id, pub_id, score): best publication by BM25 above ``least`` (strictly) among those
    with at least floor(share * n) of the title's n words, repeats counted; ties by id.
    ValueError for a corpus without titles."""
    require_titles(pubs, title)
    tok = lambda c: words(c, r"[\p{L}\p{N}_]+")
    p = _published(pubs.where(F.col(title).isNotNull()), pub_id, tok(F.col(title))).where("s <> ''")
    ids, q = _asked(refs.where(F.col(ref_title).isNotNull()), ref_id, tok(F.col(ref_title)))
    total, avgdl = p.agg(F.count("*"), F.avg(F.size(F.split("s", " ")))).first()
    idf = lambda df: F.log(1 + (F.lit(total) - df + 0.5) / (df + 0.5))
    avgdl = avgdl or 1.0
    most = F.max(F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / avgdl))).alias("top")
    vocabulary = _held(p).groupBy("t").agg(F.count("*").alias("df"), most).select("t", "df", idf(F.col("df")).alias("idf"), "top")
    titles = lookups.Titles(p, q, vocabulary, idf, total or 1)
    times = _repeated(q, titles.held)
    goal = least - 1e-5

    def need(tf: dict) -> int:
        n = sum(tf.values())
        return max(math.floor(share * n), 1)

    def weight(i: float, tf: int, dl: int) -> float:
        return i * (k1 + 1) * tf / (tf + k1 * (1 - b + b * dl / avgdl))

    # The score that a title's common words can add: each at most as much as in any publication.
    # A match shares ``need`` of n words; looked up by common words it shares no rare one.
    def of_asked(tf: dict, rare: dict, common: dict) -> tuple:
        v = [(*common[t][::2], k * common[t][1] * common[t][3], k) for t, k in tf.items() if t in common]
        return v, goal, sum(x[3] for x in v) - need(tf), 1.0

    # A publication's words score what they score, as often as any title repeats them.
    def of_pub(tf: dict, rare: dict, common: dict) -> tuple:
        dl = sum(tf.values())
        return [(*common[t][::2], times.value.get(t, 1) * weight(common[t][1], k, dl), 0) for t, k in tf.items() if t in common], goal, 0, 1.0

    def score(tf: dict, rare: dict, tf2: dict, rare2: dict, common: dict) -> float | None:
        both = sorted(((common[t][1] if t in common else rare[t]), t) for t in tf if t in tf2)[::-1]
        if sum(tf[t] for _, t in both) < need(tf):
            return None
        dl = sum(tf2.values())
        got = sum(tf[t] * weight(i, tf2[t], dl) for i, t in both)
        return got if got > goal else None

    pairs = titles.pairs(of_pub, of_asked, lambda x, y: F.lit(True))
    scored = titles.scored(pairs, score).select("q", "p", F.round("score", 6).alias("score")).where(F.col("score") > least)
    best = scored.groupBy(F.col("q").alias("id")).agg(F.max_by(F.struct("p", "score"), F.struct("score", -F.col("p"))).alias("x"))
    return ids.join(best, "id").select(F.col("q").alias(ref_id), F.col("x.p").alias(pub_id), F.col("x.score").alias("score"))


def _repeated(asked: DataFrame, held: Broadcast) -> Broadcast:
    """{common word: most times that a title holds it}, of words held more than once."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common, most = held.value, {}
        for f in frames:
            for s in f["s"]:
                ws = s.split(" ")
                if len(set(ws)) < len(ws):
                    for t, k in Counter(ws).items():
                        if k > 1 and t in common:
                            most[t] = max(k, most.get(t, 1))
        yield pd.DataFrame({"t": list(most), "k": list(most.values())}).astype({"t": object, "k": "int64"})

    rows = asked.select("s").mapInPandas(run, "t string, k long").groupBy("t").agg(F.max("k").alias("k")).collect()
    return asked.sparkSession.sparkContext.broadcast({r.t: r.k for r in rows})


def fold_citations(matches: DataFrame, pub_id: str, seq: Column, policy: Column, scalars: list[str]) -> DataFrame:
    """One row per publication: scalars of its first match in ``seq`` order, the number of
    matches, and their policies in order, repeats kept."""
    s = matches.select(pub_id, seq.alias("_s"), policy.alias("_p"), F.struct(*scalars).alias("_x"))
    g = s.groupBy(pub_id).agg(F.min_by("_x", "_s").alias("_x"), F.count("*").alias("associated_policies_count"), F.transform(F.array_sort(F.collect_list(F.struct("_s", "_p"))), lambda e: e["_p"]).alias("policies"))
    return g.select(pub_id, *[F.col(f"_x.{c}").alias(c) for c in scalars], "associated_policies_count", "policies")
