"""Problem 6: matching entities across sources without keys, by collective graph linkage.

Records and publications that share an attribute which is rare among publications (a title
word, two or four title words in a row, an author in a year, volume and page) are joined by an
edge; its weight is the rarity of what they share. A key is rare while fewer than a fixed
number of publications hold it, whatever their total; longer runs of words stand in for words
that are not. Meta-blocking keeps each record's heaviest edges. Edges are scored on all
attributes; then edges of records that look alike support one another, round by round, until
no record changes its publication.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, one_delivery
from . import textkit as K
from .lookalike import Consistent, rewriter
from .names import PARTICLES, TITLES, plain

SKIP = TITLES | PARTICLES | frozenset("et al and others".split())
SHAPE = "rid long, tkeys array<int>, akeys array<int>, year int, vol int, page int, jkey int, look long, keys array<long>"
WORD, PAIR, FOUR, AUTHOR, PLACE = (K.U64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63))
RUNS = ("words", "pairs", "fours")
# Digests of runs are odd, all others even, so a join of keys can tell them apart.
ODD, EVEN = K.U64(1), ~K.U64(1)
SHARE, BEST = 0.15, 10.4  # support counts at most so much of the greatest score
ENOUGH = 2  # rare words (or words and pairs) of a title that make longer runs needless


class Bare(dict):
    """Translation table that strips accents, filled as characters are met."""

    def __missing__(self, cp: int) -> str:
        self[cp] = got = plain(chr(cp))
        return got


BARE = Bare()


def _plain(text: str) -> str:
    return text if text.isascii() else text.translate(BARE)


@functools.lru_cache(maxsize=1 << 12)
def year_of(text: str | None) -> int | None:
    """The first four digits that can be a year; None for "in press" and the like."""
    m = re.search(r"(?:1[89]|20)\d\d", text or "")
    return int(m[0]) if m else None


@functools.lru_cache(maxsize=1 << 14)
def journal_key(text: str | None) -> str:
    """Initials of a journal's words, equal for the full name and its abbreviation."""
    return "".join(w[0] for w in re.findall(r"[^\W\d_]+", _plain(text or "").lower()) if w not in ("of", "and", "the", "for", "in"))


PAGE = re.compile(r"\s*(\w+)").match


@functools.lru_cache(maxsize=1 << 14)
def _volume(text: str | None) -> str:
    return re.sub(r"\W", "", text or "")


def hashes(texts: list[str]) -> np.ndarray:
    """64-bit hash of every text."""
    cp, starts = K.codes(texts)
    return K.span_hash(K.prefix_hash(cp), starts[:-1], starts[1:] - 1)


@functools.lru_cache(maxsize=1)
def skipped() -> np.ndarray:
    return np.sort(hashes(sorted(SKIP)))


def known(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    i = np.searchsorted(sorted_values, x)
    i[i == len(sorted_values)] = 0
    return sorted_values[i] == x


def short(h: np.ndarray) -> np.ndarray:
    """32 bits are enough where two records are compared."""
    return (h & K.U64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)


def lists(values: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    """Distinct values of each of n owners."""
    o = np.lexsort((values, owner))
    v, w = values[o], owner[o]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (w[1:] != w[:-1])
    v, w = v[first], w[first]
    return np.split(v, np.searchsorted(w, np.arange(1, n))) if n else []


def optional(values: list, hashed: bool = True) -> pd.array:
    """Int32 column of texts' short hashes (or of numbers), null where there is none."""
    empty = np.fromiter((not x for x in values), bool, len(values))
    data = short(hashes([x or "" for x in values])) if hashed else np.fromiter((x or 0 for x in values), np.int32, len(values))
    return pd.arrays.IntegerArray(np.asarray(data, np.int32), empty)


def shape(df: DataFrame, publication: bool, common: np.ndarray | None = None, rules: dict[str, str] | None = None, enough: int = ENOUGH, apart: bool = False) -> DataFrame:
    """Digests of the attributes of every record (id, title, authors, year, journal, vol, page).

    Titles are brought to the consistent form of ``rules``; their words are lower-cased
    without accents. ``common``: sorted keys that too many publications hold. Records get the
    keys to look up: title words that are not common; with fewer than ENOUGH of them also pairs
    of neighbouring words, and with fewer than ENOUGH of both also runs of four. Publications
    are asked for all. An author's key is dated; 0 stands for any year, 1 for a publication
    without one. ``apart``: all words, pairs and runs of four of a title, common or not, repeats
    kept, stand in columns of their own and not among the keys.
    """
    held = df.sparkSession.sparkContext.broadcast(common if common is not None else np.empty(0, K.U64))

    def titles(col: pd.Series, frequent: np.ndarray) -> tuple:
        texts = col.tolist()
        n = len(texts)
        cp, starts = K.codes(texts)
        s, _, h, _ = K.words(cp)
        doc = np.searchsorted(starts, s, "right") - 1
        keys, owners = [], []
        word = K.mix(h * WORD) & EVEN
        rare_words = ~known(frequent, word)
        have = np.bincount(doc[rare_words], minlength=n)
        use = np.ones(len(h), bool) if publication or apart else rare_words
        keys.append(word[use])
        owners.append(doc[use])
        for run, salt in ((2, PAIR), (4, FOUR)):
            if len(h) < run:
                keys.append(np.empty(0, K.U64))
                owners.append(np.empty(0, np.int64))
                continue
            v = h[: len(h) - run + 1] * salt
            for j in range(1, run):
                v = K.mix(v + h[j : len(h) - run + 1 + j])
            v |= ODD
            d = doc[: len(v)]
            ok = d == doc[run - 1 :]
            if not publication and not apart:
                ok &= (have[d] < enough) & ~known(frequent, v)
                have = have + np.bincount(d[ok], minlength=n)
            keys.append(v[ok])
            owners.append(d[ok])
        look = np.zeros(n, K.U64)
        if len(h):
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            place = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
            look[doc[first]] = np.add.reduceat(K.mix(h + place.astype(K.U64) * WORD), first)
        return lists(short(h), doc, n), keys, owners, look, np.bincount(doc, minlength=n) == 0

    def people(col: pd.Series, years: np.ndarray) -> tuple:
        texts = col.tolist()
        cp, starts = K.codes(texts)
        kind, low = K.tables()
        s, e = K.runs((kind[cp] & K.LETTER) != 0)
        h = K.span_hash(K.prefix_hash(low[cp]), s, e)
        doc = np.searchsorted(starts, s, "right") - 1
        ok = (e - s >= 3) & ~known(skipped(), h)
        h, doc = h[ok], doc[ok]
        y = years[doc]
        dates = [y - 1, y, y + 1, np.zeros_like(y)] if publication else [y, np.ones_like(y)]
        keys, owners = [], []
        for k, date in enumerate(dates):
            # without a year: a publication stands under 1 and 0, a record looks under 0
            date = np.where(y == 0, {0: 1, 1: 0}.get(k, -1) if publication else {0: 0}.get(k, -1), date)
            use = date >= 0
            keys.append(K.mix(h[use] * AUTHOR + date[use].astype(K.U64)) & EVEN)
            owners.append(doc[use])
        return lists(short(h), doc, len(texts)), keys, owners

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        frequent = held.value
        rewrite, plain_rules = rewriter(rules or {}), all(not k.isascii() for k in rules or {})

        def consistent(t: str | None) -> str:
            return t if t and plain_rules and t.isascii() else _plain(rewrite(t)) if t else ""

        for f in frames:
            n = len(f)
            year = [year_of(y) for y in f["year"]]
            years = np.fromiter((y or 0 for y in year), np.int64, n)
            tkeys, keys, owners, look, empty = titles(f["title"].map(consistent), frequent)
            runs = {}
            if apart:
                for c, k, o in zip(RUNS, keys, owners):
                    first = np.argsort(o, kind="stable")
                    runs[c] = np.split(k[first].view(np.int64), np.searchsorted(o[first], np.arange(1, n)))
                keys, owners = [], []
            akeys, more, theirs = people(f["authors"].map(lambda t: _plain(t) if t else ""), years)
            vol = [_volume(v) for v in f["vol"]]
            page = [m[1] if m else "" for m in (PAGE(x or "") for x in f["page"])]
            paged = np.flatnonzero(np.fromiter((bool(x) for x in page), bool, n))
            places = [f"{vol[i]}|{page[i]}" for i in paged]
            keys, owners = [*keys, *more, K.mix(hashes(places) * PLACE) & EVEN], [*owners, *theirs, paged]
            if publication:
                both = paged[np.fromiter((bool(vol[i]) for i in paged), bool, len(paged))]
                keys.append(K.mix(hashes([f"|{page[i]}" for i in both]) * PLACE) & EVEN)
                owners.append(both)
            all_keys = lists(np.concatenate(keys).view(np.int64), np.concatenate(owners), n)
            yield pd.DataFrame({
                "rid": f["id"].to_numpy(), "tkeys": tkeys, "akeys": akeys, "year": optional(year, False), "vol": optional(vol), "page": optional(page),
                "jkey": optional([journal_key(j) for j in f["journal"]]), "look": pd.arrays.IntegerArray(look.view(np.int64), empty), "keys": all_keys, **runs,
            })

    return df.mapInPandas(run, SHAPE + "".join(f", {c} array<long>" for c in RUNS if apart))


def shape_by_join(df: DataFrame, common: DataFrame, rules: dict[str, str], enough: int = ENOUGH) -> DataFrame:
    """What shape() makes of records, for common keys (a table: key) too many to send to tasks."""
    # Records delivered twice share their id, so every row has a number.
    rows = cut(shape(df, False, None, rules, apart=True).withColumn("row", F.monotonically_increasing_id()))
    kind = lambda i: lambda k: F.struct(F.lit(i).alias("kind"), k.alias("key"))
    kinds = F.concat(*[F.transform(c, kind(i)) for i, c in enumerate(RUNS)])
    rare = rows.select("row", F.explode(kinds).alias("x")).select("row", "x.*").join(common, "key", "left_anti")
    of = lambda i: F.collect_set(F.when(F.col("kind") == i, F.col("key")))
    rare = rare.groupBy("row").agg(*[of(i).alias(f"_{c}") for i, c in enumerate(RUNS)], *[F.count_if(F.col("kind") == i).alias(f"n_{c}") for i, c in enumerate(RUNS[:2])])
    x = rows.drop(*RUNS).join(rare, "row", "left")
    none = F.array().cast("array<long>")
    words = F.coalesce("n_words", F.lit(0))
    both = words + F.when(words < enough, F.coalesce("n_pairs", F.lit(0))).otherwise(0)
    keys = F.array_distinct(F.concat("keys", F.coalesce("_words", none), F.coalesce(F.when(words < enough, F.col("_pairs")), none), F.coalesce(F.when(both < enough, F.col("_fours")), none)))
    return x.withColumn("keys", keys).select(*[c.split()[0] for c in SHAPE.split(", ")])


def publication_shape(pubs: DataFrame, form: Consistent) -> DataFrame:
    p = one_delivery(pubs.select("uber_id", "title", "authors", "pub_year", "journal_title", "journal_volume", "page_info", "modified"), "uber_id", "modified")
    last = F.array_join(F.transform(F.coalesce("authors", F.array()), lambda x: F.coalesce(x["lastname"], F.lit(""))), " ; ")
    return shape(p.select(F.col("uber_id").alias("id"), "title", last.alias("authors"), F.col("pub_year").cast("string").alias("year"), F.col("journal_title").alias("journal"), F.col("journal_volume").alias("vol"), F.col("page_info").alias("page")), True, rules=form.rules)


class Publications:
    """The publication side, built once: digests, postings of the rare keys, the common keys.

    A key is rare if fewer than ``most`` publications hold it, a run of words if fewer than
    ``most_runs``, at every size of the table, so no posting list grows with it. Up to ``held`` common keys are sent to the tasks that shape
    records, which then leave them out; beyond that a join does the same, with equal results.
    """

    def __init__(self, pubs: DataFrame, form: Consistent, most: int = 40, most_runs: int = 10, held: int = 2_000_000) -> None:
        self.form = form
        both = cut(publication_shape(pubs, form))
        self.shape = both.drop("keys")
        total = both.count()
        each = both.select(F.col("rid").alias("uber_id"), F.explode("keys").alias("key"))
        df = cut(each.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"))
        bound = F.when(F.col("key") % 2 == 0, most).otherwise(most_runs)
        common = df.where(F.col("df") >= bound).select("key")
        self.joined = common if common.count() > held else None
        rows = common.toLocalIterator() if self.joined is None else ()
        self.common = np.sort(np.fromiter((r.key for r in rows), np.int64).view(K.U64))
        posts = each.join(df, "key", "left").where(F.coalesce("df", F.lit(1)) < bound)
        self.posts = cut(posts.select("key", "uber_id", F.log1p(total / F.coalesce("df", F.lit(1))).cast("float").alias("w")))

    def match(self, records: DataFrame, keep: int = 3, accept: float = 0.5, rounds: int = 30) -> DataFrame:
        """(rid, uber_id, confidence): at most one publication for every record of
        (id, title, authors, year, journal, vol, page); all texts, null where unknown.

        Records without title, authors and pages match nothing. Ties go to the smaller id. A
        record delivered twice may stand twice: its edges add up, its best one is kept. Raises
        if records still change their publication after ``rounds``.
        """
        recs = cut(shape(records, False, self.common, self.form.rules) if self.joined is None else shape_by_join(records, self.joined, self.form.rules))
        edges = recs.select("rid", F.explode("keys").alias("key")).join(self.posts, "key").groupBy("rid", "uber_id").agg(F.sum("w").alias("w"))
        # Meta-blocking: a record's heaviest edges (and ties of the last kept) that weigh at
        # least half as much as its heaviest.
        heavy = Window.partitionBy("rid").orderBy(F.desc("w"))
        best = edges.withColumn("r", F.rank().over(heavy)).where(F.col("r") <= keep).withColumn("top", F.max("w").over(Window.partitionBy("rid"))).where("w >= top / 2").select("rid", "uber_id")
        p = self.shape.select(F.col("rid").alias("uber_id"), F.col("tkeys").alias("pt"), F.col("akeys").alias("pa"), F.col("year").alias("py"), F.col("vol").alias("pv"), F.col("page").alias("pp"), F.col("jkey").alias("pj"))
        e = best.join(recs.drop("keys"), "rid").join(p, "uber_id")
        # Set comparisons once per edge, not once in every branch that uses them.
        e = e.withColumn("both", F.size(F.array_intersect("tkeys", "pt"))).withColumn("meet", F.size(F.array_intersect("akeys", "pa")))
        both, meet = F.col("both"), F.col("meet")
        short, long_ = F.least(F.size("tkeys"), F.size("pt")), F.greatest(F.size("tkeys"), F.size("pt"))
        title = F.when((F.size("tkeys") == 0) | (F.size("pt") == 0), None).otherwise(0.6 * both / short + 0.4 * both / long_)
        author = F.when((F.size("akeys") == 0) | (F.size("pa") == 0), 0.0).when(meet == 0, -1.0).otherwise(F.least(F.lit(1.0), 0.5 + meet / F.size("pa") / 2))
        gap = F.abs(F.col("year") - F.col("py"))
        year = F.when(gap.isNull(), 0.0).when(gap == 0, 1.0).when(gap == 1, 0.2).otherwise(-1.0)

        def same(a: str, b: str, no: float):
            return F.when(F.col(a).isNull() | F.col(b).isNull(), 0.0).when(F.col(a) == F.col(b), 1.0).otherwise(no)

        z = (
            F.when(title.isNull(), F.lit(-3.6)).otherwise(14 * (title - 0.72))
            + 1.6 * author + 1.2 * year + 1.1 * same("vol", "pv", -1.0) + 2.0 * same("page", "pp", -1.0) + 0.5 * same("jkey", "pj", -1.0)
        )
        # Support adds at most SHARE times the greatest score, so edges that lag further behind the
        # best of their record, or behind acceptance, can't be chosen whatever the others do.
        most = SHARE * BEST
        own = Window.partitionBy("rid")
        scored = e.select("rid", "uber_id", "look", z.alias("z")).where(F.col("z") >= -most).withColumn("top", F.max("z").over(own)).where(F.col("z") >= F.col("top") - most)
        # A record delivered twice may have an edge twice.
        scored = scored.groupBy("rid", "uber_id").agg(F.max("look").alias("look"), F.max("z").alias("z"))
        scored = cut(scored.withColumn("k", F.count("*").over(own)))
        settled, open_ = scored.where("k = 1").drop("k"), cut(scored.where("k > 1").drop("k"))

        def ballots(x: DataFrame) -> DataFrame:
            """How many records of the same words choose a publication that suits them by itself."""
            return x.where("look IS NOT NULL AND z >= 0").groupBy("look", "uber_id").agg(F.count("*").alias("n"))

        def supported(edges: DataFrame, mine: Column, *by: DataFrame) -> DataFrame:
            """Edges with their support: SHARE of the greatest score times n / (n + 1) for n other
            records of the same words that choose the same publication. As support depends on
            their number only and rises with it, records that change one after the other come to
            rest."""
            n = None
            for x in by:
                n = x if n is None else n.unionByName(x)
            x = edges.join(n.groupBy("look", "uber_id").agg(F.sum("n").alias("n")), ["look", "uber_id"], "left")
            others = F.coalesce("n", F.lit(0)) - F.when(mine & (F.col("z") >= 0) & F.col("n").isNotNull(), 1).otherwise(0)
            return x.withColumn("c", F.col("z") + most * others / (others + 1)).drop("n")

        calm = cut(ballots(settled.join(open_.select("look").distinct(), "look", "left_semi")))
        lead = Window.partitionBy("rid").orderBy(F.desc("c"), "uber_id")
        now = open_.withColumn("c", F.col("z")).withColumn("mine", F.row_number().over(lead) == 1).drop("c")
        for turn in range(rounds):
            now = cut(now)
            # All may change at first, then half of the records at a time, so none swap for ever.
            free = F.pmod(F.xxhash64("rid", F.lit(turn)), F.lit(2 if turn else 1)) == 0
            want = supported(now, F.col("mine"), calm, ballots(now.where("mine"))).withColumn("want", F.row_number().over(lead) == 1)
            want = cut(want.select("rid", "uber_id", "look", "z", "c", "mine", "want", free.alias("free")))
            if want.where("mine <> want").isEmpty():
                break
            now = want.select("rid", "uber_id", "look", "z", F.when(F.col("free"), F.col("want")).otherwise(F.col("mine")).alias("mine"))
        else:
            raise RuntimeError("matches did not settle; raise rounds")
        final = supported(settled, F.lit(True), ballots(settled), ballots(want.where("mine")))
        now = final.select("rid", "uber_id", "c").union(want.where("mine").select("rid", "uber_id", "c"))
        first = now.groupBy("rid").agg(F.max_by(F.struct("uber_id", "c"), F.struct("c", -F.col("uber_id"))).alias("b"))
        conf = 1 / (1 + F.exp(-F.col("b.c")))
        return first.select("rid", "b.uber_id", F.round(conf, 6).alias("confidence")).where(F.col("confidence") >= accept)
