"""Problem 4: variant spellings of the names of persons and bodies.

Names are points of the edit-distance metric. Cells are centred on strings: a name lies in
the cell of every string that it becomes by at most r deletions, which replicates it across
cell boundaries. Two names within r edits share a centre (the letters an alignment keeps),
so the exact radius join inside the cells, with the true edit distance, misses no pair. Each
spelling joins the most frequent spelling in its radius; within a surname, initials,
forenames and places of work tell persons apart.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, one_delivery

# Short forms of forenames and what they stand for.
SHORT = dict(
    x.split(":")
    for x in (
        "bob:robert rob:robert bobby:robert bill:william will:william billy:william dick:richard rick:richard rich:richard peggy:margaret maggie:margaret meg:margaret liz:elizabeth beth:elizabeth betty:elizabeth "
        "lizzie:elizabeth kate:katherine kathy:katherine katie:katherine tony:anthony sue:susan susie:susan debbie:deborah deb:deborah vicky:victoria vicki:victoria gabi:gabriela gaby:gabriela nick:nicholas joe:joseph joey:joseph "
        "jim:james jimmy:james andy:andrew drew:andrew ben:benjamin dan:daniel danny:daniel ed:edward eddie:edward ted:edward ned:edward tom:thomas tommy:thomas pat:patricia patty:patricia trish:patricia dave:david steve:stephen "
        "mike:michael mick:michael chris:christopher kit:christopher sam:samuel alex:alexander sasha:alexander misha:mikhail dima:dmitri mitya:dmitri paco:francisco pancho:francisco beppe:giuseppe peppe:giuseppe pino:giuseppe jack:john "
        "harry:henry hank:henry larry:lawrence pepe:jose nacho:ignacio lena:elena katya:ekaterina kolya:nikolai volodya:vladimir zhenya:evgeny sandy:sandra mandy:amanda jenny:jennifer becky:rebecca cathy:catherine charlie:charles "
        "fred:frederick greg:gregory jeff:jeffrey ken:kenneth matt:matthew ray:raymond ron:ronald tim:timothy ulli:ulrich uli:ulrich lucy:lucia jorge:george barb:barbara kim:kimberly phil:philip max:maximilian"
    ).split()
)
TITLES = frozenset("dr prof professor mr mrs ms sir dame mx drs ir".split())
PARTICLES = frozenset("van von de der den du da di del della la le el al bin ibn ben ter ten".split())
# Words of the names of bodies; other words of such a name are its place.
BODY = frozenset("ministry min health welfare public agency national natl institute inst for care research royal college coll nursing practice medical relief society soc of in and the department dept office centre university hospital faculty school board council committee association federation fund trust service services".split())
LINKERS = frozenset("of in and the for".split())


def plain(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text.replace("ø", "o").replace("Ø", "O")) if not unicodedata.combining(c))


def edits(a: str, b: str, most: int) -> int:
    """Levenshtein distance, or most + 1 if it is greater."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def radius(n: int) -> int:
    """Edits allowed for a name of n letters."""
    return 0 if n < 4 else 1 if n < 7 else 2


def parallel(df: DataFrame) -> int:
    """Partitions for work that is heavier than its bytes: as many as a shuffle has."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def centres(name: str, r: int) -> set[str]:
    """Strings that ``name`` becomes by at most r deletions."""
    out, edge = {name}, {name}
    for _ in range(r):
        edge = {x[:i] + x[i + 1 :] for x in edge for i in range(len(x))}
        out |= edge
    return out


def _near(word: str, known: frozenset[str]) -> bool:
    return word in known or (len(word) >= 5 and any(edits(word, k, 1) <= 1 or (len(k) > 6 and edits(word, k, 2) <= 2) for k in known if abs(len(k) - len(word)) <= 2 and len(k) >= 5))


def acronym_place(text: str) -> tuple[str, str] | None:
    """(initials of a body's own words, its place) or None if the text names no body.

    The and linking words do not count; an acronym stands for itself, without the small o
    of "of".
    """
    words = re.findall(r"[^\W\d_&]+", re.sub(r"\.(?=\w)", "", plain(text)))
    low = [w.lower() for w in words]
    own = [w for w in low if w not in LINKERS and _near(w, BODY)]
    if len(own) >= 2:
        rest = [w for w in low if w not in LINKERS and w not in own]
        return "".join(w[0] for w in own).upper(), "".join(rest)
    if len(words) >= 2 and low[0] == "the":
        words, low = words[1:], low[1:]
    if len(words) == 2 and re.fullmatch(r"[A-Z][A-Zo]{2,4}", words[0]) and len(words[1]) > 5:
        return words[0].replace("o", "").replace("O", ""), low[1]
    return None


def place_of(affiliation: str | None) -> str:
    """The place in an affiliation: its last word, which may stand in brackets; '' if none."""
    words = re.findall(r"[^\W\d_]+", plain(affiliation or "").lower())
    return words[-1] if words and words[-1] not in BODY else ""


def is_initials(word: str) -> bool:
    return bool(re.fullmatch(r"(?:[^\W\d_]\.?[ -]?){1,3}", word)) and word.upper() == word


class Person:
    """surname (letters only), initials, forename ('' where unknown)."""

    def __init__(self, surname: str, given: list[str]) -> None:
        self.surname = re.sub(r"[\W\d_]+", "", plain(surname).lower())
        self.forename, self.initials = "", ""
        for g in given:
            w = re.sub(r"[\W\d_]+", "", plain(g))
            if is_initials(g) or len(w) == 1:
                self.initials += w.lower()
            elif w:
                full = SHORT.get(w.lower(), w.lower())
                self.initials += full[0]
                self.forename = self.forename or full


def parse_person(text: str, forenames: frozenset[str]) -> Person:
    """Surname and given names from any order: "A B", "B, A", "B A", initials on either side."""
    if "," in text:
        left, _, right = text.partition(",")
        sur, giv = left.split(), right.split()
        if sur and giv and all(is_initials(x) for x in sur) and not all(is_initials(x) for x in giv):
            sur, giv = giv, sur
        return Person(" ".join(w for w in sur if w.lower().strip(".") not in TITLES), giv)
    words = [w for w in text.split() if w.lower().strip(".") not in TITLES]
    ini = [w for w in words if is_initials(w) and w.lower() not in PARTICLES]
    names = [w for w in words if w not in ini]
    if len(names) <= 1:
        return Person(" ".join(names), ini)
    # a particle belongs to the word after it
    units: list[str] = []
    hold = ""
    for w in names:
        if w.lower() in PARTICLES and w != names[-1]:
            hold += w + " "
        else:
            units.append(hold + w)
            hold = ""
    if len(units) == 1:
        return Person(units[0], ini)

    def score(w: str) -> int:
        w = plain(w).lower()
        if " " in w or "-" in w:
            return 0
        if w in forenames or w in SHORT:
            return 3
        return 2 if len(w) >= 4 and any(f[0] == w[0] and edits(w, f, 2) <= (2 if len(w) > 5 else 1) for f in forenames) else 1

    first, last = score(units[0]), score(units[-1])
    if ini and max(first, last) < 2:
        return Person(" ".join(units), ini)  # a double surname with a blank
    if last > first:
        return Person(" ".join(units[:-1]), [units[-1], *ini])
    return Person(" ".join(units[1:]), [units[0], *ini])


PROFILE = "id long, name string, initials string, forename string, place string"


def profiles(df: DataFrame, forenames: frozenset[str]) -> DataFrame:
    """One row per entry: name is 'p:surname' or 'b:ACRONYM:place'; entries without a name are left out."""

    def one(last: str | None, ini: str | None, authors: str | None) -> tuple[str, str, str] | None:
        text = (authors or "").strip()
        if last or ini:
            l, i = (last or "").strip(), (ini or "").strip()
            if l and i and is_initials(l) and not is_initials(i):
                l, i = i, l
            if not l and not is_initials(i):
                l, i = i, ""
            body = acronym_place(l) if not i else None
            if body is None:
                p = parse_person(l, forenames) if not i and " " in l and "," in l else Person(l, i.replace(".", " ").split())
                return (f"p:{p.surname}", p.initials, p.forename) if p.surname else None
            return f"b:{body[0]}:{body[1]}", "", ""
        if not text:
            return None
        body = acronym_place(text)
        if body:
            return f"b:{body[0]}:{body[1]}", "", ""
        p = parse_person(text, forenames)
        return (f"p:{p.surname}", p.initials, p.forename) if p.surname else None

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for i, l, n, a, w in zip(f["id"], f["lastname"], f["initials"], f["authors"], f["affiliation"]):
                got = one(l, n, a)
                if got:
                    rows.append((i, *got, place_of(w)))
            yield pd.DataFrame(rows, columns=["id", "name", "initials", "forename", "place"])

    return df.mapInPandas(run, PROFILE)


def common_forenames(df: DataFrame, share: float = 0.0015, floor: int = 6) -> frozenset[str]:
    """Words that stand with many different other words in the names typed; at most 2 / share."""
    words = df.where("authors IS NOT NULL").select(F.filter(F.split(F.lower(F.regexp_replace("authors", r"[^\p{L}\p{M}' -]", " ")), r"\s+"), lambda w: F.length(w) > 2).alias("w")).where("size(w) = 2")
    pair = words.select(F.col("w")[0].alias("a"), F.col("w")[1].alias("b"))
    both = pair.union(pair.select("b", "a")).toDF("word", "other").distinct()
    n = both.count() / 2
    rows = both.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= max(floor, share * n)).toLocalIterator()
    known = {plain(r.word) for r in rows if plain(r.word) not in BODY and plain(r.word) not in TITLES and plain(r.word) not in PARTICLES}
    return frozenset(known | set(SHORT.values()) | set(SHORT))


def radius_pairs(names: DataFrame) -> DataFrame:
    """(a, b, na, nb, d): all pairs of distinct names within the edit radius of the shorter one.

    names: (name, n). The part before the last colon must be equal. A cell is keyed by a
    digest of its centre, so a cell is as small as the names that share nearly all letters.
    """

    def cells(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            c, a, n = [], [], []
            for name, k in zip(f["name"], f["n"]):
                head, _, tail = name.rpartition(":")
                for x in centres(tail, radius(len(tail))):
                    c.append(f"{head}:{x}")
                    a.append(name)
                    n.append(k)
            yield pd.DataFrame({"c": c, "name": a, "n": n})

    cell = cut(names.repartition(parallel(names), "name").mapInPandas(cells, "c string, name string, n long").select(F.xxhash64("c").alias("c"), "name", "n"))
    shared = cell.groupBy("c").agg(F.count("*").alias("k")).where("k > 1").select("c")
    cell = cell.join(shared, "c")
    a, b = cell.toDF("c", "a", "na"), cell.toDF("c", "b", "nb")
    met = a.join(b, "c").where("a < b").select("a", "b", "na", "nb").distinct()
    tail = lambda x: F.element_at(F.split(x, ":"), -1)
    met = met.withColumn("d", F.levenshtein(tail("a"), tail("b"), 2))
    short = F.least(F.length(tail("a")), F.length(tail("b")))
    r = F.when(short < 4, 0).when(short < 7, 1).otherwise(2)
    return met.where((F.col("d") >= 0) & (F.col("d") <= r))


def pivots(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """(name, root): each name's most frequent neighbour, followed to a name that leads its own."""
    both = pairs.select(F.col("a").alias("name"), F.col("b").alias("to"), "na", F.col("nb").alias("nt"), "d").union(pairs.select("b", "a", "nb", "na", "d"))
    up = both.where("nt > na OR (nt = na AND to < name)").groupBy("name").agg(F.max_by("to", F.struct("nt", -F.col("d"), "to")).alias("root"))
    step = cut(names.select("name").join(up, "name", "left").select("name", F.coalesce("root", "name").alias("root")))
    for _ in range(40):  # every round doubles the steps taken, and counts rise along the way
        nxt = step.select(F.col("name").alias("root"), F.col("root").alias("top"))
        far = cut(step.join(nxt, "root").select("name", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")))
        step = far.drop("moved")
        if far.where("moved").isEmpty():
            return step
    raise RuntimeError("chains of names did not settle")


def split_group(rows: list[tuple]) -> list[int]:
    """Person number of every profile of one surname and first initial. Rows: name, initials,
    forename, place (one spelling per place), n. Profiles with a place make the persons, one
    per place and forename; a profile without goes to the best-supported person it fits."""
    name, ini, fore, place, n = zip(*rows)
    people: list[dict] = []
    at_place: dict[str, list[dict]] = {}
    by_name: dict[str, list[dict]] = {}
    who = [-1] * len(n)

    def fits(e: dict, i: int) -> bool:
        return not (fore[i] and e["fore"] and not any(edits(fore[i], x, 2) <= 2 for x in e["fore"]))

    def add(e: dict, i: int) -> None:
        who[i] = e["no"]
        e["n"] += n[i]
        if name[i] not in e["names"]:
            e["names"].add(name[i])
            by_name.setdefault(name[i], []).append(e)
        e["ini"].add(ini[i])
        if fore[i]:
            e["fore"].add(fore[i])

    def new(i: int) -> dict:
        e = {"no": len(people), "n": 0, "ini": set(), "fore": set(), "names": set(), "place": place[i]}
        people.append(e)
        at_place.setdefault(place[i], []).append(e)
        return e

    for i in sorted(range(len(n)), key=lambda i: (not place[i], -n[i], -len(ini[i]), name[i], ini[i], place[i])):
        def rank(e: dict) -> tuple:
            second = len(ini[i]) > 1 and any(x[:2] == ini[i][:2] for x in e["ini"])
            clash = len(ini[i]) > 1 and not second and any(len(x) > 1 for x in e["ini"])
            return (name[i] in e["names"], second or bool(fore[i] and fore[i] in e["fore"]), not clash, e["n"])

        if place[i]:
            fit = [e for e in at_place.get(place[i], []) if fits(e, i)]
        else:  # persons who share the spelling of the name come before all others
            fit = [e for e in by_name.get(name[i], []) if fits(e, i)] or [e for e in people if fits(e, i)]
        best = max(fit, key=rank) if fit else None
        if best is not None and len(ini[i]) > 1 and not place[i]:
            r = rank(best)
            if not r[2] and any(len(x) > 1 for x in best["ini"]) and not r[1]:
                best = None  # another middle initial and no place in common
        add(best or new(i), i)
    return who


def one_spelling(kinds: DataFrame) -> DataFrame:
    """``kinds`` with the places of each root brought to one spelling: the most frequent within
    the edit radius. Null and empty places stay ''."""
    key = F.concat("root", F.lit(":"), "place")
    p = cut(kinds.where("place <> ''").groupBy(key.alias("name")).agg(F.sum("n").alias("n")))
    tail = F.element_at(F.split("top", ":"), -1)
    top = pivots(p, cut(radius_pairs(p))).select(F.col("name").alias("_k"), F.col("root").alias("top"))
    x = kinds.join(top, key == F.col("_k"), "left")
    return x.select(*[c for c in kinds.columns if c != "place"], "place", F.coalesce(tail, F.col("place")).alias("p"))


def entities(df: DataFrame, key: str = "contributor_id", at: str | None = "loaded_at") -> DataFrame:
    """(id, entity): one row per entry; equal entity means the same person or body.

    Expects lastname, initials, authors, affiliation. Entries without any name are entities
    of their own (entity null). Profiles, not rows, are told apart: a name typed in a third of
    all rows is one profile. Profiles with initials are dealt by surname and first initial;
    those without join the person of their surname and place, or the best supported one.
    """
    src = one_delivery(df.select(key, "lastname", "initials", "authors", "affiliation", *([at] if at else [])), key, at).withColumnRenamed(key, "id")
    prof = cut(profiles(src.select("id", "lastname", "initials", "authors", "affiliation"), common_forenames(src)))
    names = cut(prof.groupBy("name").agg(F.count("*").alias("n")))
    root = pivots(names, cut(radius_pairs(names)))
    kinds = cut(prof.groupBy("name", "initials", "forename", "place").agg(F.count("*").alias("n")).join(root, "name"))
    body = F.col("root").startswith("b:")
    persons = cut(one_spelling(kinds.where(~body)))
    first = F.substring("initials", 1, 1)
    cols = ["name", "initials", "forename", "place"]
    out = "name string, initials string, forename string, place string, root string, p string, n long, entity string"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Groups come in a row and are held one at a time; thousands of small ones share a call."""
        held, done, key = [], [], None
        names = [x.split()[0] for x in out.split(", ")]

        def close() -> None:
            no = split_group([(r[0], r[1], r[2], r[5], r[6]) for r in held])
            done.extend((*r, f"{r[4]}#{r[1][:1]}{k}") for r, k in zip(held, no))
            held.clear()

        for f in frames:
            for row in zip(*(f[c] for c in names[:-1])):
                k = (row[4], row[1][:1])
                if k != key and held:
                    close()
                    if len(done) > 20_000:
                        yield pd.DataFrame(done, columns=names)
                        done.clear()
                key = k
                held.append(row)
        if held:
            close()
        yield pd.DataFrame(done, columns=names)

    many = F.count("*").over(Window.partitionBy("root", first))
    sized = cut(persons.where("initials <> ''").withColumn("k", many))
    alone = sized.where("k = 1").select(*cols, "root", "p", "n", F.concat("root", F.lit("#"), first, F.lit("0")).alias("entity"))
    groups = sized.where("k > 1").select(*cols, "root", "p", "n").repartition(parallel(df), "root", first).sortWithinPartitions("root", first)
    known = cut(groups.mapInPandas(run, out).unionByName(alone))
    # Persons by what a profile without initials can be looked up by: place and spelling, then
    # place, then persons without a place, or spelling and surname where it has no place.
    people = cut(known.groupBy("root", "entity").agg(F.max("p").alias("p"), F.sum("n").alias("n"), F.collect_set("name").alias("names")))
    bare = persons.where("initials = ''")
    order = F.struct("n", "entity")
    spelt = people.select("root", "entity", "p", "n", F.explode("names").alias("name"))

    def best(x: DataFrame, by: list[str], tag: str) -> DataFrame:
        return x.groupBy(*by).agg(F.max_by("entity", order).alias(tag))

    x = bare.join(best(spelt, ["root", "name", "p"], "e1"), ["root", "name", "p"], "left").join(best(people, ["root", "p"], "e2"), ["root", "p"], "left")
    x = x.join(best(spelt, ["root", "name"], "e3"), ["root", "name"], "left").join(best(people, ["root"], "e4"), ["root"], "left")
    x = x.join(best(people.where("p = ''"), ["root"], "e5"), ["root"], "left")
    placed = F.coalesce("e1", "e2", "e5", F.concat("root", F.lit("#@"), "p"))
    entity = F.when(F.col("p") != "", placed).otherwise(F.coalesce("e3", "e4", F.concat("root", F.lit("#@"))))
    who = known.select(*cols, "entity").unionByName(x.select(*cols, entity.alias("entity"))).unionByName(kinds.where(body).select(*cols, F.col("root").alias("entity")))
    return prof.join(who, cols).select("id", "entity")


def same_entity_pairs(ent: DataFrame) -> DataFrame:
    """(id_a, id_b) of every two entries of one entity."""
    e = ent.where("entity IS NOT NULL").select("id", F.xxhash64("entity").alias("e"))
    many = e.groupBy("e").agg(F.count("*").alias("n")).where("n > 1").select("e")
    e = e.join(many, "e")
    return e.select("e", F.col("id").alias("id_a")).join(e.select("e", F.col("id").alias("id_b")), "e").where("id_a < id_b").select("id_a", "id_b")
