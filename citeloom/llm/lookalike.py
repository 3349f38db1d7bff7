"""Problem 3: one consistent form for text that looks the same.

Look-alike classes are the connected components (union-find) of pairs of strings that look
the same: compatibility forms, canonical compositions, blanks of other widths, characters
without a glyph, and letters of other scripts drawn like Latin ones. Each class is written
as its most frequent member in the collection; a multi-pattern automaton rewrites texts
leftmost-longest until nothing changes.
"""

from __future__ import annotations

import re
import unicodedata as U
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of other scripts that are drawn like a Latin letter.
CYRILLIC = "аеорсухіѕјһԁԛԝАВЕКМНОРСТУХІЅЈԌ"
LATIN_CYRILLIC = "aeopcyxisjhdqwABEKMHOPCTYXISJG"
GREEK = "οναΑΒΕΖΗΙΚΜΝΟΡΤΥΧ"
LATIN_GREEK = "ovaABEZHIKMNOPTYX"
OTHER = {"\u0131": "i", "\u0251": "a", "\u0261": "g", "\u0555": "O", "\u0585": "o", "\u2010": "-", "\u2011": "-"}
# Characters without a glyph.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200c\u200d\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\ufeff"
# Compatibility mappings that keep the look of the text.
SAME_LOOK = {"<wide>", "<narrow>", "<noBreak>", "<compat>"}
# α is kept apart: in the titles it is a symbol, drawn unlike the letter a.
NOT_ALIKE = {"α"}


def partners(ch: str) -> list[str]:
    """Strings that look like ``ch`` by one rule each."""
    out = []
    if ch in INVISIBLE:
        return [""]
    if ch in OTHER:
        out.append(OTHER[ch])
    if ch in CYRILLIC:
        out.append(LATIN_CYRILLIC[CYRILLIC.index(ch)])
    if ch in GREEK and ch not in NOT_ALIKE:
        out.append(LATIN_GREEK[GREEK.index(ch)])
    if U.category(ch) == "Zs" and ch != " ":
        out.append(" ")
    d = U.decomposition(ch)
    if d and U.category(ch) != "Zs":
        kind, *rest = d.split() if d.startswith("<") else ("", *d.split())
        if not kind or kind in SAME_LOOK:
            flat = "".join(chr(int(x, 16)) for x in rest)
            if not flat.startswith(" "):  # spacing accents stand for themselves
                out.append(flat)
    return out


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def union(self, a: str, b: str) -> None:
        self.up[self.find(a)] = self.find(b)


def rewrite_rules(counts: dict[str, int]) -> dict[str, str]:
    """{pattern: representative} for an alphabet with its counts; only patterns that change.

    A class is written as its most frequent single character, of accented letters the one
    whose bare letter is the most frequent, ties to the lowest code point; the class of the empty string is removed from the text. A class with members of
    several characters (a ligature, a letter and its accent written apart) is written as the
    longest of those without a combining accent, if any: single characters are counted,
    sequences are not.
    """
    cls = Classes()
    todo, seen = sorted(counts), set()
    marks = [c for c in counts if U.combining(c)]
    for m in marks:  # base and accent written apart
        for c in counts:
            both = U.normalize("NFC", c + m)
            if len(both) == 1 and c not in INVISIBLE:
                cls.union(c + m, both)
                todo.append(both)
    while todo:
        ch = todo.pop()
        if ch in seen or len(ch) != 1:
            continue
        seen.add(ch)
        for p in partners(ch):
            cls.union(ch, p)
            nfc = U.normalize("NFC", p)
            if nfc != p:
                cls.union(p, nfc)
            plain = "".join((partners(x) or [x])[0] if len(x) == 1 and x != ch else x for x in p)
            if plain != p:
                cls.union(p, plain)
                composed = U.normalize("NFC", plain)
                cls.union(plain, composed)
                todo.append(composed)
            todo.extend(p)
            todo.append(nfc)
    groups: dict[str, list[str]] = {}
    for x in list(cls.up):
        groups.setdefault(cls.find(x), []).append(x)
    rules = {}
    for members in groups.values():
        if "" in members:
            best = ""
        else:
            multi = [m for m in members if len(m) > 1 and U.normalize("NFC", m) == m and not any(U.combining(c) for c in m)]
            best = (
                max(multi, key=lambda m: (len(m), m))
                if multi
                else max(members, key=lambda m: (counts.get(U.normalize("NFD", m)[0], 0), counts.get(m, 0), len(m) == 1, -ord(m[0])))
            )
        rules.update({m: best for m in members if m != best and m})
    return rules


def alphabet(df: DataFrame, *columns: str) -> dict[str, int]:
    """Count of every character; its size is bounded by Unicode's 1.1 million code points.

    Characters are counted per task before anything moves.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        total = np.zeros(0x110000, np.int64)
        for b in batches:
            for c in b.columns:
                raw = "".join(x for x in b[c] if x).encode("utf-32-le", "surrogatepass")
                n = np.bincount(np.frombuffer(raw, np.uint32))
                total[: len(n)] += n
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"cp": seen, "n": total[seen]})

    rows = df.select(*columns).mapInPandas(count, "cp long, n long").groupBy("cp").agg(F.sum("n").alias("n")).collect()
    return {chr(r.cp): r.n for r in rows if not 0xD800 <= r.cp <= 0xDFFF}


def rewriter(rules: dict[str, str]):
    """str -> str by a multi-pattern automaton, leftmost-longest, repeated until stable."""
    if not rules:
        return lambda t: t
    import ahocorasick

    auto = ahocorasick.Automaton()
    for k in rules:
        auto.add_word(k, k)
    auto.make_automaton()

    def run(text: str) -> str:
        for _ in range(1000):
            out, at = [], 0
            for end, k in auto.iter_long(text):
                start = end - len(k) + 1
                out += [text[at:start], rules[k]]
                at = end + 1
            if not out:
                return text
            text = "".join(out) + text[at:]
        raise RuntimeError("rewriting did not settle")

    return run


class Consistent:
    """The consistent form fitted to a collection; apply to any column of it."""

    def __init__(self, counts: dict[str, int]) -> None:
        self.rules = rewrite_rules(counts)
        # A superset of the texts to rewrite that the JVM can test fast.
        plain = all(ord(k[-1]) > 127 for k in self.rules)
        self.touched = (r"[^\x00-\x7F]" if plain else r"(?s).") if self.rules else None

    def column(self, col: Column) -> Column:
        """Null stays null; outer blanks are removed; untouched texts never leave the JVM."""
        trimmed = F.trim(col)
        if not self.touched:
            return trimmed
        rules = self.rules

        @F.pandas_udf("string")
        def rewrite(s: pd.Series) -> pd.Series:
            run = rewriter(rules)
            return s.map(lambda t: None if t is None else run(t).strip(" "))

        return F.when(col.rlike(self.touched), rewrite(F.when(col.rlike(self.touched), col))).otherwise(trimmed)


def fit(*frames: tuple[DataFrame, str]) -> Consistent:
    total: dict[str, int] = {}
    for df, c in frames:
        for k, n in alphabet(df, c).items():
            total[k] = total.get(k, 0) + n
    return Consistent(total)


def same_look_pairs(df: DataFrame, id_col: str, text_col: str, form: Consistent) -> DataFrame:
    """(id_a, id_b): texts with one consistent form but different characters.

    Null and blank texts match nothing. Rows with one id count once (any of its texts).
    Only 64-bit digests move. Distinct spellings meet first; records join the pairs of their
    spelling, so a title in a third of the rows meets the odd spellings of it, not itself.
    """
    from ..session import cut

    t = df.where(F.col(id_col).isNotNull() & (F.trim(text_col) != "")).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    t = t.select("id", F.xxhash64("t").alias("raw"), F.xxhash64(form.column(F.col("t"))).alias("form")).groupBy("id").agg(F.min(F.struct("form", "raw")).alias("x")).select("id", "x.form", "x.raw")
    t = cut(t)
    mixed = t.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("form")
    kinds = cut(t.groupBy("form", "raw").agg(F.count("*").alias("n")).join(mixed, "form").select("form", "raw"))
    two = kinds.toDF("form", "ra").join(kinds.toDF("form", "rb"), "form").where("ra < rb").select("ra", "rb")
    own = t.join(kinds.select("raw").distinct(), "raw").select("raw", "id")
    met = two.join(own.toDF("ra", "x"), "ra").join(own.toDF("rb", "y"), "rb").where("x <> y")
    return met.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def same_look_classes(df: DataFrame, id_col: str, text_col: str, form: Consistent) -> DataFrame:
    """(id, class_id, spellings): one row per record that looks like a differently typed one;
    class_id is the least id of its look, spellings the number of different character
    sequences in the class. The form of the pairs that grows with the records only."""
    t = df.where(F.col(id_col).isNotNull() & (F.trim(text_col) != "")).groupBy(F.col(id_col).alias("id")).agg(F.min(text_col).alias("t"))
    t = t.select("id", F.xxhash64("t").alias("raw"), F.xxhash64(form.column(F.col("t"))).alias("form"))
    per = t.groupBy("form", "raw").agg(F.min("id").alias("least")).groupBy("form").agg(F.min("least").alias("class_id"), F.count("*").alias("spellings")).where("spellings > 1")
    return t.join(per, "form").select("id", "class_id", "spellings")
