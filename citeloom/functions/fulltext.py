"""Full-text search: weighted lexemes, web-style queries and cover-density rank."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

WEIGHT = {"A": 1.0, "B": 0.4, "C": 0.2, "D": 0.1}
TOKEN = r"[\p{L}\p{N}_]+"


def lexemes(*fields: tuple[Column, str]) -> Column:
    """array<struct<lexeme, pos, weight>> of fields in order; positions run on across fields.
    Null fields take no positions. Words are lower-cased runs of letters, digits and _."""
    out = None
    for c, w in fields:
        toks = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({TOKEN})"), 1)
        base = F.lit(0) if out is None else F.size(out)
        part = F.transform(toks, _placed(base, WEIGHT[w]))
        out = part if out is None else F.concat(out, part)
    return out


def _placed(base: Column, weight: float):
    return lambda t, i: F.struct(t.alias("lexeme"), (base + i + 1).cast("int").alias("pos"), F.lit(weight).alias("weight"))


@dataclass(frozen=True)
class Node:
    """op: word, phrase, not, and, or."""

    op: str
    words: tuple[str, ...] = ()
    kids: tuple["Node", ...] = ()


def parse(text: str | None) -> Node | None:
    """Unquoted words are joined by AND, "..." is a phrase, or is OR, a leading - is NOT; other
    signs are blanks. None for a query without words, which matches nothing."""
    alternatives: list[list[Node]] = [[]]
    for m in re.finditer(r'(-?)"([^"]*)"|(-?)([^\s"]+)', text or ""):
        neg, raw, quoted = (m[1], m[2], True) if m[2] is not None else (m[3], m[4], False)
        if not quoted and raw.lower() == "or" and not neg:
            alternatives.append([])
            continue
        ws = tuple(re.findall(r"\w+", raw.lower()))
        if not ws:
            continue
        node = Node("phrase", ws) if len(ws) > 1 and quoted else Node("word", ws) if len(ws) == 1 else Node("and", kids=tuple(Node("word", (w,)) for w in ws))
        alternatives[-1].append(Node("not", kids=(node,)) if neg else node)
    kept = [Node("and", kids=tuple(a)) for a in alternatives if a]
    return None if not kept else kept[0] if len(kept) == 1 else Node("or", kids=tuple(kept))


def matches(vector: Column, query: Node | None) -> Column:
    """Whether the lexemes satisfy the query; false for no query and for a null vector."""
    if query is None:
        return F.lit(False)
    words = F.transform(vector, lambda x: x["lexeme"])

    def of(n: Node) -> Column:
        if n.op == "word":
            return F.array_contains(words, n.words[0])
        if n.op == "phrase":
            return F.exists(vector, lambda x: (x["lexeme"] == n.words[0]) & _all(*[F.exists(vector, _follows(x, k, w)) for k, w in enumerate(n.words[1:], 1)]))
        if n.op == "not":
            return ~of(n.kids[0])
        out = of(n.kids[0])
        for k in n.kids[1:]:
            out = (out & of(k)) if n.op == "and" else (out | of(k))
        return out

    return F.coalesce(of(query), F.lit(False))


def _follows(x: Column, k: int, word: str):
    return lambda y: (y["lexeme"] == word) & (y["pos"] == x["pos"] + k)


def _is(word: str):
    return lambda x: x["lexeme"] == word


def _all(*cs: Column) -> Column:
    out = cs[0]
    for c in cs[1:]:
        out = out & c
    return out


def positive_words(n: Node | None) -> list[str]:
    if n is None or n.op == "not":
        return []
    return sorted(set(n.words) | {w for k in n.kids for w in positive_words(k)})


def cover_rank(vector: Column, query: Node | None) -> Column:
    """Cover density over the query's words, all required to be in a cover.

    A cover is a shortest stretch with every word. It adds (entries / sum of 1 / weight) /
    (1 + words between that belong to no entry). Exact for queries of AND-ed words;
    for OR queries the rank is the sum over the alternatives' covers.
    """
    if query is None:
        return F.lit(0.0)
    if query.op == "or":
        out = cover_rank(vector, query.kids[0])
        for k in query.kids[1:]:
            out = out + cover_rank(vector, k)
        return out
    ws = positive_words(query)
    if not ws:
        return F.lit(0.0)
    hits = F.array_sort(F.transform(F.filter(vector, lambda x: x["lexeme"].isin(ws)), lambda x: F.struct(x["pos"].alias("pos"), x["lexeme"].alias("lexeme"), x["weight"].alias("weight"))))
    empty = F.array().cast("array<struct<pos:int,lexeme:string,weight:double>>")
    start = F.struct(F.lit(0.0).alias("rank"), empty.alias("open"))

    def step(s: Column, h: Column) -> Column:
        grown = F.concat(s["open"], F.array(h))
        # Left end of the shortest stretch that ends here: the earliest last occurrence of a word.
        lasts = [F.array_max(F.transform(F.filter(grown, _is(w)), lambda x: x["pos"])) for w in ws]
        complete = _all(*[x.isNotNull() for x in lasts])
        left = F.least(*lasts) if len(lasts) > 1 else lasts[0]
        inside = F.filter(grown, lambda x: x["pos"] >= left)
        n = F.size(inside)
        inverse = F.aggregate(inside, F.lit(0.0), lambda a, x: a + 1 / x["weight"])
        noise = h["pos"] - left - (n - 1)
        gain = (n / inverse) / (1 + noise)
        rest = F.filter(grown, lambda x: x["pos"] > left)
        return F.struct(F.when(complete, s["rank"] + gain).otherwise(s["rank"]).alias("rank"), F.when(complete, rest).otherwise(grown).alias("open"))

    return F.coalesce(F.aggregate(hits, start, step, lambda s: s["rank"]), F.lit(0.0))
