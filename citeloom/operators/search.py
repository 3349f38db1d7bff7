"""Ranked, sorted, paginated search over publications and policies, and their exports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fulltext

CITATION_SORTS = {"rank": "rank", "match_title": "title", "match_publication": "journal_title", "match_pub_year": "pub_year", "associated_policies_count": "policies_count"}
POLICY_SORTS = {"rank": "rank", "title": "title", "organisation": "source_org", "year": "year"}


@dataclass(frozen=True)
class Page:
    """One page of a ranked result: sort key, direction, offset and size."""

    key: str
    ascending: bool
    offset: int
    size: int

    @staticmethod
    def of(sorts: dict[str, str], sort: str | None = None, order: str | None = None, size: int = 25, page: int = 1) -> "Page":
        """ValueError for a sort or order that is not known. Without a sort: by rank, falling,
        whatever the order; pages count from 1 and lower numbers mean the first."""
        order = (order or "desc").lower()
        if order not in ("asc", "desc") or (sort is not None and sort not in sorts):
            raise ValueError("Invalid ordering operation")
        return Page(sorts[sort or "rank"], order == "asc" and sort is not None, max(page - 1, 0) * size, size)

    def orders(self, tie: str) -> list[Column]:
        """Nulls come last when rising and first when falling; ties go by id."""
        c = F.col(self.key)
        return [c.asc_nulls_last() if self.ascending else c.desc_nulls_first(), F.col(tie).asc()]

    def take(self, df: DataFrame, tie: str) -> DataFrame:
        return df.orderBy(*self.orders(tie)).offset(self.offset).limit(self.size)


def ranked(df: DataFrame, vector: Column, terms: str | None) -> DataFrame:
    """Rows that match the terms, with their rank; no terms match nothing."""
    q = fulltext.parse(terms)
    return df.withColumn("_v", vector).where(fulltext.matches(F.col("_v"), q)).withColumn("rank", F.round(fulltext.cover_rank(F.col("_v"), q), 6)).drop("_v")


def cited(df: DataFrame, citations: DataFrame, key: str) -> DataFrame:
    """Rows joined with their citations; publications without a citing policy drop out, so a
    page, its count and its order agree."""
    return df.join(citations, key).where("size(policies) > 0").withColumn("policies_count", F.size("policies"))


def respond(hits: DataFrame, sorts: dict[str, str], key: str, terms: str | None, sort: str | None = None, order: str | None = None, size: int = 25, page: int = 1, fields: list[str] | None = None) -> dict:
    """The response of a search: status, data (one page), count (of all matches), terms; for
    terms that are missing or an unknown sort or order: status and message. ``size`` bounds
    what the driver holds."""
    if not (terms or "").strip():
        return {"status": "error", "message": "No search terms"}
    try:
        wanted = Page.of(sorts, sort, order, size, page)
    except ValueError as e:
        return {"status": "error", "message": str(e)}
    rows = wanted.take(hits, key).select(*(fields or hits.columns)).collect()
    return {"status": "success", "data": [r.asDict(True) for r in rows], "count": hits.agg(F.count(key)).first()[0], "terms": terms}


def with_policies(page: DataFrame, key: str, policies: DataFrame, fields: list[str], nested: str = "policies") -> DataFrame:
    """Policies of each row's array ``policies`` as an array of structs; null where none is known.
    ``policies`` has a column policy_id; rows keep all other columns."""
    pid = page.select(key, F.explode("policies").alias("policy_id")).distinct()
    got = pid.join(policies, "policy_id").groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("_n"))
    return page.drop(nested).join(got, key, "left").withColumnRenamed("_n", nested)


def flat_rows(rows: DataFrame, key: str, policies: DataFrame) -> DataFrame:
    """One row per (row, known policy); a row without a known policy stands once with nulls."""
    pid = rows.select(key, F.explode("policies").alias("policy_id")).distinct()
    return rows.drop("policies").join(pid.join(policies, "policy_id"), key, "left")


def json_array(rows: DataFrame, *orders: Column) -> DataFrame:
    """One row, one column ``json``: all rows as a JSON array, null fields kept; the literal null
    for no rows. For results that one file must hold; larger ones are written as JSON lines."""
    return rows.agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("a")).select(F.when(F.size("a") == 0, F.lit("null")).otherwise(F.to_json("a", {"ignoreNullFields": "false"})).alias("json"))


def any_field_matches(query: str | None, *fields: Column) -> Column:
    """OR over fields of: all words before the first comma stand in the field."""
    q = fulltext.parse((query or "").split(",")[0].replace('"', " "))
    out = F.lit(False)
    for f in fields:
        out = out | fulltext.matches(fulltext.lexemes((f, "D")), q)
    return out


def terms_per_field(terms: str, fields: str) -> dict[str, list[str]]:
    """Terms (comma separated) dealt to fields; fields named twice merge; J.Doe is two words."""
    import re

    out: dict[str, list[str]] = {}
    for t, f in zip(terms.split(","), fields.split(",")):
        ws = out.setdefault(f.strip(), [])
        ws.extend(w for w in re.findall(r"\w+", t.lower()) if w not in ws)
    return out


def all_terms_of_one_field(wanted: dict[str, list[str]]) -> Column:
    """All terms of at least one field stand in it."""
    out = F.lit(False)
    for f, ws in wanted.items():
        toks = F.regexp_extract_all(F.lower(F.coalesce(F.col(f), F.lit(""))), F.lit(f"({fulltext.TOKEN})"), 1)
        out = out | (F.size(F.array_intersect(toks, F.array(*[F.lit(w) for w in ws]))) >= len(ws))
    return out
