"""Scalar text functions: Column in, Column out, JVM only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the Unicode sense, spelt out because regex dialects differ.
WS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Display names of the crawled organisations.
ORGANISATIONS = {"who_iris": "WHO", "nice": "NICE", "parliament": "Parliament", "unicef": "UNICEF", "msf": "MSF", "gov_uk": "Gov.uk"}


def clean_text(c: Column) -> Column:
    """Line feeds to blanks, runs of white space to one blank, then signs deleted, lower case.
    Signs go after blanks are collapsed, so "a - b" keeps two blanks. Null stays null."""
    c = F.regexp_replace(F.regexp_replace(c, "\n", " "), f"{WS}+", " ")
    return F.lower(F.regexp_replace(c, "[^A-Za-z0-9 ]", ""))


def words(c: Column, pattern: str = r"[\p{L}\p{N}_]{2,}") -> Column:
    """Lower-cased word runs of two or more characters, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(f"({pattern})"), 1)


def long_title(c: Column, most: int = 512) -> Column:
    """Titles above ``most`` characters: the first ``most``, without the last word cut through."""
    w = F.filter(F.split(F.substring(c, 1, most), f"{WS}+"), lambda x: x != "")
    return F.when(F.char_length(c) > most, F.array_join(F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0))), " ")).otherwise(c)


def title_case(c: Column) -> Column:
    """All lower case but the first character, raised only if it is an ASCII word character."""
    low = F.lower(c)
    head = F.substring(low, 1, 1)
    return F.concat(F.when(head.rlike("[a-z]"), F.upper(head)).otherwise(head), F.substring(low, F.lit(2), F.char_length(low)))


def display_title(c: Column, most: int = 140) -> Column:
    return F.when(c.isNull(), "Title unavailable").when(F.char_length(c) > most, F.concat(title_case(F.substring(c, 1, most)), F.lit("..."))).otherwise(title_case(c))


def display_organisation(c: Column) -> Column:
    """Display name of an organisation; null where it has none."""
    names = F.create_map(*[F.lit(x) for kv in ORGANISATIONS.items() for x in kv])
    return F.try_element_at(names, c)


def author_string(authors: Column, last: str = "lastname", initials: str = "initials") -> Column:
    """"Last Initials" of every author joined by ", "; Unknown and ? stand for missing parts."""
    one = lambda a: F.concat_ws(" ", F.coalesce(a[last], F.lit("Unknown")), F.coalesce(a[initials], F.lit("?")))
    return F.array_join(F.transform(authors, one), ", ")


def first_title(title: Column, *fallbacks: Column) -> Column:
    """The title unless missing or empty, else the first element of the first non-empty list."""
    return F.coalesce(F.nullif(title, F.lit("")), *[F.try_element_at(x, F.lit(1)) for x in fallbacks])


def year_prefix(c: Column) -> Column:
    return F.when(F.length(c) > 0, F.substring(c, 1, 4))


def component(tokens: Column, label: str) -> Column:
    """Tokens with one label joined by blanks, '' if there are none."""
    return F.array_join(F.transform(F.filter(tokens, lambda t: t["label"] == label), lambda t: t["token"]), " ")


def edit_share(a: Column, b: Column) -> Column:
    """Edit distance over the longer length; 0 where both are empty, null where one is null."""
    return F.levenshtein(a, b) / F.greatest(F.char_length(a), F.char_length(b), F.lit(1))


def edit_distance_or_zero(a: Column, b: Column) -> Column:
    """Edit distance over the longer length, but 0 if either side is empty: the scoring rule
    of reference parsing. Null where one side is null."""
    return F.when((a == "") | (b == ""), F.lit(0.0)).otherwise(edit_share(a, b))


def percent_off(predicted: Column, actual: Column) -> Column:
    """Absolute difference in per cent of the actual count; a count of 0 counts as 1."""
    return F.abs(100.0 * (predicted - actual) / F.when(actual == 0, F.lit(1)).otherwise(actual))


def half_even(c: Column, digits: int = 3) -> Column:
    """Rounded to ``digits``, halves to the even digit."""
    return F.bround(c, digits)


def blank(c: Column) -> Column:
    """Any value as text; null and NaN become ''."""
    t = c.cast("string")
    return F.coalesce(F.nullif(t, F.lit("NaN")), F.lit(""))


def display_authors(authors: Column, first: str = "initials", last: str = "lastname") -> Column:
    """"Initials. Lastname" of every author joined by blanks; missing parts are left out."""
    return F.array_join(F.transform(authors, lambda a: F.concat_ws(". ", a[first], a[last])), " ")


def json_value(c: Column) -> Column:
    """A value as JSON shows it: dates and times in ISO form, without a fraction where it is
    zero, other kinds as their text."""
    return F.regexp_replace(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), r"\.000000$", "")


def valid_contact(required: list[Column], email: Column) -> Column:
    """Whether all required fields are filled and the address has the form of one."""
    ok = F.coalesce(email.rlike(r"^[^@]+@[^@]+\.[^@]+"), F.lit(False))
    for c in required:
        ok = ok & F.coalesce(F.trim(c) != "", F.lit(False))
    return ok


def datestamped(name: Column, day: Column) -> Column:
    """``day`` before the first dot of a file name, at its end if it has none."""
    at = F.instr(name, F.lit("."))
    return F.when(at > 0, F.concat(F.substring(name, F.lit(1), at - 1), F.lit("_"), day, F.substring(name, at, F.char_length(name)))).otherwise(F.concat_ws("_", name, day))


def page_numbers(total: Column, page: Column, size: int = 25) -> Column:
    """array<int> of the pages a pager shows: first, last and two on either side of ``page``;
    0 stands for the dots between pages that are not neighbours."""
    last = F.greatest(F.ceil(total / size).cast("int"), F.lit(1))
    near = F.filter(F.sequence(F.greatest(page - 2, F.lit(1)), F.greatest(F.least(page + 2, last), F.greatest(page - 2, F.lit(1)))), lambda p: p <= last)
    shown = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1)), near, F.array(last))))
    return F.flatten(F.transform(shown, lambda p, i: F.when((i > 0) & (F.element_at(shown, F.greatest(i, F.lit(1))) < p - 1), F.array(F.lit(0), p)).otherwise(F.array(p))))


def reference_id(c: Column) -> Column:
    """A reproducible 64-bit id of a reference's text."""
    return F.xxhash64(c)


def pages_shown(total: Column, page: Column, size: int = 25) -> Column:
    """"Showing a - b of n" of a result page counted from 1."""
    first = (F.greatest(page, F.lit(1)) - 1) * size + 1
    return F.format_string("Showing %d - %d of %d", F.least(first, total).cast("long"), F.least(first + size - 1, total).cast("long"), total.cast("long"))
