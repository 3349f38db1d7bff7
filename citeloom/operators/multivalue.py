"""Problem 2: several values packed in one field, split into one value per row.

The field is split on its quote characters: odd pieces are literals, even pieces are split on
delimiters. Everything is a Column expression of Spark SQL array functions, so it stays in
the JVM; a fold puts surnames and forenames that a comma parted back together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Private-use characters that stand for an inner quote and for the quotes around a value
# while a field is worked on. They are removed from the input first.
INNER, EDGE = "", ""
# Delimiters between values: line feeds, semicolons, bars, slashes; runs of them are one.
STRONG = r"\s*(?:\r\n|[\n\r;|/])\s*"
BLANK = r"[\s  -  　]"
MARK = rf"^(?:{BLANK}|[-•*‣▪–]{BLANK}+|\(?\d{{1,2}}[.)]{BLANK}+)*|{BLANK}+$"
PARTICLES = r"(?:van|von|de|der|den|du|da|di|del|della|la|le|el|al|bin|ibn|ben|ter|ten|mc|mac|st\.?|van de[rn]?|de la)"


def unpacked(col: Column, names: bool) -> Column:
    """array<string> of the values packed in ``col``; null for null, empty for blank fields.

    names=False: commas delimit (a value that holds a comma is quoted).
    names=True: commas, "and" and "&" also delimit, but "surname, forename or initials" is
    one value, and so is "Health and Welfare" within the name of a body.
    Values keep inner blanks and repeats; outer blanks, list marks and the quotes around a
    value are removed, inner quotes that were doubled or escaped stand once.
    """
    c = F.regexp_replace(col, f"[{INNER}{EDGE}]", "")
    # A list in brackets: ["a", "b"].
    c = F.regexp_replace(c, r'(?s)^\s*\[\s*(".*")\s*\]\s*$', "$1")
    c = F.regexp_replace(c, r'\\"', INNER)
    # Doubled quotes inside a quoted value; an empty value "" between delimiters is none.
    c = F.regexp_replace(c, r'(^|[;|,/\n\r])([ \t]*)""(?=[ \t]*($|[;|,/\n\r]))', "$1$2")
    c = F.regexp_replace(c, '""', INNER)
    # Quotes that open a value stand at its start and close before a delimiter; others are text.
    opening = r"(^|[;|,/\n\r]|(?<=[;|,/\n\r ])[-•*] |(?<= )(?:and|&) )([ \t]*)"
    closing = r"(?=[ \t]*($|[;|,/\n\r]|and |& ))"
    c = F.regexp_replace(c, f'{opening}"([^"]*)"{closing}', f"$1$2{EDGE}$3{EDGE}")
    c = F.regexp_replace(c, '"', INNER)

    def loose(piece: Column) -> Column:
        """Values of an even piece."""
        strong = F.split(piece, STRONG)
        if not names:
            return F.flatten(F.transform(strong, lambda x: F.split(x, ",")))
        return F.flatten(F.transform(strong, lambda x: _people(F.regexp_replace(x, MARK, ""))))

    pieces = F.split(c, EDGE, -1)
    parts = F.transform(pieces, lambda x, i: F.when(i % 2 == 1, F.array(x)).otherwise(loose(x)))
    values = F.transform(F.flatten(parts), lambda x: F.translate(F.regexp_replace(x, MARK, ""), INNER, '"'))
    return F.filter(values, lambda x: x != "")


def _people(part: Column) -> Column:
    """Names in a piece without strong delimiters: split at commas and "and", then fold."""
    # "and" within the name of a body, as in "Ministry of X and Y" or "Health and Welfare": the
    # word after it is no name of its own.
    tied = F.regexp_replace(part, r"(?i)\s+(and|&)\s+(?:(?=welfare\b)|(?<=\bof [^\s,]{1,40}\s{1,4}(?:and|&)\s{1,4})(?=[^\s,]+(?:\s*$|\s+of\b(?!.*\bof\b))))", f"{EDGE}$1{EDGE}")
    bits = F.split(tied, r",\s*(?:and|&)\s+|,|\s+(?:and|&)\s+")
    bits = F.transform(bits, lambda x: F.trim(F.regexp_replace(x, f"{EDGE}(and|AND|And|&){EDGE}", " $1 ")))
    surname_only = lambda x: x.rlike(rf"(?i)^(?:{PARTICLES}\s+)*[^\s.]{{2,}}$") & ~x.rlike(r"^\p{Lu}{1,3}$")
    given_only = lambda x: x.rlike(r"^(?:\p{Lu}\p{M}*\.?[\s-]*){1,4}$") | x.rlike(r"^[^\s.,]+$") | x.rlike(r"^[^\s.,]+(?:\s+\p{Lu}\.?){1,2}$")
    state = F.struct(F.array().cast("array<string>").alias("done"), F.lit(None).cast("string").alias("open"))

    def step(s: Column, x: Column) -> Column:
        joins = s["open"].isNotNull() & (x != "") & surname_only(s["open"]) & given_only(x)
        push = F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"])))
        return F.struct(
            F.when(joins, F.concat(s["done"], F.array(F.concat(s["open"], F.lit(", "), x)))).otherwise(push).alias("done"),
            F.when(joins, F.lit(None).cast("string")).otherwise(x).alias("open"),
        )

    return F.aggregate(bits, state, step, lambda s: F.when(s["open"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["open"]))))


def value_rows(df: DataFrame, id_col: str, fields: dict[str, bool]) -> DataFrame:
    """(id, field_name, pos, item): one row per value of every field; pos counts from 1.

    fields: {column: whether it holds names}. Null and blank fields give no row. Columns of
    ``df`` that are not named are ignored.
    """
    packed = F.array(*[F.struct(F.lit(f).alias("field_name"), unpacked(F.col(f), names).alias("items")) for f, names in fields.items()])
    each = df.where(F.col(id_col).isNotNull()).select(F.col(id_col), F.explode(packed).alias("_f"))
    return each.select(id_col, "_f.field_name", F.posexplode("_f.items").alias("_p", "item")).select(id_col, "field_name", (F.col("_p") + 1).cast("int").alias("pos"), "item")
