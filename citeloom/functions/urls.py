"""URL predicates and parts that never fail on malformed input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"


def scheme(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, PARTS, 1))


def host(c: Column) -> Column:
    """Host without user, port and case; '' for relative URLs."""
    return F.lower(F.regexp_replace(F.regexp_replace(F.regexp_extract(c, PARTS, 2), "^.*@", ""), r":\d*$", ""))


def path(c: Column) -> Column:
    return F.regexp_extract(c, PARTS, 3)


def is_pdf_url(c: Column) -> Column:
    """Non-empty, of a web or relative scheme, with a path (not query) that ends in .pdf.
    Null and URLs with an unclosed bracket in the host are false."""
    broken = F.regexp_extract(c, PARTS, 2).contains("[") & ~F.regexp_extract(c, PARTS, 2).contains("]")
    good = (c != "") & scheme(c).isin("", "http", "https", "ftp", "ftps") & F.lower(path(c)).endswith(".pdf") & ~broken
    return F.coalesce(good, F.lit(False))


def is_pdf_response(content_type: Column, url: Column) -> Column:
    """application/pdf, or octet-stream under a PDF URL; parameters after ; are ignored."""
    kind = F.lower(F.trim(F.split(content_type, ";")[0]))
    return F.coalesce((kind == "application/pdf") | ((kind == "application/octet-stream") & is_pdf_url(url)), F.lit(False))


def filename(c: Column) -> Column:
    """What follows the last slash of the whole URL, query included."""
    return F.element_at(F.split(c, "/"), -1)


def bare(c: Column) -> Column:
    """URL without query and fragment."""
    return F.regexp_extract(c, r"^([^?#]*)", 1)


def storage_key(prefix: str, digest: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix), F.lit("pdf"), F.substring(digest, 1, 2), F.concat(digest, F.lit(".pdf")))


def disposition_title(c: Column) -> Column:
    """name, else filename, else filename* of a Content-Disposition header, without quotes."""
    parts = F.transform(F.split(c, ";"), lambda x: F.trim(x))

    def of(key: str) -> Column:
        hit = F.filter(parts, lambda x: F.lower(x).startswith(key + "="))
        return F.regexp_replace(F.try_element_at(F.transform(hit, lambda x: F.regexp_extract(x, "=(.*)$", 1)), F.lit(1)), '^"|"$', "")

    return F.coalesce(of("name"), of("filename"), of("filename*"))


def storage_parts(c: Column) -> Column:
    """struct<bucket, key> of an object's URL; null unless its scheme is s3 or manifests3."""
    parts = r"^(s3|manifests3)://([^/?#]*)/?(.*)$"
    return F.when(c.rlike(parts), F.struct(F.regexp_extract(c, parts, 2).alias("bucket"), F.regexp_extract(c, parts, 3).alias("key")))


def file_digest(content: Column) -> Column:
    """MD5 of a file's bytes."""
    return F.md5(content)
