"""Scraped pages to rows: titles, headings, links and site-specific requests and files."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls

# One declarative row per site. Selectors are tags, .classes and #ids, blanks mean
# "inside". article: links to detail pages; next: link to the next listing; file: links to
# documents, alternatives in order of preference ("=text" is a link that holds the text);
# one: only the first file link of a page counts; pdf: it must be a PDF's URL; group: the element
# that holds a link and its details; title: where a file's title comes from.
SITES: dict[str, dict] = {
    "who_iris": {"article": ".artifact-title a", "suffix": "?show=full", "next": ".next-page-link", "file": [".file-link a"], "title": "field"},
    "nice": {"article": "h3.card__heading a", "next": "=Next", "file": ["=Save as PDF", ".track-link", "#nice-download"], "one": True, "title": "h1", "related": ["/evidence", "/history"]},
    "gov_uk": {"article": ".gem-c-document-list__item-title", "next": ".gem-c-pagination__item--next a", "file": [".attachment-details h2 a"], "pdf": True, "title": "h1"},
    "msf": {"group": ".field-item p", "file": ["a.btn"], "pdf": True, "title": "alt"},
    "msf_reports": {"file": [".field-item a"], "pdf": True, "title": "link"},
    "parliament": {"group": "#results li", "article": "#results h4 a", "details": ".resultdetails", "next": ".next a", "file": ["a"], "pdf": True, "title": "listing"},
    "unicef": {"article": ".block--card__body__text h3 a", "next": ".pagination .next", "file": ["a"], "pdf": True, "title": "h1"},
    "acme": {"article": ".doc-page-link", "next": ".next", "file": [".doc-download-link"], "title": "link"},
}
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ITEM = "kind:string,href:string,title:string,link_text:string,year:string,types:string"
PAGE = f"url string, site string, title string, headings array<string>, links array<struct<href:string,text:string,kind:string>>, fields map<string,array<string>>, items array<struct<{ITEM}>>"

Element = tuple[str, frozenset, str]


@functools.lru_cache(maxsize=256)
def _selector(text: str) -> tuple[tuple[str, frozenset, str], ...]:
    parts = []
    for p in text.split():
        p, _, ident = p.partition("#")
        tag, *classes = p.split(".")
        parts.append((tag, frozenset(classes), ident))
    return tuple(parts)


def selects(selector: str, chain: list[Element]) -> bool:
    """Whether the last element of ``chain`` (from the root down) is one that ``selector`` selects."""
    want = list(_selector(selector))
    fits = lambda p, e: (not p[0] or p[0] == e[0]) and p[1] <= e[1] and (not p[2] or p[2] == e[2])
    if not want or not chain or not fits(want.pop(), chain[-1]):
        return False
    for e in reversed(chain[:-1]):
        if want and fits(want[-1], e):
            want.pop()
    return not want


class Page(HTMLParser):
    """One pass over a page; tolerant of unclosed elements."""

    def __init__(self, site: str) -> None:
        super().__init__(convert_charrefs=True)
        self.rule = SITES.get(site, {})
        self.open: list[Element] = []
        self.title: str | None = None
        self.headings: list[str] = []
        self.h1: str | None = None
        self.published: str | None = None
        self.links: list[dict] = []
        self.rows: list[list[str]] = []
        self.groups: list[dict] = []
        self.group: tuple[int, dict] | None = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        a = dict(attrs)
        chain = [*self.open, (tag, frozenset((a.get("class") or "").split()), a.get("id") or "")]
        if tag not in VOID:
            self.open.append(chain[-1])
        if self.rule.get("group") and selects(self.rule["group"], chain):
            self.group = (len(self.open), {"links": [], "alt": None, "details": []})
            self.groups.append(self.group[1])
        if tag == "tr":
            self.rows.append([])
        elif tag == "td" and self.rows:
            self.rows[-1].append("")
        elif tag == "time" and self.published is None and any("published-date" in c for _, c, _ in chain):
            self.published = a.get("datetime")
        elif tag == "img" and a.get("alt"):
            if self.group and self.group[1]["alt"] is None:
                self.group[1]["alt"] = a["alt"]
            if self.links and any(t == "a" for t, _, _ in self.open):
                self.links[-1]["text"] += a["alt"]
        if tag == "a" and a.get("href"):
            link = {"href": a["href"].strip(), "text": "", "chain": chain}
            self.links.append(link)
            if self.group:
                self.group[1]["links"].append(link)

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break
        if self.group and len(self.open) < self.group[0]:
            self.group = None

    def handle_data(self, data: str) -> None:
        tags = [t for t, _, _ in self.open]
        if tags[-1:] == ["title"] and self.title is None:
            self.title = data
        if tags[-1:] and tags[-1] in ("h1", "h2", "h3") and data.strip():
            self.headings.append(data)
            if tags[-1] == "h1" and self.h1 is None:
                self.h1 = data.strip("\n ")
        if "a" in tags and self.links:
            self.links[-1]["text"] += data
        if "td" in tags and self.rows and self.rows[-1]:
            self.rows[-1][-1] += data
        if self.group and self.rule.get("details") and selects(self.rule["details"], self.open) and data.strip():
            self.group[1]["details"].append(data.strip())

    def fields(self) -> dict[str, list[str]]:
        """Rows "scheme.attribute.qualifier | value": attribute words lower-cased to their values."""
        out: dict[str, list[str]] = {}
        for r in self.rows:
            if len(r) >= 2 and "." in r[0]:
                out.setdefault(" ".join(r[0].strip().split(".")[1:]).lower(), []).append(r[1].strip())
        return out

    def _is(self, link: dict, selector: str | None) -> bool:
        if not selector:
            return False
        return selector[1:] in link["text"] if selector[0] == "=" else selects(selector, link["chain"])

    def kind(self, link: dict) -> str:
        for k in ("article", "next"):
            if self._is(link, self.rule.get(k)):
                return k
        return "file" if any(self._is(link, s) for s in self.rule.get("file", ())) else "other"

    def items(self) -> list[dict]:
        """Requests (article, related, next) and files of the page by its site's rule."""
        rule, out = self.rule, []
        blank = dict.fromkeys(("title", "link_text", "year", "types"))
        for link in self.links:
            k = self.kind(link)
            if k == "article":
                own = next((g for g in self.groups if link in g["links"]), None)
                d = own["details"] if own else []
                about = {"title": link["text"].strip(), "link_text": link["text"].strip(), "year": d[0][-4:], "types": d[1] if len(d) > 1 else None} if d else blank
                out.append({"kind": k, "href": link["href"] + rule.get("suffix", ""), **about})
                out += [{"kind": "related", "href": link["href"] + s, **blank} for s in rule.get("related", ())]
            elif k == "next":
                out.append({"kind": k, "href": link["href"], **blank})
        year = (self.published or "")[:4] or None
        chosen: list[tuple[dict, dict | None]] = []
        for s in rule.get("file", ()):
            if rule.get("group") and rule.get("title") == "alt":
                chosen += [(hit[0], g) for g in self.groups if (hit := [x for x in g["links"] if self._is(x, s)])]
            else:
                chosen += [(x, None) for x in self.links if self._is(x, s) and self.kind(x) not in ("article", "next")]
            if chosen and rule.get("one"):
                chosen = chosen[:1]
                break
        field = self.fields().get("title", [None])[0]
        for link, g in chosen:
            if rule.get("pdf") and not _pdf(link["href"]):
                continue
            title = {"h1": self.h1, "alt": g and g["alt"], "link": link["text"].strip(), "field": field}.get(rule.get("title"))
            out.append({"kind": "file", "href": link["href"], "title": title, "link_text": link["text"].strip() if rule.get("title") == "link" else None, "year": year, "types": None})
        return out


def _pdf(url: str) -> bool:
    try:
        u = urlsplit(url)
    except ValueError:
        return False
    return u.scheme in ("", "http", "https", "ftp", "ftps") and u.path.lower().endswith(".pdf")


def extract_pages(df: DataFrame, url: str = "url", html: str = "html", site: str = "site") -> DataFrame:
    """One row per page: title, text directly under h1 to h3, links resolved against the page's
    URL, metadata tables, and the requests and files of its site. Null pages give empty lists."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for u, h, s in zip(f["url"], f["html"], f["site"]):
                p = Page(s or "")
                p.feed(h or "")
                suffix = p.rule.get("suffix", "")
                kinds = [(x, p.kind(x)) for x in p.links]
                links = [{"href": urljoin(u or "", x["href"]) + (suffix if k == "article" else ""), "text": x["text"].strip(), "kind": k} for x, k in kinds]
                items = [{**x, "href": urljoin(u or "", x["href"])} for x in p.items()]
                rows.append((u, s, p.title, p.headings, links, p.fields(), items))
            yield pd.DataFrame(rows, columns=["url", "site", "title", "headings", "links", "fields", "items"])

    return df.select(F.col(url).alias("url"), F.col(html).alias("html"), F.col(site).alias("site")).mapInPandas(run, PAGE)


def requests(pages: DataFrame) -> DataFrame:
    """(url, site, kind, href, title, year, types): pages to ask for next, each once per page."""
    x = pages.select("url", "site", F.explode("items").alias("i")).where("i.kind <> 'file'")
    return x.select("url", "site", "i.kind", "i.href", "i.title", "i.year", "i.types").distinct()


def site_files(pages: DataFrame, listing: DataFrame | None = None) -> DataFrame:
    """(source_page, site, pdf, title, link_text, year, types, page_title, page_headings): the
    documents that pages offer. ``listing``: requests whose title, year and types pass on to
    the files of the page they led to, for sites that describe a document in the listing."""
    x = pages.select("url", "site", "title", "headings", F.explode("items").alias("i")).where("i.kind = 'file'")
    x = x.select(F.col("url").alias("source_page"), "site", F.col("i.href").alias("pdf"), F.col("i.title").alias("title"), "i.link_text", "i.year", "i.types", F.col("title").alias("page_title"), F.col("headings").alias("page_headings"))
    if listing is None:
        return x
    known = listing.where("kind = 'article' AND title IS NOT NULL").groupBy(F.col("href").alias("source_page")).agg(F.min(F.struct("title", "year", "types")).alias("_l"))
    x = x.join(known, "source_page", "left")
    return x.select("source_page", "site", "pdf", *[F.coalesce(c, F.col(f"_l.{c}")).alias(c) for c in ("title", "year", "types")], "link_text", "page_title", "page_headings")


def new_files(items: DataFrame, known: DataFrame, digest: str, pdf: str) -> DataFrame:
    """Items with a file whose digest is not known yet; items without a file are dropped."""
    return items.where(F.col(pdf).isNotNull() & (F.col(pdf) != "")).join(known.select(digest).where(F.col(digest).isNotNull()).distinct(), digest, "left_anti")


def pdf_links(pages: DataFrame) -> DataFrame:
    """(url, href, link_title): distinct links of a page that lead to PDFs."""
    x = pages.select("url", F.explode("links").alias("l")).where(urls.is_pdf_url(F.col("l.href")))
    return x.groupBy("url", F.col("l.href").alias("href")).agg(F.min("l.text").alias("link_title"))


def articles(pages: DataFrame) -> DataFrame:
    """Scraper items from detail pages: one row per page with its metadata and first PDF link."""
    one = lambda k: F.try_element_at(F.col("fields")[k], F.lit(1))
    first = pdf_links(pages).groupBy("url").agg(F.min("href").alias("pdf"))
    return pages.join(first, "url", "left").select(
        "url", F.coalesce(one("title"), F.try_element_at("headings", F.lit(1)), "title").alias("title"), F.substring(one("date issued"), 1, 4).alias("year"),
        F.array_join(F.col("fields")["contributor author"], ", ").alias("authors"), F.array_distinct(F.col("fields")["subject mesh"]).alias("subjects"), F.array_distinct(F.col("fields")["type"]).alias("types"), "pdf", F.col("title").alias("page_title"), F.col("headings").alias("page_headings"),
    )


def keep_allowed(df: DataFrame, url: str, hosts: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows whose host is allowed, refused requests per host). A disallowed host covers its
    subdomains only by name: hosts are compared whole."""
    h = F.coalesce(urls.host(F.col(url)), F.lit(""))
    bad = h.isin([x.lower() for x in hosts])
    return df.where(~bad), df.where(bad).groupBy(h.alias("host")).agg(F.count("*").alias("requests"))


def failure_kind(error: str):
    """Class of a failed request from the name of its error."""
    e = F.lower(F.coalesce(F.col(error), F.lit("")))
    return F.when(e.contains("http"), "http").when(e.contains("dns"), "dns").when(e.contains("timeout") | e.contains("timedout"), "timeout").when(e.contains("robots") | e.contains("ignorerequest"), "robots").otherwise("other")
