"""Lines of parsed documents: fonts, title candidates, keywords in context, sections.

Lines are rows (doc, page, line_no, size, bold, text, face); line_no counts through the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYNTHETIC = "first line 24, lines that do not end with a full stop 16, others 12"


def text_lines(df: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, line_no, text, size) of every line; sizes are synthetic: see SYNTHETIC."""
    x = df.where(F.col(doc).isNotNull()).select(F.col(doc).alias("doc"), F.posexplode(F.split(text, "\n", -1)).alias("line_no", "text"))
    return x.withColumn("size", F.when(F.col("line_no") == 0, 24).when(F.col("text").endswith("."), 12).otherwise(16))


def font_stats(lines: DataFrame) -> DataFrame:
    """(doc, mean_size, upper_mean_size, sizes): mean rounded up, whole mean of the sizes above
    it (0 if none), distinct sizes in order. One window, no second pass over the lines."""
    m = lines.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("size", F.lit(1))))).alias("_d"), F.sum("size").alias("s"), F.count("size").alias("n"))
    per = lines.groupBy("doc", "size").agg(F.count("*").alias("k")).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("size", "k"))).alias("h"))
    x = m.drop("_d").join(per, "doc").withColumn("mean_size", F.ceil(F.col("s") / F.greatest("n", F.lit(1))).cast("int"))
    above = F.filter("h", lambda e: e["size"] > F.col("mean_size"))
    total = lambda f: F.aggregate(above, F.lit(0).cast("long"), f)
    k = total(lambda a, e: a + e["k"])
    upper = F.when(k > 0, F.floor(total(lambda a, e: a + e["size"] * e["k"]) / k)).otherwise(0).cast("int")
    return x.select("doc", "mean_size", upper.alias("upper_mean_size"), F.transform("h", lambda e: e["size"]).alias("sizes"))


def title_candidates(lines: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` lines by size, earlier lines first among equals."""
    r = F.row_number().over(Window.partitionBy("doc").orderBy(F.desc("size"), "line_no"))
    return lines.withColumn("rank", r).where(F.col("rank") <= top)


def page_text(lines: DataFrame, skip_numbers: bool = False) -> DataFrame:
    """(doc, page, text): lines joined by line feeds with one at the end; optionally without
    lines of digits only."""
    x = lines.where(~F.col("text").rlike(r"^\p{Nd}+$")) if skip_numbers else lines
    g = x.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    pages = lines.select("doc", "page").distinct()
    return pages.join(g, ["doc", "page"], "left").select("doc", "page", F.concat(F.array_join(F.transform(F.coalesce("l", F.array().cast("array<struct<line_no:int,text:string>>")), lambda e: e["text"]), "\n"), F.lit("\n")).alias("text"))


def keyword_hits(lines: DataFrame, keywords: list[str]) -> DataFrame:
    """(doc, line_no, keyword, hits): lines in which a keyword stands as a word of its own,
    without regard to case; hits counts its occurrences anywhere in the line."""
    low = F.lower("text")
    each = F.explode(F.array(*[F.lit(k.lower()) for k in keywords])).alias("keyword")
    x = lines.select("doc", "line_no", "text", each).where(low.contains(F.col("keyword")))
    word = F.concat(F.lit(r"(?i)(^|[^\p{L}\p{N}_])\Q"), F.col("keyword"), F.lit(r"\E([^\p{L}\p{N}_]|$)"))
    n = F.size(F.split(low, F.concat(F.lit(r"\Q"), F.col("keyword"), F.lit(r"\E")), -1)) - 1
    return x.where(F.regexp_like("text", word)).select("doc", "line_no", "keyword", n.alias("hits"))


def keyword_in_context(lines: DataFrame, keywords: list[str], context: int = 2) -> DataFrame:
    """(doc, keyword, line_no, hits, context): each hit line with the lines around it, joined by
    line feeds, across page boundaries. Several hits in one line repeat its context ``hits`` times."""
    w = Window.partitionBy("doc").orderBy("line_no").rowsBetween(-context, context)
    around = lines.select("doc", "line_no", F.array_join(F.collect_list(F.coalesce("text", F.lit(""))).over(w), "\n").alias("context"))
    return keyword_hits(lines, keywords).join(around, ["doc", "line_no"])


def lines_of_size(lines: DataFrame, size: int) -> DataFrame:
    return lines.where(F.col("size") == size)


def bold_lines(lines: DataFrame) -> DataFrame:
    return lines.where("bold")


def keyword_by_page(lines: DataFrame, keyword: str, context: int = 0) -> DataFrame:
    """(doc, page, line_no, context): lines that hold ``keyword`` as a word, its case kept.
    Without context every hit; with it only the last hit of a page, with the lines of that
    page around it."""
    word = rf"(^|[^\p{{L}}\p{{N}}_])\Q{keyword}\E([^\p{{L}}\p{{N}}_]|$)"
    if context == 0:
        return lines.where(F.col("text").contains(keyword) & F.regexp_like("text", F.lit(word))).select("doc", "page", "line_no", F.col("text").alias("context"))
    w = Window.partitionBy("doc", "page").orderBy("line_no").rowsBetween(-context, context)
    x = lines.select("doc", "page", "line_no", "text", F.array_join(F.collect_list(F.coalesce("text", F.lit(""))).over(w), "\n").alias("context")).where(F.regexp_like("text", F.lit(word)))
    return x.groupBy("doc", "page").agg(F.max_by(F.struct("line_no", "context"), "line_no").alias("_l")).select("doc", "page", "_l.line_no", "_l.context")


def keyword_dict(hits: DataFrame) -> DataFrame:
    """(doc, contexts map<keyword, array<context>>) of the rows of keyword_in_context, in line order."""
    per = hits.groupBy("doc", "keyword").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "context"))), lambda e: e["context"]).alias("_c"))
    return per.groupBy("doc").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("keyword", "_c")))).alias("contexts"))


def full_text(lines: DataFrame) -> DataFrame:
    """(doc, text): every line of a document joined by line feeds."""
    g = lines.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    return g.select("doc", F.array_join(F.transform("l", lambda e: F.coalesce(e["text"], F.lit(""))), "\n").alias("text"))


def sections(lines: DataFrame, keyword: str) -> DataFrame:
    """(doc, section): the text from each heading that holds ``keyword`` to the next heading.

    Headings are the lines of the largest size of which some line, clearly above the mean
    size or in the face of the largest line above the upper mean, matches the keyword as the
    start of a word. A heading that closes a section may open the next. A section covers
    whole pages, cut at its heading; if the closing heading stands on a later page only the
    last character is cut. Documents without a section give no row.
    """
    stats = font_stats(lines)
    face = lines.groupBy("doc").agg(F.min_by("face", F.struct(-F.col("size"), "line_no")).alias("top_face"))
    x = lines.join(stats, "doc").join(face, "doc")
    hit = F.regexp_like("text", F.lit(r"(?i)(^|[^\p{L}\p{N}_]+)" + keyword + r"[a-z]*(?=[^\p{L}\p{N}_]+|$)"))
    big = (F.col("size") > F.col("mean_size") + 1) | ((F.col("size") > F.col("upper_mean_size") + 2) & (F.col("face") == F.col("top_face")))
    chosen = x.where(big & hit).groupBy("doc").agg(F.max("size").alias("title_size"))
    heads = lines.join(chosen, "doc").where((F.col("size") == F.col("title_size")) & (F.trim("text") != ""))
    after = Window.partitionBy("doc").orderBy("line_no")
    heads = heads.withColumn("end_text", F.lead("text").over(after)).withColumn("end_page", F.lead("page").over(after)).where(F.lower("text").contains(keyword))
    pages = page_text(lines).groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("page", "text"))).alias("pages"))
    h = heads.select("doc", "line_no", F.col("text").alias("start_text"), F.col("page").alias("start_page"), "end_text", "end_page").join(pages, "doc")
    last = F.when(F.col("end_page").isNull(), F.lit(2**30)).when(F.col("end_page") == F.col("start_page"), F.col("end_page") + 1).otherwise(F.col("end_page"))
    body = F.array_join(F.transform(F.filter("pages", lambda p: (p["page"] >= F.col("start_page")) & (p["page"] < last)), lambda p: p["text"]), "")
    h = h.withColumn("body", body)
    h = h.withColumn("part", F.expr("substring(body, greatest(locate(start_text, body), 1), greatest(CASE WHEN end_text IS NULL THEN length(body) WHEN locate(end_text, body) > 0 THEN locate(end_text, body) - 1 ELSE length(body) - 1 END - greatest(locate(start_text, body), 1) + 1, 0))"))
    g = h.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct("line_no", "part"))).alias("s"))
    return g.select("doc", F.array_join(F.transform("s", lambda e: e["part"]), "").alias("section")).where("section <> ''")


def parse_pdf_xml(df: DataFrame, doc: str, xml: str) -> DataFrame:
    """(doc, page, line_no, size, bold, text, face) from the XML of a converted PDF.

    Text nodes of an element are joined by blanks in document order; fonts are looked up
    through the whole document. Malformed and null XML gives no lines.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xml.etree.ElementTree as ET

        cols = ["doc", "page", "line_no", "size", "bold", "text", "face"]
        for f in frames:
            rows = []
            for d, raw in zip(f["doc"], f["xml"]):
                try:
                    root = ET.fromstring(raw or "")
                except ET.ParseError:
                    continue
                fonts = {s.get("id"): s for s in root.iter("fontspec")}
                n = 0
                for number, page in enumerate(root.iter("page"), 1):
                    for t in page.iter("text"):
                        font = fonts.get(t.get("font"))
                        rows.append((d, number, n, int(float(font.get("size", 0))) if font is not None else None, False, " ".join(t.itertext()), font.get("family") if font is not None else None))
                        n += 1
            yield pd.DataFrame(rows, columns=cols).astype({"size": "Int32"})

    src = df.select(F.col(doc).cast("string").alias("doc"), F.col(xml).alias("xml"))
    return src.mapInPandas(run, "doc string, page int, line_no int, size int, bold boolean, text string, face string")
