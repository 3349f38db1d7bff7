"""Problem 7: lines repeated across one source's documents.

A line is masked (numbers, dates and names become place-holders) and hashed by locality-
sensitive hashing over its pairs of neighbouring words; the lines of one source that share a
hash form a cluster. Clusters that stand in a large share of the source's documents are the
site's furniture. One pass over the texts writes a narrow table of line digests; everything
else joins and counts that table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import textkit as K
from .neardup import chunks

SEEDS = K.seeds(4, salt=7)
NUMBER, NAME = K.U64(0x51ED2701), K.U64(0xA24BAED4)


def line_spans(cp: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text number, line number from 1) of every line."""
    e = np.flatnonzero(cp == 10)
    s = np.empty_like(e)
    s[0] = 0
    s[1:] = e[:-1] + 1
    own = np.searchsorted(starts, s, "right") - 1
    first = np.searchsorted(own, np.arange(len(starts) - 1), "left")
    return s, e, own, np.arange(len(s)) - first[own] + 1


def line_digests(texts: list[str | None], min_chars: int) -> dict[str, np.ndarray]:
    """Digests of the lines with at least ``min_chars`` characters between the outer blanks.

    key: equal for lines equal but for case, amount of white space and values of digit runs.
    c1, c2: locality-sensitive hashes, equal with high probability for near-equal lines: c1 of
    the line with numbers and names masked, c2 with the values of digit runs masked only,
    so lines of one key always share c2.
    """
    cp, starts = K.codes(texts)
    kind, low = K.tables()
    k = kind[cp]
    space, digit = (k & K.SPACE) != 0, (k & K.DIGIT) != 0
    s, e, own, no = line_spans(cp, starts)
    ink = np.flatnonzero(~space)
    a, b = np.searchsorted(ink, s), np.searchsorted(ink, e)
    some = b > a
    ts, te = np.where(some, ink[np.minimum(a, len(ink) - 1)] if len(ink) else 0, 0), np.where(some, (ink[np.maximum(b - 1, 0)] if len(ink) else 0) + 1, 0)
    use = some & (te - ts >= min_chars)
    ts, te, own, no = ts[use], te[use], own[use], no[use]

    keep = np.ones(len(cp), bool)
    keep[1:] = ~((digit[1:] & digit[:-1]) | (space[1:] & space[:-1]))
    flat = low[cp].copy()
    flat[digit], flat[space] = 48, 32
    at = np.zeros(len(cp) + 1, np.int64)
    np.cumsum(keep, out=at[1:])
    hashed = K.prefix_hash(flat[keep])
    key = K.span_hash(hashed, at[ts], at[te])

    ws, we = K.runs((k & (K.LETTER | K.DIGIT)) != 0)
    wh = K.span_hash(hashed, at[ws], at[we])
    line = np.searchsorted(ts, ws, "right") - 1
    inside = (line >= 0) & (ws < te[np.maximum(line, 0)]) if len(ts) else np.zeros(len(ws), bool)
    ws, wh, line = ws[inside], wh[inside], line[inside]
    first = np.diff(line, prepend=-1) != 0
    upper = (kind[cp[ws]] & K.UPPER) != 0
    lowered = np.zeros(len(ts), bool)
    lowered[line[~upper & ((kind[cp[ws]] & K.LETTER) != 0)]] = True
    name = upper & ~first & lowered[line]
    tok = np.where((kind[cp[ws]] & K.DIGIT) != 0, NUMBER, np.where(name, NAME, wh))
    c = np.zeros((len(ts), 2), np.int64)
    st = np.flatnonzero(first)
    for j, (x, seeds) in enumerate(((tok, SEEDS[:2]), (wh, SEEDS[2:]))):
        if not len(x):
            continue
        prev = np.empty_like(x)
        prev[1:] = x[:-1]
        prev[first] = 1
        c[line[st], j] = K.band_keys(K.minhash(K.mix(prev * K.BASE + x), st, seeds), 2, salt=7 + j)[:, 0]
    bare = np.ones(len(ts), bool)
    bare[line] = False
    c[bare] = key[bare].view(np.int64)[:, None]  # lines of signs only

    def firsts(x: np.ndarray) -> np.ndarray:
        o = np.lexsort((x, own))
        f = np.ones(len(x), bool)
        f[o[1:]] = (x[o[1:]] != x[o[:-1]]) | (own[o[1:]] != own[o[:-1]])
        return f

    key = key.view(np.int64)
    return {"own": own, "line_no": no, "key": key, "c1": c[:, 0].copy(), "c2": c[:, 1].copy(), "fk": firsts(key), "f1": firsts(c[:, 0]), "f2": firsts(c[:, 1])}


class SiteLines:
    """The repeated lines of every source of ``df`` (id, text, source columns).

    Rows with a null id, text or source have no line here. min_share and min_docs are
    thresholds on the documents of one source. ``clusters`` holds every line of a hot
    cluster; ``repeated`` those of them that repeat, as they stand, often enough.
    """

    def __init__(self, df: DataFrame, id_col: str, text_col: str, source_col: str, min_chars: int = 20, min_share: float = 0.05, min_docs: int = 4) -> None:
        self.texts = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("t"), F.col(source_col).alias("source"))
        known = self.texts.where("doc_id IS NOT NULL AND source IS NOT NULL")

        def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for f in chunks(frames, "t"):
                d = line_digests(f["t"].tolist(), min_chars)
                own = d.pop("own")
                yield pd.DataFrame({"doc_id": f["doc_id"].to_numpy()[own], "source": f["source"].to_numpy()[own], "line_no": d["line_no"].astype(np.int32), **{c: d[c] for c in ("key", "c1", "c2", "fk", "f1", "f2")}})

        self.lines = cut(known.where("t IS NOT NULL").mapInPandas(digests, "doc_id long, source string, line_no int, key long, c1 long, c2 long, fk boolean, f1 boolean, f2 boolean"))
        self.floor = known.groupBy("source").agg(F.greatest(F.lit(float(min_docs)), F.lit(min_share) * F.count("*")).alias("least"))
        band = F.explode(F.array(F.struct(F.col("c1").alias("c"), F.col("f1").alias("f")), F.struct(F.col("c2").alias("c"), F.col("f2").alias("f"))))
        per = self.lines.select("source", band.alias("b")).groupBy("source", F.col("b.c").alias("c")).agg(F.sum(F.col("b.f").cast("long")).alias("docs"))
        self.hot = cut(per.where(F.col("docs") >= min_docs).join(self.floor, "source").where("docs >= least - 1e-9").select("source", "c", "docs"))
        either = self.lines.select("*", F.explode(F.array("c1", "c2")).alias("c")).join(self.hot.select("source", "c"), ["source", "c"], "left_semi")
        self.clusters = cut(either.drop("c").dropDuplicates(["doc_id", "line_no"]))

    def repeated(self) -> DataFrame:
        """(doc_id, line_no): exact check of the clusters' lines against the thresholds."""
        per = self.clusters.groupBy("source", "key").agg(F.sum(F.col("fk").cast("long")).alias("docs"))
        often = per.join(self.floor, "source").where("docs >= least - 1e-9").select("source", "key")
        return self.clusters.join(often, ["source", "key"], "left_semi").select("doc_id", F.col("line_no").cast("int").alias("line_no"))

    def cleaned(self) -> DataFrame:
        """(doc_id, source, text, lines_removed): every document without its site's lines.

        A document all of whose lines are furniture gets an empty text; null stays null.
        """
        drop = self.clusters.groupBy("doc_id").agg(F.array_sort(F.collect_set("line_no")).alias("drop"))
        kept = F.expr("array_join(filter(split(t, '\\n', -1), (x, i) -> drop IS NULL OR NOT array_contains(drop, i + 1)), '\\n')")
        return self.texts.join(drop, "doc_id", "left").select("doc_id", "source", kept.alias("text"), F.coalesce(F.size("drop"), F.lit(0)).alias("lines_removed"))
