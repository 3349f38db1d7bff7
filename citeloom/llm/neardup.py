"""Problem 1: near-duplicate records, a Jaccard metric-space join.

Records are points of the metric space of shingle sets under Jaccard distance. At the
distances asked for (0.5 and 0.4) a window of twice the radius around any fixed pivot spans
the whole space, so Voronoi regions of sampled pivots leave out no pair of regions. Pivots are
therefore drawn where the data lie: points fall in the cell of the shingles nearest to random
points (min-hash over all shingles, those of a house style included), a point lies in many
cells, which replicates it across boundaries, and the least point of a cell is its pivot.

Only ids, sizes and short sketches meet inside a cell; cells above a size are cut into blocks
that join pairwise. Pairs that sizes or sketches leave possible get an exact distance: first
every point and its pivot, then, where the triangle inequality over the pivot neither
rejects (distances differ by more than the radius) nor accepts (they sum to no more than it),
the two points. Records with equal shingle sets are one point.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from . import textkit as K

Shingler = Callable[[list[str | None]], tuple[np.ndarray, np.ndarray]]


def word_shingles(texts: list[str | None], n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every run of n words; words are lower-cased letters and digits."""
    cp, starts = K.codes(texts)
    s, _, h, _ = K.words(cp)
    if len(s) < n:
        return np.empty(0, K.U64), np.empty(0, np.int64)
    doc = np.searchsorted(starts, s, "right") - 1
    m = len(h) - n + 1
    v = np.zeros(m, K.U64)
    for j in range(n):
        v = K.mix(v * K.BASE + h[j : j + m])
    same = doc[:m] == doc[n - 1 :]
    return v[same], doc[:m][same]


def char_shingles(texts: list[str | None], n: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text number) of every n letters and digits in a row, lower-cased, others left out."""
    cp, starts = K.codes(texts)
    kind, low = K.tables()
    keep = (kind[cp] & (K.LETTER | K.DIGIT)) != 0
    at = np.flatnonzero(keep)
    x = low[cp[at]].astype(K.U64)
    if len(x) < n:
        return np.empty(0, K.U64), np.empty(0, np.int64)
    doc = np.searchsorted(starts, at, "right") - 1
    m = len(x) - n + 1
    v = np.zeros(m, K.U64)
    for j in range(n):
        v = K.mix(v * K.BASE + x[j : j + m])
    same = doc[:m] == doc[n - 1 :]
    return v[same], doc[:m][same]


def distinct(v: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles, sorted by text and hash."""
    o = np.argsort(v)
    o = o[np.argsort(d[o], kind="stable")]
    v, d = v[o], d[o]
    if len(v) == 0:
        return v, d
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (d[1:] != d[:-1])
    return v[first], d[first]


def chunks(frames: Iterator[pd.DataFrame], text: str, chars: int = 2_000_000) -> Iterator[pd.DataFrame]:
    """Frames cut so that each holds about ``chars`` characters, or one longer text."""
    for f in frames:
        size = f[text].str.len().fillna(0).to_numpy().cumsum()
        part = (size // chars).astype(np.int64)
        for _, g in f.groupby(part, sort=False):
            yield g


def sketches(sig: np.ndarray) -> np.ndarray:
    """Two bits of each of the first 96 min-hashes of every point: (points, 3) int64."""
    two = (sig[:, :96] & 3).astype(K.U64).reshape(len(sig), 3, 32)
    return np.bitwise_or.reduce(two << (K.U64(2) * np.arange(32, dtype=K.U64)), axis=2).view(np.int64)


def most_apart(threshold: float) -> int:
    """Of 96 sketch symbols, how many may differ between two points of similarity ``threshold``:
    the mean and 3.7 standard deviations, which one such pair in 9,000 exceeds."""
    p = 0.75 * (1 - threshold)
    return int(np.ceil(96 * p + 3.7 * (96 * p * (1 - p)) ** 0.5))


def near_duplicates(df: DataFrame, id_col: str, text_col: str, shingler: Shingler, threshold: float, rows: int, bands: int, block: int = 2000) -> tuple[DataFrame, DataFrame]:
    """(links, members): links (node_a, node_b, similarity) between different shingle sets with
    Jaccard similarity of at least ``threshold``, similarity null where the triangle
    inequality alone decided; members (node, id) for every record.

    Records without a shingle (null, empty, too short) belong to no node. Ids delivered
    twice count once. Other columns of ``df`` are ignored, so their names cannot clash.
    Recall is that of the cells, 1 - (1 - s**rows)**bands for a pair of similarity s, however
    common its shingles are; rows * bands is at least 96.
    """
    df = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    if rows * bands < 96:
        raise ValueError("sketches take 96 min-hashes")
    seeds = K.seeds(rows * bands)

    def signatures(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(frames, "t"):
            v, d = distinct(*shingler(f["t"].tolist()))
            if len(v) == 0:
                continue
            st = np.flatnonzero(np.diff(d, prepend=-1))
            size = np.diff(np.append(st, len(v)))
            node = K.mix(np.add.reduceat(K.mix(v), st)).view(np.int64)
            sig = K.minhash(v, st, seeds)
            x = sketches(sig)
            yield pd.DataFrame({"id": f["id"].to_numpy()[d[st]], "node": node, "size": size.astype(np.int32), "x": x[:, 0], "y": x[:, 1], "z": x[:, 2], "keys": list(K.band_keys(sig, rows))})

    sig = cut(df.mapInPandas(signatures, "id long, node long, size int, x long, y long, z long, keys array<long>"))
    members = sig.select("node", "id").distinct()
    points = cut(sig.groupBy("node").agg(F.min("id").alias("rep"), *[F.first(c).alias(c) for c in ("size", "x", "y", "z", "keys")]))
    # One exchange serves both the count of a cell and the way back to its points.
    cells = points.select("node", F.explode("keys").alias("key")).repartition("key")
    many = cells.groupBy("key").agg(F.min("node").alias("pivot"), F.count("*").alias("n")).where("n > 1")
    shared = cells.join(many, "key").join(points.select("node", "size", "x", "y", "z"), "node")
    shared = cut(shared.withColumn("k", F.ceil(F.col("n") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("k")).cast("int")).drop("n"))
    every = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("other")

    def side(tag: str, i: str, j: str) -> DataFrame:
        wide = shared.select("key", "pivot", "node", "size", "x", "y", "z", "own", every)
        return wide.select("key", F.col(i).alias("i"), F.col(j).alias("j"), *([F.col("pivot")] if tag == "a" else []), *[F.col(c).alias(f"{c}_{tag}") for c in ("node", "size", "x", "y", "z")])

    def apart(c: str):
        """Symbols of two bits that differ in one word of the sketches."""
        d = F.col(f"{c}_a").bitwiseXOR(F.col(f"{c}_b"))
        return F.bit_count(d.bitwiseOR(F.shiftrightunsigned(d, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    # Sizes bound the similarity: the triangle inequality with the empty set as pivot.
    window = (F.col("node_a") < F.col("node_b")) & (F.col("size_a") >= F.col("size_b") * (threshold - 1e-9)) & (F.col("size_b") >= F.col("size_a") * (threshold - 1e-9))
    near = apart("x") + apart("y") + apart("z") <= most_apart(threshold)
    met = side("a", "own", "other").join(side("b", "other", "own"), ["key", "i", "j"]).where(window & near)
    # A pivot is the least of its cell: node_a itself where the pair is one of point and pivot.
    pairs = cut(met.groupBy("node_a", "node_b").agg(F.max("pivot").alias("pivot")))

    def point_sets(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in chunks(frames, "t"):
            v, d = distinct(*shingler(f["t"].tolist()))
            if len(v) == 0:
                continue
            st = np.flatnonzero(np.diff(d, prepend=-1))
            node = K.mix(np.add.reduceat(K.mix(v), st)).view(np.int64)
            small = (v >> K.U64(32)).astype(np.uint32).view(np.int32)
            yield pd.DataFrame({"node": node, "items": [np.unique(x) for x in np.split(small, st[1:])]})

    wanted = pairs.select(F.explode(F.array("node_a", "node_b")).alias("node")).distinct().join(points.select("node", "rep"), "node").select("rep").distinct()
    sets = cut(df.join(wanted, df["id"] == wanted["rep"], "left_semi").select("t").mapInPandas(point_sets, "node long, items array<int>"))
    placed = sets.repartition("node")
    radius = 1 - threshold

    def measured(p: DataFrame) -> DataFrame:
        """(node_a, node_b, similarity) of any pairs: both sets at hand."""
        q = p.join(placed.select(F.col("node").alias("node_a"), F.col("items").alias("ia")), "node_a").join(placed.select(F.col("node").alias("node_b"), F.col("items").alias("ib")), "node_b")
        q = q.withColumn("both", F.size(F.array_intersect("ia", "ib")))
        return q.select("node_a", "node_b", (F.col("both") / (F.size("ia") + F.size("ib") - F.col("both"))).alias("similarity"))

    star = cut(measured(pairs.where("pivot = node_a").select("node_a", "node_b")).distinct())
    at = star.select(F.col("node_a").alias("pivot"), F.col("node_b").alias("node"), (1 - F.col("similarity")).alias("d"))
    inner = pairs.where("pivot <> node_a")
    inner = inner.join(at.toDF("pivot", "node_a", "da"), ["pivot", "node_a"], "left").join(at.toDF("pivot", "node_b", "db"), ["pivot", "node_b"], "left")
    inner = cut(inner.where("da IS NULL OR db IS NULL OR abs(da - db) <= %r" % (radius + 1e-9)).select("node_a", "node_b", F.coalesce(F.col("da") + F.col("db") <= radius, F.lit(False)).alias("sure")))
    rest = measured(inner.where("NOT sure").select("node_a", "node_b")).distinct()
    links = star.unionByName(rest).where(F.col("similarity") >= threshold - 1e-9)
    return links.unionByName(inner.where("sure").select("node_a", "node_b", F.lit(None).cast("double").alias("similarity"))), members


def record_pairs(links: DataFrame, members: DataFrame) -> DataFrame:
    """(id_a, id_b): the links of nodes carried to records, and the records of one node."""
    a = members.select(F.col("node").alias("node_a"), F.col("id").alias("x"))
    b = members.select(F.col("node").alias("node_b"), F.col("id").alias("y"))
    across = links.join(a, "node_a").join(b, "node_b").select("x", "y")
    many = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1").select("node")
    m = members.join(many, "node")
    same = m.select("node", F.col("id").alias("x")).join(m.select("node", F.col("id").alias("y")), "node").where("x < y").select("x", "y")
    return across.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def groups(links: DataFrame, members: DataFrame, max_rounds: int = 30) -> DataFrame:
    """(id, class_id, links): one row per record; class_id is the smallest record id of its
    connected group, links the number of different texts linked to it.

    Components by alternating large-star and small-star rounds until no edge changes; every
    round ends in a written table, nothing is collected but one count.
    """
    from .graph import components

    rep = members.groupBy("node").agg(F.min("id").alias("rep"))
    comp = components(links.select(F.col("node_a").alias("u"), F.col("node_b").alias("v")), max_rounds)
    named = rep.join(comp, rep["node"] == comp["v"], "left").select("node", F.coalesce("root", "node").alias("root"), "rep")
    least = named.groupBy("root").agg(F.min("rep").alias("class_id"))
    degree = links.select(F.explode(F.array("node_a", "node_b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    return (
        members.join(named.join(least, "root").select("node", "class_id"), "node")
        .join(degree, "node", "left")
        .select("id", "class_id", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    )
