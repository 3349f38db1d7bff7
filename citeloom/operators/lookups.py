"""Which titles can match: looked up by sets of words that few titles hold, not by one word.

A word that most titles hold meets them all, so pairs that share one word grow as the square of
the tables. Here a common word is only looked up together with the next ones a match shares.
All words have one order, rarest first. The words that a match shares, taken in it, make a key
as soon as few publications are expected to hold all of them; both sides list every key with
which they can still match, skipping words while what is left suffices. This is exact: the key
of a match is on both lists. Words that at most ``few`` publications hold are keys by themselves.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut

FEW = 8  # publications that hold a word which is a key by itself; more if MOST is passed
MOST = 500_000  # common words, sent to every task
DEEPEST, WIDTH = 3, 20  # words of a key, bits of each
SLOTS = 25  # bits of the number of slots that tell whether a publication may hold a key

Words = list[tuple[int, float, float, int]]  # common words of a title: index, ln share, mass, times


def keys(words: Words, goal: float, spare: float, stop: float) -> tuple[list[int], list[float]]:
    """Keys under which a title can match, and the mass it can share by each: what it shares
    weighs ``goal`` and leaves out at most ``spare`` words, repeats counted."""
    words = sorted(words)
    n = len(words)
    mass, times = [0.0] * (n + 1), [0] * (n + 1)
    for j in range(n - 1, -1, -1):
        mass[j], times[j] = mass[j + 1] + words[j][2], times[j + 1] + words[j][3]
    out: list[int] = []
    most: list[float] = []

    def go(at: int, key: int, depth: int, have: float, share: float, spare: float) -> None:
        for j in range(at, n):
            if spare < 0 or have + mass[j] < goal:
                return
            i, ln, m, k = words[j]
            longer = key << WIDTH | i + 1
            if depth == DEEPEST or share + ln <= stop:
                out.append(longer)
                most.append(have + mass[j])
            else:
                if have + m >= goal and times[j + 1] <= spare:  # it may share nothing else
                    out.append(longer)
                    most.append(have + m)
                go(j + 1, longer, depth + 1, have + m, share + ln, spare)
            spare -= k

    go(0, 0, 1, 0.0, 0.0, spare)
    return out, most


def slots(k: np.ndarray) -> np.ndarray:
    return (k.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - SLOTS)).astype(np.int64)


class Titles:
    """Publications (id, s) and asked titles (id, s); s holds a title's words between blanks.

    ``vocabulary``: (t, df, idf, top), one row per word of the publications, ``idf`` a function of
    ``df``. ``common`` maps a common word to (index, idf, ln share, top).
    """

    def __init__(self, pubs: DataFrame, asked: DataFrame, vocabulary: DataFrame, idf: Callable[[Column], Column], total: int, few: int = FEW, most: int = MOST) -> None:
        sizes = vocabulary.where(F.col("df") > few).groupBy(F.ceil(F.log2("df")).alias("b")).agg(F.count("*").alias("n")).collect()
        while sum(r.n for r in sizes if 2**r.b > few) > most:
            few *= 2
        rows = sorted(vocabulary.where(F.col("df") > few).collect(), key=lambda r: (r.df, r.t))
        self.stop = -float(np.log(max(total, 1)))
        self.common = {r.t: (i, r.idf, float(np.log(r.df / total)), r.top) for i, r in enumerate(rows)}
        self.held = pubs.sparkSession.sparkContext.broadcast(self.common)
        posts = self._rare(pubs).groupBy("t").agg(F.count("*").alias("df"), F.collect_list("id").alias("ps"))
        self.posts = cut(posts.select("t", idf(F.col("df")).alias("idf"), "ps"))
        self.pubs = cut(self._known(pubs).drop("near"))
        self.asked = cut(self._known(asked))

    def _rare(self, df: DataFrame) -> DataFrame:
        held = self.held

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            common = held.value
            for f in frames:
                got = [(i, t) for i, s in zip(f["id"], f["s"]) for t in set(s.split(" ")) if t and t not in common]
                yield pd.DataFrame(got, columns=["id", "t"])

        return df.mapInPandas(run, f"id {df.schema['id'].dataType.simpleString()}, t string")

    def _known(self, df: DataFrame) -> DataFrame:
        """With each title its rare words that publications hold, and these publications."""
        met = self._rare(df).join(self.posts, "t").groupBy("id").agg(F.collect_list("t").alias("ts"), F.collect_list("idf").alias("idfs"), F.array_distinct(F.flatten(F.collect_list("ps"))).alias("near"))
        return df.join(met, "id", "left")

    def pairs(self, of_pub: Callable, of_asked: Callable, shared: Callable[[Column, Column], Column]) -> DataFrame:
        """(q, p): titles that can match. ``of_pub`` and ``of_asked``: (words, known, common) of a
        title to the arguments of keys() and the mass of the whole title; ``shared``: whether
        the masses (as shares of the whole) that two titles can share suffice."""
        held, stop = self.held, self.stop

        def look(of: Callable, seen: object = None):
            def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                common = held.value
                for f in frames:
                    ids, ks, us = [], [], []
                    for i, s, ts, idfs in zip(f["id"], f["s"], f["ts"], f["idfs"]):
                        words, goal, spare, whole = of(Counter(s.split(" ")), known(ts, idfs), common)
                        k, u = keys(words, goal, spare, stop)
                        ids += [i] * len(k)
                        ks += k
                        us += [x / whole for x in u]
                    k = np.array(ks, np.int64)
                    out = pd.DataFrame({"id": np.array(ids, f["id"].dtype), "key": k, "u": np.array(us, np.float32), "slot": slots(k)})
                    if seen is not None:
                        at = out["slot"].to_numpy()
                        out = out[(seen.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
                    yield out

            return run

        def schema(df: DataFrame) -> str:
            return f"id {df.schema['id'].dataType.simpleString()}, key long, u float, slot long"

        theirs = cut(self.pubs.mapInPandas(look(of_pub), schema(self.pubs)))
        bits = theirs.groupBy(F.shiftright("slot", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("b")).toArrow()
        table = np.zeros(1 << SLOTS - 6, np.uint64)
        table[bits["w"].to_numpy()] = bits["b"].to_numpy().astype(np.int64).view(np.uint64)
        seen = self.pubs.sparkSession.sparkContext.broadcast(table)
        mine = self.asked.select("id", "s", "ts", "idfs").mapInPandas(look(of_asked, seen), schema(self.asked))
        met = mine.select(F.col("id").alias("q"), "key", F.col("u").alias("uq")).join(theirs.select(F.col("id").alias("p"), "key", "u"), "key").where(shared(F.col("uq"), F.col("u"))).select("q", "p")
        return met.unionByName(self.asked.select(F.col("id").alias("q"), F.explode("near").alias("p"))).distinct()

    def scored(self, pairs: DataFrame, score: Callable) -> DataFrame:
        """(q, p, score): ``score`` of the words and known rare words of both; None is left out."""
        held = self.held
        kinds = [self.asked.schema["id"].dataType.simpleString(), self.pubs.schema["id"].dataType.simpleString()]

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            common = held.value
            for f in frames:
                got = [score(Counter(s.split(" ")), known(ts, idfs), Counter(s2.split(" ")), known(ts2, idfs2), common) for s, ts, idfs, s2, ts2, idfs2 in zip(f["s"], f["ts"], f["idfs"], f["s2"], f["ts2"], f["idfs2"])]
                keep = np.fromiter((x is not None for x in got), bool, len(got))
                yield pd.DataFrame({"q": f["q"][keep], "p": f["p"][keep], "score": np.array([x for x in got if x is not None], float)})

        a = self.asked.select(F.col("id").alias("q"), "s", "ts", "idfs")
        b = self.pubs.select(F.col("id").alias("p"), F.col("s").alias("s2"), F.col("ts").alias("ts2"), F.col("idfs").alias("idfs2"))
        return pairs.join(b, "p").join(a, "q").mapInPandas(run, f"q {kinds[0]}, p {kinds[1]}, score double")


def known(ts: np.ndarray | None, idfs: np.ndarray | None) -> dict[str, float]:
    return {} if ts is None else dict(zip(ts, idfs))
