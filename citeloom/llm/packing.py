"""Problem 8: filling containers of a fixed capacity.

Items are dealt by hash into windows of a set number of containers; in each window the
Karmarkar-Karp multiway differencing method combines the two partial partitions with the
largest imbalance, largest part to smallest, which leaves nearly equal containers. Swaps of
items relieve those above the capacity; while they can't, the number of containers rises.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(container of every item, sums of the k containers), nearly equal sums."""
    n = len(sizes)
    if k == 1 or n <= k:
        where = np.arange(n) % k
        return where, np.bincount(where, sizes, k).astype(np.int64)
    sums: list = list(sizes)  # an item alone stays a number until it is combined
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)

    def parts(c: int) -> np.ndarray:
        if c >= n:
            return sums[c]
        v = np.zeros(k, np.int64)
        v[0] = sums[c]
        return v

    tree: dict[int, tuple[int, int, np.ndarray]] = {}
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        v = parts(a) + parts(b)[::-1]  # both fall, so the largest meets the smallest
        order = np.argsort(-v, kind="stable")
        v = v[order]
        c = len(sums)
        sums.append(v)
        sums[a] = sums[b] = None
        tree[c] = (a, b, order)
        heapq.heappush(heap, (int(v[-1] - v[0]), c))
    root = heap[0][1]
    where = np.zeros(n, np.int64)
    stack = [(root, np.arange(k))]
    while stack:
        c, slot = stack.pop()  # slot[j]: final container of part j
        if c < n:
            where[c] = slot[0]
            continue
        a, b, order = tree[c]
        back = np.empty(k, np.int64)
        back[order] = slot
        stack += [(a, back), (b, back[::-1])]
    return where, sums[root]


def least_containers(sizes: np.ndarray, capacity: int) -> int:
    """A lower bound: items above half the capacity need containers of their own, and what is
    too large to stand beside them needs more."""
    best = max(1, -(-int(sizes.sum()) // capacity))
    small = np.unique(sizes[(sizes * 2 <= capacity) & (sizes > 0)])
    for t in np.append(small[:: max(1, len(small) // 64)], 0) if len(small) else [0]:
        wide, half = sizes > capacity - t, sizes * 2 > capacity
        middle = half & ~wide
        rest = int(sizes[(sizes >= t) & ~half].sum()) - (int(middle.sum()) * capacity - int(sizes[middle].sum()))
        best = max(best, int(half.sum()) + max(0, -(-rest // capacity)))
    return best


def relieved(sizes: np.ndarray, where: np.ndarray, sums: np.ndarray, capacity: int) -> int:
    """Swap items between containers, in place, until none is too full; the excess left.

    The fullest container gives an item for a smaller one (or for none) of a container with
    room for the difference: the least difference that relieves it, else the greatest. Every
    swap lowers the excess, so this ends.
    """
    k = len(sums)
    while True:
        c = int(sums.argmax())
        over = int(sums[c]) - capacity
        if over <= 0:
            return 0
        mine = np.flatnonzero(where == c)
        others = np.flatnonzero(sums[where] < capacity)
        room = capacity - sums
        # an item for nothing: one empty place per container
        gain = np.concatenate([sizes[others], np.zeros(k, np.int64)])
        at = np.concatenate([where[others], np.arange(k)])
        d = sizes[mine][:, None] - gain[None, :]
        ok = (d > 0) & (d <= room[at][None, :])
        if not ok.any():
            return int(np.maximum(sums - capacity, 0).sum())
        full = ok & (d >= over)
        pick = np.where(full, d, 1 << 60).argmin() if full.any() else np.where(ok, d, -1).argmax()
        i, j = np.unravel_index(pick, d.shape)
        step, to = int(d[i, j]), int(at[j])
        if j < len(others):
            where[others[j]] = c
        where[mine[i]] = to
        sums[c] -= step
        sums[to] += step


def fill(sizes: list[int], capacity: int) -> np.ndarray:
    """Container number of every item; no item exceeds the capacity, no container does. The
    number of containers starts at a lower bound and rises while swaps can't relieve them."""
    x = np.asarray(sizes, np.int64)
    k = least_containers(x, capacity)
    while True:
        where, sums = differencing(sizes, k)
        left = relieved(x, where, sums, capacity)
        if not left:
            return where
        k += max(1, left // capacity)


def pack(sized: DataFrame, sizes: DataFrame, id_col: str = "doc_id", window: int = 256, items: int = 20_000) -> DataFrame:
    """(pack_id, container_id, doc_id, piece, first_token, tokens) for every capacity.

    sized: one row per document with its tokens; sizes: pack_id and capacity_tokens, a small
    fixed table. A document above the capacity is cut into full pieces, each a container of
    its own, and a rest that is packed like other documents. Documents without tokens are
    packed too; a window holds at most about ``items`` documents. Null capacities and capacities below 1 make no containers. ``window``
    is the number of containers that are filled together; it bounds a task's memory.
    """
    caps = sizes.where("capacity_tokens >= 1 AND pack_id IS NOT NULL").select("pack_id", "capacity_tokens").distinct().orderBy("pack_id", "capacity_tokens").collect()
    kinds = F.array(*[F.struct(F.lit(r[0]).cast("int").alias("pack_id"), F.lit(r[1]).cast("long").alias("cap")) for r in caps]) if caps else F.expr("CAST(array() AS array<struct<pack_id:int,cap:bigint>>)")
    docs = sized.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.coalesce("tokens", F.lit(0)).cast("long").alias("n"))
    each = docs.select("doc_id", "n", F.explode(kinds).alias("k")).select("doc_id", "n", "k.pack_id", "k.cap")
    each = each.withColumn("full", F.when(F.col("n") > F.col("cap"), F.floor((F.col("n")) / F.col("cap"))).otherwise(F.lit(0)).cast("int"))
    each = each.withColumn("rest", F.col("n") - F.col("full") * F.col("cap"))
    whole = each.where("full > 0").select("pack_id", "doc_id", F.explode(F.sequence(F.lit(1), F.col("full"))).alias("piece"), "cap").select(
        "pack_id", F.format_string("d%d-%d", "doc_id", "piece").alias("container_id"), "doc_id", "piece", ((F.col("piece") - 1) * F.col("cap")).alias("first_token"), F.col("cap").alias("tokens")
    )
    rests = each.where("full = 0 OR rest > 0").select("pack_id", "doc_id", (F.col("full") + 1).alias("piece"), F.col("full") * F.col("cap"), "rest", "cap").toDF("pack_id", "doc_id", "piece", "first_token", "tokens", "cap")
    load = rests.groupBy("pack_id").agg(F.greatest(F.lit(1), F.round(F.sum("tokens") / (F.first("cap") * window)), F.ceil(F.count("*") / items)).cast("long").alias("w"))
    placed = rests.join(F.broadcast(load), "pack_id").withColumn("win", F.pmod(F.xxhash64("doc_id", "pack_id"), F.col("w")))

    def run(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(["tokens", "doc_id"], ascending=[False, True])
        where = fill(f["tokens"].tolist(), int(f["cap"].iloc[0]))
        f["container_id"] = [f"w{key[1]}-{i}" for i in where]
        return f[["pack_id", "container_id", "doc_id", "piece", "first_token", "tokens"]]

    out = "pack_id int, container_id string, doc_id long, piece int, first_token long, tokens long"
    packed = placed.groupBy("pack_id", "win").applyInPandas(run, out)
    return packed.unionByName(whole.select(F.col("pack_id").cast("int"), "container_id", "doc_id", F.col("piece").cast("int"), "first_token", "tokens"))


def fill_report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """One row per capacity: containers, documents, split documents, tokens and unused share."""
    per = packed.groupBy("pack_id").agg(
        F.countDistinct("container_id").alias("containers"),
        F.countDistinct("doc_id").alias("documents"),
        F.sum("tokens").alias("tokens"),
        F.countDistinct(F.when(F.col("piece") > 1, F.col("doc_id"))).alias("split_documents"),
    )
    caps = sizes.select("pack_id", "capacity_tokens").distinct()
    return per.join(F.broadcast(caps), "pack_id").withColumn("unused_share", F.round(1 - F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6))
