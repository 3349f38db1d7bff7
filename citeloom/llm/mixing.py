"""Problem 9: mixing sources to target weights along a curriculum.

Every source has a weight schedule over training time t in [0, 1]: its share, tilted early or
late. The integral of a schedule is the source's cumulative demand for tokens; inverting it
gives each document, whose cumulative tokens are known, its position in training. The
mixture is the documents sorted by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def demands(sized: DataFrame, targets: DataFrame, total: int | None = None) -> DataFrame:
    """(source, target_share, max_repeats, have, want, tilt): one row per target.

    have: tokens of the source's documents. ``total``: tokens of the mixture, by default
    those of all documents. Sources that run out within their repeats hand their shortfall
    to the others in proportion (water filling); so do sources without tokens. Total 0 asks
    for the largest mixture in which every source with tokens keeps its share exactly. tilt in [-1, 1]: scarce sources
    (more repeats needed) come later; tilts balance, so the weights sum to 1 at any time.
    """
    have = sized.groupBy("source").agg(F.sum("tokens").alias("have"))
    if total is None:
        total = sized.agg(F.sum("tokens")).first()[0] or 0
    rows = (
        targets.where("source IS NOT NULL")
        .groupBy("source")
        .agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
        .join(have, "source", "left")
        .orderBy("source")
        .toPandas()  # one row per target: a stated, small table
    )
    rows["have"] = rows["have"].fillna(0).astype("int64")
    rows["target_share"] = rows["target_share"].fillna(0.0).clip(lower=0.0)
    rows["max_repeats"] = rows["max_repeats"].fillna(1).clip(lower=0).astype("int64")
    cap = (rows["have"] * rows["max_repeats"]).astype(float)
    live = (cap > 0) & (rows["target_share"] > 0)
    rows["want"] = 0.0
    if live.any():
        share = rows["target_share"].where(live, 0.0)
        share = share / share.sum()
        size = float(min(total, cap[live].sum())) if total else float((cap[live] / share[live]).min())
        open_, want = live.copy(), rows["want"].copy()
        while open_.any():
            give = (size - want[~open_].sum()) * share.where(open_, 0.0) / share[open_].sum()
            full = open_ & (give >= cap - 1e-9)
            if not full.any():
                want[open_] = give[open_]
                break
            want[full] = cap[full]
            open_ &= ~full
        rows["want"] = want
    rows["epochs"] = (rows["want"] / rows["have"].where(rows["have"] > 0)).fillna(0.0)
    w = rows["want"]
    mean = (rows["epochs"] * w).sum() / w.sum() if w.sum() else 0.0
    tilt = rows["epochs"] - mean
    rows["tilt"] = (tilt / tilt.abs().max()).fillna(0.0) * 0.8 if len(rows) and tilt.abs().max() else 0.0
    schema = "source string, target_share double, max_repeats long, have long, want double, epochs double, tilt double"
    return sized.sparkSession.createDataFrame(rows[["source", "target_share", "max_repeats", "have", "want", "epochs", "tilt"]], schema)


def mixture(sized: DataFrame, targets: DataFrame, total: int | None = None, buckets: int = 256) -> DataFrame:
    """(doc_id, source, use, tokens, position): every use of a document, in training order.

    sized: doc_id, source, tokens. Documents of sources without a target, and documents
    without tokens, are not used. Cumulative tokens run over hash buckets of each
    source, so a source with a third of all rows is summed by many tasks.
    """
    want = F.broadcast(demands(sized, targets, total).where("want > 0"))  # one row per target
    d = sized.where("tokens > 0 AND doc_id IS NOT NULL").select("doc_id", "source", "tokens").withColumn("h", F.xxhash64(F.lit("order"), "doc_id")).withColumn("b", F.pmod(F.shiftrightunsigned("h", 40), F.lit(buckets)).cast("int"))
    d = d.join(want, "source")
    sums = d.groupBy("source", "b").agg(F.sum("tokens").alias("s"))  # targets x buckets rows
    before = sums.withColumn("base", F.sum("s").over(Window.partitionBy("source").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)))
    inner = Window.partitionBy("source", "b").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = d.withColumn("cum", F.sum("tokens").over(inner)).join(F.broadcast(before.select("source", "b", F.coalesce("base", F.lit(0)).alias("base"))), ["source", "b"])
    d = d.withColumn("end", F.col("base") + F.col("cum"))
    # Use r of a document has its middle at end - tokens / 2 + (r - 1) * have tokens of its
    # source; it is taken while that is within the demand, so shares round to the nearest document.
    last = F.floor((F.col("want") + 1e-6 - F.col("end") + F.col("tokens") / 2) / F.col("have")) + 1
    d = d.withColumn("uses", F.least(F.col("max_repeats"), last).cast("int")).where("uses >= 1").withColumn("use", F.explode(F.sequence(F.lit(1), F.col("uses"))))
    u = (F.col("end") - F.col("tokens") / 2 + (F.col("use") - 1) * F.col("have")) / F.col("want")
    # Weight share * (1 + tilt * (2t - 1)): cumulative share t + tilt * (t^2 - t); solve for t.
    a, b = F.col("tilt"), 1 - F.col("tilt")
    t = F.when(F.abs(a) < 1e-9, u).otherwise(2 * u / (b + F.sqrt(b * b + 4 * a * u)))
    return d.select("doc_id", "source", "use", "tokens", F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), t)), 9).alias("position")).orderBy("position", "doc_id", "use")


def shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, documents, most_uses) for every target."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.countDistinct("doc_id").alias("documents"), F.max("use").alias("most_uses"))
    all_ = got.agg(F.sum("tokens").alias("_all"))
    one = targets.where("source IS NOT NULL").groupBy("source").agg(F.max("target_share").alias("target_share"))
    return (
        one.join(got, "source", "left")
        .join(F.broadcast(all_))
        .select("source", "target_share", F.round(F.coalesce(F.col("tokens") / F.col("_all"), F.lit(0.0)), 6).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"))
    )
