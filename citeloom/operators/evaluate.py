"""Scores of each stage against labelled data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """(label, precision, recall, f1, support) per class; undefined ratios are 0. Rows with a
    null side are left out. One aggregation over the pair counts, whatever the rows."""
    pairs = df.where(F.col(actual).isNotNull() & F.col(predicted).isNotNull()).groupBy(F.col(actual).alias("a"), F.col(predicted).alias("p")).agg(F.count("*").alias("n"))
    each = pairs.select(F.explode(F.array(F.struct(F.col("a").alias("label"), F.col("n").alias("sup"), F.lit(0).cast("long").alias("pre"), F.when(F.expr("a = p"), F.col("n")).otherwise(F.lit(0).cast("long")).alias("tp")), F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("sup"), F.col("n").alias("pre"), F.lit(0).cast("long").alias("tp")))).alias("e")).select("e.*")
    g = each.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("sup").alias("support"), F.sum("pre").alias("found"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    p, r = ratio(F.col("tp"), F.col("found")), ratio(F.col("tp"), F.col("support"))
    return g.select("label", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(ratio(2.0 * F.col("tp"), F.col("found") + F.col("support")), 6).alias("f1"), "support")


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def accuracy_by(df: DataFrame, group: str | list[str], item: str, actual: str, predicted: str) -> DataFrame:
    """Per group (of one or several columns) and for all ('all' in the first): items, items with
    an actual value, their share, micro F1. Rows with a null group column are left out."""
    by = [group] if isinstance(group, str) else group
    has = F.when(F.col(actual).isNotNull() & (F.col(actual) != ""), F.col(item))
    sums = [F.countDistinct(item).alias("items"), F.countDistinct(has).alias("with_actual"), F.round(F.avg((F.col(actual) == F.col(predicted)).cast("double")), 6).alias("f1")]
    known = df.dropna(subset=by)
    out = known.groupBy(*by).agg(*sums) if len(by) > 1 else known.rollup(*by).agg(F.grouping(by[0]).alias("_g"), *sums).select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col(by[0])).alias(by[0]), "items", "with_actual", "f1")
    return out.select(*by, "items", "with_actual", F.round(F.col("with_actual") / F.col("items"), 6).alias("share"), "f1")


def accuracy_of_columns(df: DataFrame, pairs: dict[str, tuple[str, str]], lenient: float) -> DataFrame:
    """(component, n, filled, strict, lenient, distance) for every component {name: (actual,
    predicted)} and for all of them ('all'): rows, rows with an actual value, shares of equal
    and of nearly equal values, mean edit share; halves round to the even digit. Null is ''.
    """
    from ..functions.text import blank, edit_distance_or_zero, half_even

    each = F.explode(F.array(*[F.struct(F.lit(k).alias("component"), blank(F.col(a)).alias("a"), blank(F.col(p)).alias("p")) for k, (a, p) in pairs.items()])).alias("e")
    x = df.select(each).select("e.*").withColumn("d", edit_distance_or_zero(F.col("a"), F.col("p")))
    per = x.rollup("component").agg(
        F.grouping("component").alias("_g"), F.count("*").alias("n"), F.sum((F.col("a") != "").cast("long")).alias("filled"),
        half_even(F.avg((F.col("a") == F.col("p")).cast("double"))).alias("strict"), half_even(F.avg((F.col("d") < lenient).cast("double"))).alias("lenient"), half_even(F.avg("d")).alias("distance"),
    )
    return per.select(F.when(F.col("_g") == 1, "all").otherwise(F.col("component")).alias("component"), "n", "filled", "strict", "lenient", "distance")


def binary_scores(df: DataFrame, positive: str, predicted: str) -> DataFrame:
    """One row: recall of the negative class, precision of the positive class, micro F1."""
    s = lambda c: F.sum(F.when(c, 1).otherwise(0))
    a, p = F.col(positive), F.col(predicted)
    d = lambda x, y: F.bround(F.coalesce(F.try_divide(x, y), F.lit(0.0)), 3)
    return df.agg(d(s(~a & ~p), s(~a)).alias("negative_recall"), d(s(a & p), s(p)).alias("positive_precision"), d(s(a == p), F.count("*")).alias("f1"))


def pair_scores(gold: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """One row: pairs in both, only found, only gold, precision, recall, f1."""
    j = gold.select(*keys).distinct().withColumn("_g", F.lit(1)).join(found.select(*keys).distinct().withColumn("_f", F.lit(1)), keys, "full")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).alias
    g, f = F.col("_g").isNotNull(), F.col("_f").isNotNull()
    s = j.agg(n(g & f)("both"), n(f & ~g)("only_found"), n(g & ~f)("only_gold"))
    d = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    both = F.coalesce("both", F.lit(0))
    return s.select(both.alias("both"), F.coalesce("only_found", F.lit(0)).alias("only_found"), F.coalesce("only_gold", F.lit(0)).alias("only_gold"), d(F.col("both"), F.col("both") + F.col("only_found")).alias("precision"), d(F.col("both"), F.col("both") + F.col("only_gold")).alias("recall"), d(2 * F.col("both"), 2 * F.col("both") + F.col("only_found") + F.col("only_gold")).alias("f1"))


def match_outcome(actual: Column, predicted: Column) -> Column:
    """Outcome of one match: correct, incorrect or none, expected or not."""
    return (
        F.when(actual.isNotNull() & (actual == predicted), "Correct match")
        .when(actual.isNotNull() & predicted.isNotNull(), "Incorrect match")
        .when(actual.isNotNull(), "No match, expected one")
        .when(predicted.isNotNull(), "Match, expected none")
        .otherwise("No match, expected none")
    )


def threshold_grid(df: DataFrame, similarity: str, length: str, positive: str, sims: list[float], lengths: list[int]) -> DataFrame:
    """(sim_over, len_over, tp, fp, fn, precision, recall) for every pair of thresholds.

    Rows are counted once per cell of the grid they fall in; the cells, not the rows, are
    compared with the thresholds.
    """
    def cell(c: str, cuts: list) -> Column:
        return F.aggregate(F.array(*[F.lit(x) for x in cuts]), F.lit(0), lambda a, t: a + (F.col(c) > t).cast("int"))

    per = df.groupBy(cell(similarity, sims).alias("i"), cell(length, lengths).alias("j"), F.col(positive).alias("pos")).agg(F.count("*").alias("n"))
    at = F.explode(F.array(*[F.struct(F.lit(a).alias("sim_over"), F.lit(b).alias("len_over"), F.lit(i).alias("si"), F.lit(j).alias("lj")) for i, a in enumerate(sims) for j, b in enumerate(lengths)])).alias("t")
    x = per.select("*", at).withColumn("yes", (F.col("i") > F.col("t.si")) & (F.col("j") > F.col("t.lj")))
    s = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0)).cast("long")
    g = x.groupBy("t.sim_over", "t.len_over").agg(s(F.col("yes") & F.col("pos")).alias("tp"), s(F.col("yes") & ~F.col("pos")).alias("fp"), s(~F.col("yes") & F.col("pos")).alias("fn"))
    d = lambda a, b: F.round(F.coalesce(F.try_divide(a, b), F.lit(0.0)), 6)
    return g.select("*", d(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), d(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
