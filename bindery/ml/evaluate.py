"""Thresholds, results and figures of scored rows, as aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_thresholds(scored: DataFrame, score: str = "score", label: str = "label", group: str = "field", least: float = 0.1, most: float = 0.95) -> DataFrame:
    """(group, threshold, f1): the score with the best F1 per group, within [least, most]; 0.5 without positives.

    Equal scores are counted together first, so a group's window runs over distinct
    scores (round them for a bound); the threshold is the score of the point itself.
    """
    points = scored.groupBy(group, score).agg(F.sum(label).alias("_p"), F.count(F.lit(1)).alias("_n"))
    down = Window.partitionBy(group).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(group)
    run = points.select(group, score, F.sum("_p").over(down).alias("tp"), F.sum("_n").over(down).alias("n"), F.sum("_p").over(whole).alias("all"))
    f1 = F.coalesce(F.try_divide(2.0 * F.col("tp"), F.col("n") + F.col("all")), F.lit(0.0))
    best = run.withColumn("f1", f1).groupBy(group).agg(F.max(F.struct("f1", F.col(score).alias("s"))).alias("b"), F.max("all").alias("all"))
    clamped = F.greatest(F.least(F.col("b.s"), F.lit(most)), F.lit(least))
    return best.select(group, F.when(F.col("all") > 0, clamped).otherwise(0.5).alias("threshold"), F.when(F.col("all") > 0, F.col("b.f1")).otherwise(0.0).alias("f1"))


def confusion(scored: DataFrame, predicted: Column, actual: Column, group: str) -> DataFrame:
    """(group, tp, fp, fn, tn, accuracy, precision, recall, f1); figures without a base are 0."""
    counts = scored.groupBy(group).agg(
        F.count_if(predicted & actual).alias("tp"), F.count_if(predicted & ~actual).alias("fp"), F.count_if(~predicted & actual).alias("fn"), F.count_if(~predicted & ~actual).alias("tn")
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a * 1.0, b), F.lit(0.0))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts.select("*", ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"), ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"), ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def exact_match(scored: DataFrame, predicted: str, actual: str) -> DataFrame:
    return scored.agg(F.avg((F.col(predicted) == F.col(actual)).cast("double")).alias("exact_match"))


def argmax(rows: DataFrame, key: str, score: str, place: str, least: Column | None = None, strict: bool = True) -> DataFrame:
    """One row per key: the greatest score above `least` (strictly, if `strict`); ties go to the first place."""
    kept = rows if least is None else rows.filter(F.col(score) > least if strict else F.col(score) >= least)
    rest = [c for c in rows.columns if c != key]
    best = kept.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(F.col(score), -F.col(place))).alias("r"))
    return best.select(key, "r.*")


def ranked(rows: DataFrame, key: str, score: str, place: str, least: Column, strict: bool = True) -> DataFrame:
    """All rows of a key above `least` as an array, best first, in place order among equals: (key, items)."""
    kept = rows.filter(F.col(score) > least if strict else F.col(score) >= least)
    rest = [c for c in rows.columns if c not in (key, score, place)]
    item = F.struct((-F.col(score)).alias("s"), F.col(place).alias("i"), *rest)
    return kept.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(*((-x["s"]).alias(score), *(x[c].alias(c) for c in rest)))).alias("items"))


def tally(rows: DataFrame, field: str, verdict: Column) -> DataFrame:
    """(field, n_match, n_mismatch, n_miss, percent) of verdicts 'ok', 'partial' or 'mismatch', 'miss'."""
    told = rows.withColumn("_v", verdict)
    counts = told.groupBy(field).agg(F.count_if(F.col("_v") == "ok").alias("n_match"), F.count_if(F.col("_v").isin("partial", "mismatch")).alias("n_mismatch"), F.count_if(F.col("_v") == "miss").alias("n_miss"))
    return counts.withColumn("percent", F.coalesce(F.try_divide(F.col("n_match") * 100.0, F.col("n_match") + F.col("n_mismatch") + F.col("n_miss")), F.lit(0.0)))
