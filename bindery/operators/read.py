"""Read side: latest series, children per parent, nested details, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, n: int, by: str = "id") -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(n)


def top_children(children: DataFrame, parent: str, by: str, n: int, tie: str = "id") -> DataFrame:
    """The n greatest children of each parent, with their rank.

    Spark limits each parent to n rows before the shuffle (window group limit, for
    n up to spark.sql.optimizer.windowGroupLimitThreshold), so a parent with a
    third of all children sends no more than n rows from each map task.
    """
    window = Window.partitionBy(parent).orderBy(F.col(by).desc(), F.col(tie).asc())
    return children.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def detail(parents: DataFrame, children: DataFrame, bridge: DataFrame, limit: int, key: str = "id", foreign: str = "komik_id", number: str = "chapter_number", member: str = "genre_id") -> DataFrame:
    """Parents with genre_ids (ascending) and their `limit` latest children (descending), empty arrays if none."""
    tops = top_children(children, foreign, number, limit).groupBy(foreign).agg(F.sort_array(F.collect_list(F.struct("rank", number))).alias("_c"))
    sets = bridge.groupBy(foreign).agg(F.sort_array(F.collect_set(member)).alias("genre_ids"))
    joined = parents.join(tops, parents[key] == tops[foreign], "left").drop(foreign).join(sets, parents[key] == sets[foreign], "left").drop(foreign)
    numbers = F.transform(F.coalesce("_c", F.array()), lambda c: c[number])
    return joined.withColumn("latest", F.when(F.col("_c").isNull(), F.array().cast("array<double>")).otherwise(numbers)).withColumn("genre_ids", F.coalesce("genre_ids", F.array().cast("array<smallint>"))).drop("_c")


def modes(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value, n): the most frequent value of each group; ties go to the smallest."""
    counted = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    best = counted.groupBy(group).agg(F.max_by(F.struct(value, "n"), F.struct(F.col("n"), (-F.col(value)).alias("v"))).alias("b"))
    return best.select(group, F.col(f"b.{value}").alias(value), F.col("b.n").alias("n"))


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row with the number of rows of each table, in columns of the given names."""
    ones = [df.agg(F.count(F.lit(1)).alias(name)) for name, df in tables.items()]
    row = ones[0]
    for one in ones[1:]:
        row = row.join(F.broadcast(one))
    return row


def value_map(df: DataFrame, key: str, value: str, to: str, id_column: str = "id") -> DataFrame:
    """(id, key, to): the stored value of every key; only these columns are read."""
    return df.select(id_column, key, F.col(value).alias(to))


def lookup(df: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key; the filter reaches the scan. A null value finds nothing."""
    return df.filter(F.col(key) == F.lit(value))


def members(bridge: DataFrame, known: DataFrame, owner: str, member: str, to: str) -> DataFrame:
    """(member, to): how many distinct owners each known member has; members without any are left out."""
    pairs = bridge.select(owner, member).distinct()
    return pairs.join(known.select(member).distinct(), member).groupBy(member).agg(F.count(F.lit(1)).alias(to))


def last_row(df: DataFrame, *by: str) -> DataFrame:
    """The greatest row by some columns."""
    return df.orderBy(*(F.col(c).desc() for c in by)).limit(1)


def throughput(n: DataFrame, done: str, seconds: str, total: str) -> DataFrame:
    """per_minute, percent and seconds left; 0 where a rate is unknown."""
    rate = F.coalesce(F.try_divide(F.col(done) * 60.0, F.col(seconds)), F.lit(0.0))
    return n.select(
        "*",
        rate.alias("per_minute"),
        F.coalesce(F.try_divide(F.col(done) * 100.0, F.col(total)), F.lit(0.0)).alias("percent"),
        F.coalesce(F.try_divide((F.col(total) - F.col(done)) * 60.0, rate), F.lit(0.0)).alias("seconds_left"),
    )
