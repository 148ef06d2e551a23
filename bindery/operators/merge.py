"""Keyed merges of a delta into a base table, as plans; nothing is written here.

A merge never shuffles on a surrogate: both sides meet on the natural key. A delta
within a counted bound is broadcast, so the base is not shuffled at all. It is
written once first: what makes it does not run again to be counted and used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.runtime import bounded_broadcast, cut


def last_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last in `order`. Ties beyond `order` go to the greatest whole row, so the result is stable.

    An aggregate, not a window: rows meet on the map side first, so a hot key is no hot task.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_m"))
    return best.select(*keys, "_m.*").select(*df.columns)


def first_wins(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the first in `order`; ties go to the least whole row."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_m"))
    return best.select(*keys, "_m.*").select(*df.columns)


def keep_greatest_id(df: DataFrame, keys: list[str], id_column: str) -> DataFrame:
    """Of rows with one key the one with the greatest id."""
    return last_wins(df, keys, [id_column])


def upsert(base: DataFrame, delta: DataFrame, keys: list[str], preserve: bool = False) -> DataFrame:
    """Rows of `delta` replace those of `base` with the same key; new ones are added.

    Keys of `delta` must be distinct (see last_wins). The new row counts whole, with
    its nulls; with `preserve` nulls keep the old values. A null key matches nothing.
    """
    if not preserve:
        delta = cut(delta)
        kept = base.join(bounded_broadcast(delta.select(*keys)), keys, "left_anti")
        return kept.unionByName(delta, allowMissingColumns=True)
    old = base.select(*keys, F.struct(*(c for c in base.columns if c not in keys)).alias("_old"))
    new = delta.select(*keys, F.struct(*(c for c in delta.columns if c not in keys)).alias("_new"))
    value = lambda c: F.coalesce(*([F.col(f"_new.{c}")] if c in delta.columns else []), F.col(f"_old.{c}")).alias(c)
    return old.join(new, keys, "full_outer").select(*keys, *(value(c) for c in base.columns if c not in keys))


def upsert_counts(base: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """(n_new, n_updated) of an upsert."""
    known = base.select(*keys).distinct().withColumn("_old", F.lit(True))
    joined = delta.select(*keys).join(known, keys, "left")
    return joined.agg(F.count_if(F.col("_old").isNull()).alias("n_new"), F.count_if(F.col("_old").isNotNull()).alias("n_updated"))


def replace_sets(base: DataFrame, delta: DataFrame, owner: str, owners: DataFrame | None = None) -> DataFrame:
    """The members of every owner in `owners` (those of `delta` if not given) become those of `delta`.

    Owners in `owners` without rows in `delta` lose all. Repeated rows count once.
    """
    touched = cut((delta if owners is None else owners).select(owner).distinct())
    return base.join(bounded_broadcast(touched), owner, "left_anti").unionByName(delta.dropDuplicates())


def changed_sets(base: DataFrame, delta: DataFrame, owner: str, member: str, owners: DataFrame | None = None) -> DataFrame:
    """(owner): owners in `owners` (those of `delta` if not given) whose distinct members in `delta` differ from those in `base`; no members equal no members."""
    of = lambda df, name: df.groupBy(owner).agg(F.sort_array(F.collect_set(member)).alias(name))
    asked = of(delta, "_new") if owners is None else owners.select(owner).distinct().join(of(delta, "_new"), owner, "left")
    none = F.array().cast(asked.schema["_new"].dataType)
    differ = ~F.coalesce("_new", none).eqNullSafe(F.coalesce("_old", none))
    return asked.join(of(base, "_old"), owner, "left").filter(differ).select(owner)


def monotone(base: DataFrame, delta: DataFrame, key: str, column: str) -> DataFrame:
    """`base` with `column` raised to the delta's greatest value of the key where that is greater or the old one is null."""
    new = cut(delta.groupBy(key).agg(F.max(column).alias("_new")))
    joined = base.join(bounded_broadcast(new), key, "left")
    return joined.withColumn(column, F.when(raised(F.col(column), F.col("_new")), F.col("_new")).otherwise(F.col(column))).select(*base.columns)


def raised(old: Column, new: Column) -> Column:
    return new.isNotNull() & (old.isNull() | (old < new))


def monotone_count(base: DataFrame, delta: DataFrame, key: str, column: str) -> DataFrame:
    """(n_affected): rows that `monotone` changes."""
    new = cut(delta.groupBy(key).agg(F.max(column).alias("_new")))
    return base.join(bounded_broadcast(new), key).agg(F.count_if(raised(F.col(column), F.col("_new"))).alias("n_affected"))


def cascade(children: DataFrame, deleted: DataFrame, foreign: str, key: str) -> DataFrame:
    """Children whose parent is not among `deleted`."""
    return children.join(bounded_broadcast(cut(deleted.select(F.col(key).alias(foreign)).distinct())), foreign, "left_anti")


def with_ids(df: DataFrame, base_max: int, natural: list[str], id_column: str = "id") -> DataFrame:
    """Rows with surrogate ids base_max + 1, ... in the order of the natural key, the same on every run.

    Rows are range-partitioned by the key and numbered within each partition; the
    partitions' offsets come from their counts. No single task sorts everything.
    """
    spread = df.repartitionByRange(*(F.col(c) for c in natural)).sortWithinPartitions(*natural).withColumn("_p", F.spark_partition_id())
    spread = cut(spread.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*natural))))
    counts = spread.groupBy("_p").agg(F.count(F.lit(1)).alias("_c"))
    # One row per partition.
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return spread.join(F.broadcast(offsets), "_p").select((F.lit(base_max) + F.col("_before") + F.col("_n")).cast("long").alias(id_column), *df.columns)
