"""Change detection on a paginated feed of latest updates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bindery.functions.scalars import gap
from bindery.runtime import bounded_broadcast, cut


def classify(feed: DataFrame, stored: DataFrame, fallback: DataFrame | None = None, key: str = "slug", value: str = "latest", item: str = "number") -> DataFrame:
    """`feed` with stored_latest, action ('new', 'skipped', 'updated') and gap.

    A key without stored value is new; so is a key stored with null, which does
    not ask `fallback`. `fallback` counts only for keys that `stored` lacks. Stored keys must be distinct.
    """
    known = stored.select(key, F.col(value).alias("_s"), F.lit(True).alias("_there"))
    joined = feed.join(known, key, "left")
    latest = F.col("_s")
    if fallback is not None:
        joined = joined.join(fallback.select(key, F.col(value).alias("_f")), key, "left")
        latest = F.when(F.col("_there"), F.col("_s")).otherwise(F.col("_f"))
    told = joined.withColumn("stored_latest", latest)
    action = F.when(F.col("stored_latest").isNull(), "new").when(F.col(item) <= F.col("stored_latest"), "skipped").otherwise("updated")
    return told.select(*feed.columns, "stored_latest", action.alias("action"), F.when(action == "updated", gap(F.col(item), F.col("stored_latest"))).alias("gap"))


def action_counts(classified: DataFrame) -> DataFrame:
    return classified.agg(*(F.count_if(F.col("action") == a).alias(f"n_{a}") for a in ("new", "updated", "skipped")))


def until_old(items: DataFrame, most_minutes: int, page: str = "page", place: str = "place", age: str = "minutes") -> DataFrame:
    """Items of the pages up to the first whose last item is too old; of that page only the young ones.

    A missing (empty) page ends the feed too. Items are aggregated once to a row per
    page, which is written; these rows (as many as the feed has pages) are ranked in
    one task and joined back.
    """
    pages = cut(items.groupBy(page).agg(F.max_by(age, place).alias("_last")))
    ranked = pages.withColumn("_i", F.row_number().over(Window.orderBy(page)))
    first = ranked.agg(F.min(page).alias("_first"), F.min(F.when(F.col("_last") >= most_minutes, F.col(page))).alias("_cut")).select("_first", "_cut")
    bounds = ranked.join(F.broadcast(first))
    open_ = bounds.filter((F.col(page) - F.col("_first") + 1 == F.col("_i")) & (F.col("_cut").isNull() | (F.col(page) <= F.col("_cut")))).select(page, (F.col(page) == F.coalesce("_cut", F.lit(-1))).alias("_cuts"))
    return items.join(bounded_broadcast(open_), page).filter(~F.col("_cuts") | (F.col(age) < most_minutes)).select(*items.columns)


def resume(listed: DataFrame, done: DataFrame, key: str = "slug") -> DataFrame:
    """What is listed and not done."""
    return listed.join(done.select(key).distinct(), key, "left_anti")


def limited(listed: DataFrame, n: int, order: str) -> DataFrame:
    """The first n in order; 0 means all."""
    return listed.orderBy(order).limit(n) if n else listed


def after(listed: DataFrame, last: str | None, key: str, place: str) -> DataFrame:
    """What stands behind the last place of `last`; everything if it is not listed."""
    if last is None:
        return listed
    at = listed.filter(F.col(key) == last).agg(F.max(place).alias("_at"))
    return listed.join(F.broadcast(at)).filter(F.col("_at").isNull() | (F.col(place) > F.col("_at"))).select(*listed.columns)


def skipped(listed: DataFrame, n: int, order: str) -> DataFrame:
    return listed.orderBy(order).offset(n)
