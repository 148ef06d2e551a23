"""Whole jobs: load staged records, full extraction, incremental update."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.dims import Site, genre_ids
from bindery.functions.scalars import titled
from bindery.operators import extract, feed, merge
from bindery.plans.store import Store
from bindery.runtime import bounded_broadcast, cut
from bindery.schemas import CHAPTER, RECORD

_SERIES = "judul tipe thumb_domain_id thumb_path status_id author artist alternative_title sinopsis rating latest_chapter_number".split()


@dataclass(frozen=True)
class Counts:
    processed: int
    new: int
    updated: int
    failed: int


def conformed(records: DataFrame, genres: DataFrame | None = None) -> DataFrame:
    """`records` with the columns and types of schemas.RECORD; what they lack is null, or an empty array.

    With `genres` (nama, genre_id) records without genre ids take them from their genre names. Needs distinct slugs.
    """
    if genres is not None and "genre_list" in records.columns:
        ids = genre_ids(records, genres, "slug", "genre_list").withColumnRenamed("genre_ids", "_ids")
        own = F.col("genre_ids") if "genre_ids" in records.columns else F.lit(None)
        records = records.join(ids, "slug", "left").withColumn("genre_ids", F.coalesce(own.cast("array<smallint>"), F.col("_ids").cast("array<smallint>"))).drop("_ids")

    def field(spec) -> Column:
        if spec.name not in records.columns:
            value = F.lit(None).cast(spec.dataType)
        elif spec.name == "chapters":
            have = [f.name for f in records.schema["chapters"].dataType.elementType.fields]
            names = [f.name for f in spec.dataType.elementType.fields]
            value = F.transform("chapters", lambda c: F.struct(*((c[n] if n in have else F.lit(None)).alias(n) for n in names))).cast(f"array<{CHAPTER}>")
        else:
            value = F.col(spec.name).cast(spec.dataType)
        return (F.coalesce(value, F.array().cast(spec.dataType)) if spec.dataType.typeName() == "array" else value).alias(spec.name)

    return records.select(*(field(f) for f in records.sparkSession.createDataFrame([], RECORD).schema.fields))


def load(records: DataFrame, store: Store, preserve: bool = False, genres: DataFrame | None = None) -> Counts:
    """Upsert one record per slug, its chapters, and its genres as a set; all three tables change together.

    Records, as staged or as extracted from pages (see conformed), must have distinct
    slugs (jsonl.newest_by_slug). Of chapters with one number the first counts. Ids
    of known series and chapters stay.
    """
    now = F.current_timestamp()
    records = cut(conformed(records, genres).withColumn("judul", titled(F.col("judul"), F.col("slug"))))
    series, chapters, genres = (store.table(t) for t in ("series", "chapters", "series_genres"))

    known = series.select("slug", F.col("id").alias("_id"), F.col("created_at").alias("_at"))
    rows = records.select("slug", *_SERIES, F.size("chapters").alias("chapter_count")).join(known, "slug", "left")
    top = series.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = merge.with_ids(rows.filter("_id is null").drop("_id", "_at"), top, ["slug"]).withColumn("created_at", now)
    old = rows.filter("_id is not null").withColumnRenamed("_id", "id").withColumnRenamed("_at", "created_at")
    delta = cut(fresh.unionByName(old).withColumn("updated_at", now))
    n_new, n_old = (int(x) for x in delta.agg(F.count_if(F.col("id") > top), F.count_if(F.col("id") <= top)).first())
    new_series = merge.upsert(series, delta, ["slug"], preserve).select(*series.columns)

    ids = delta.select("slug", F.col("id").alias("series_id"))
    exploded = records.join(ids, "slug").select("series_id", F.posexplode("chapters").alias("_pos", "c"))
    named = exploded.select("series_id", F.col("c.number").alias("chapter_number"), "_pos", F.col("c.url").alias("chapter_url"), *(F.col(f"c.{c}") for c in ("cdn_domain_id", "cdn_path_prefix", "image_filenames", "image_ext_ids", "total_images")))
    single = merge.first_wins(named.filter("chapter_number is not null"), ["series_id", "chapter_number"], ["_pos"]).drop("_pos")
    had = chapters.select("series_id", "chapter_number", F.col("id").alias("_id"), F.col("created_at").alias("_at"))
    rows = single.join(had, ["series_id", "chapter_number"], "left")
    top = chapters.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = merge.with_ids(rows.filter("_id is null").drop("_id", "_at"), top, ["series_id", "chapter_number"]).withColumn("created_at", now)
    old = rows.filter("_id is not null").withColumnRenamed("_id", "id").withColumnRenamed("_at", "created_at")
    new_chapters = merge.upsert(chapters, cut(fresh.unionByName(old).withColumn("updated_at", now)), ["series_id", "chapter_number"]).select(*chapters.columns)

    members = records.join(ids, "slug").select("series_id", F.explode("genre_ids").alias("genre_id")).distinct().withColumn("created_at", now)
    new_genres = merge.replace_sets(genres, members.select(*genres.columns), "series_id", owners=ids)

    store.replace({"series": new_series, "chapters": new_chapters, "series_genres": new_genres})
    counts = Counts(n_new + n_old, n_new, n_old, 0)
    store.log("upload", "completed", counts.processed, counts.new, counts.updated, counts.failed)
    return counts


def full_extract(pages: DataFrame, done: DataFrame | None = None, images: DataFrame | None = None, site: Site = Site(), limit: int = 0) -> DataFrame:
    """Records of detail pages (slug, html) that are not done yet; with chapter images if reader pages (url, html) are given."""
    listed = feed.limited(pages, limit, "slug")
    todo = listed if done is None else feed.resume(listed, done)
    found = extract.details(todo.select("slug", "html"), "slug", site)
    if images is None:
        return found
    block = extract.chapter_images(images.select("url", "html"), "url", site)
    exploded = found.select("slug", F.posexplode("chapters").alias("_i", "c")).select("slug", "_i", F.col("c.number").alias("number"), F.col("c.url").alias("url"))
    joined = extract.with_images(exploded, block).groupBy("slug").agg(F.sort_array(F.collect_list(F.struct("_i", "number", *(c for c in ("url", "cdn_domain_id", "cdn_path_prefix", "image_filenames", "image_ext_ids", "total_images"))))).alias("cs"))
    return found.drop("chapters").join(joined.select("slug", F.transform("cs", lambda c: c.dropFields("_i")).alias("chapters")), "slug", "left")


def raise_latest(raised: DataFrame, store: Store) -> None:
    """Raise the latest numbers of (slug, latest_chapter_number); only the parts of the table that hold the slugs are read and written."""
    raised = cut(raised)
    parts = store.touched("series", raised)
    store.patch("series", merge.monotone(store.table("series", parts), raised, "slug", "latest_chapter_number"), parts)


def incremental_update(items: DataFrame, store: Store, details: DataFrame | None = None, most_minutes: int = 360, dry_run: bool = False, genres: DataFrame | None = None) -> tuple[DataFrame, Counts]:
    """Classify feed items (page, place, slug, number, minutes), load details of new slugs, raise the latest numbers.

    Returns the classified items; with `dry_run` nothing is written. An empty feed is logged too.
    """
    kept = merge.first_wins(feed.until_old(items, most_minutes), ["slug"], ["page", "place"])
    series = store.table("series")
    told = cut(feed.classify(kept, series.select("slug", F.col("latest_chapter_number").alias("latest"))))
    row = feed.action_counts(told).first()
    counts = Counts(row["n_new"] + row["n_updated"] + row["n_skipped"], row["n_new"], row["n_updated"], 0)
    if not dry_run:
        if details is not None:
            load(details.join(bounded_broadcast(told.filter("action = 'new'").select("slug")), "slug", "left_semi"), store, genres=genres)
        raise_latest(told.filter("action = 'updated'").select("slug", F.col("number").alias("latest_chapter_number")), store)
        store.log("smart_update", "completed", counts.processed, counts.new, counts.updated, counts.failed)
    return told, counts
