"""Lookup dimensions: small name-to-id tables, given as data. The defaults are neutral samples."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import bounded_broadcast


@dataclass(frozen=True)
class Site:
    """What is particular to one site: its address, path markers and lookup tables."""

    base_url: str = "https://baca.komikraya.example"
    series_path: str = "/komik/"
    chapter_mark: str = "-chapter-"
    title_prefix: str = "komik"
    domains: dict[str, int] = field(default_factory=lambda: {"baca.komikraya.example": 1, "cdn.komikraya.example": 2, "img.komikraya.example": 3})
    statuses: dict[str, int] = field(default_factory=lambda: {"berjalan": 1, "tamat": 2})
    extensions: dict[str, int] = field(default_factory=lambda: {".jpg": 1, ".jpeg": 2, ".png": 3, ".webp": 4, ".gif": 5})
    image_marks: tuple[str, ...] = ("/data/",)
    # Marks of images that are no content; substrings, so "ads" also meets "uploads".
    other_marks: tuple[str, ...] = ("fav.png", "favicon", "logo", "ads", "banner", ".gif", "button", "icon", "gravatar", "emoji")


def _map(table: dict) -> Column:
    return F.create_map(*(F.lit(x) for pair in table.items() for x in pair))


def lookup(table: dict, key: Column) -> Column:
    """The value of `key` in a small fixed table; null if it has none."""
    return F.try_element_at(_map(table), key)


def status_id(site: Site, name: Column) -> Column:
    """Case-insensitive; unknown names give null."""
    return lookup(site.statuses, F.lower(name)).cast("short")


def status_name(site: Site, status: Column) -> Column:
    """Unknown ids give ''."""
    return F.coalesce(F.initcap(lookup({v: k for k, v in site.statuses.items()}, status.cast("int"))), F.lit(""))


def domain_id(site: Site, domain: Column) -> Column:
    """Exact; unknown domains give null."""
    return lookup(site.domains, domain).cast("short")


def domain_url(site: Site, domain: Column) -> Column:
    """Unknown ids give ''."""
    return F.coalesce(F.concat(F.lit("https://"), lookup({v: k for k, v in site.domains.items()}, domain.cast("int"))), F.lit(""))


def extension_id(site: Site, extension: Column) -> Column:
    """By lower-cased extension with its dot; unknown ones give 0."""
    return F.coalesce(lookup(site.extensions, F.lower(extension)), F.lit(0)).cast("short")


def extension_name(site: Site, extension: Column) -> Column:
    return F.coalesce(lookup({v: k for k, v in site.extensions.items()}, extension.cast("int")), F.lit(""))


def genre_ids(rows: DataFrame, genres: DataFrame, key: str, names: str) -> DataFrame:
    """(key, genre_ids): ids of an array of genre names, in order; exact match, unknown names dropped."""
    named = rows.select(key, F.posexplode(names).alias("at", "name"))
    known = named.join(bounded_broadcast(genres.select(F.col("nama").alias("name"), "genre_id")), "name")
    return known.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "genre_id"))), lambda x: x["genre_id"]).alias("genre_ids"))
