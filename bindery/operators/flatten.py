"""Nested records to flat child rows that keep parent and place.

Nested `transform` calls attach the ancestor's key and place to every element,
`flatten` joins the arrays below arrays, and one `inline` for a target table
emits its rows. All of it is a projection: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import spread
from bindery.sources.detail_lines import items, objects, records


def _row(child: str, parent_pos: Column, pos: Column, key: Column) -> Column:
    return F.struct(F.lit(child).alias("child"), parent_pos.cast("int").alias("parent_pos"), pos.cast("int").alias("pos"), key.alias("child_key"))


def _level(elements: Column, child: str, key) -> Column:
    """Rows of one array; null elements go after their places were counted."""
    return F.filter(
        F.transform(elements, lambda e, i: F.when(e.isNotNull(), _row(child, F.lit(-1), i, key(e)))),
        lambda row: row.isNotNull(),
    )


def _images(chapters: Column) -> Column:
    def of(chapter: Column, place: Column) -> Column:
        rows = F.transform(items(chapter["image_filenames"]), lambda e, i: F.when(e.isNotNull(), _row("image_filenames", place, i, e)))
        return F.coalesce(F.filter(rows, lambda row: row.isNotNull()), F.array())

    return F.flatten(F.transform(chapters, of))


def child_arrays() -> dict[str, Column]:
    """By target table: the array of its rows for an opened record."""
    return {
        "chapters": _level(F.col("chapters"), "chapters", lambda e: e["url"]),
        "similar": _level(F.col("similar"), "similar", lambda e: e["slug"]),
        "genre_ids": _level(F.col("genre_ids"), "genre_ids", lambda e: F.regexp_replace(e, r"\.0+$", "")),
        "image_filenames": _images(F.col("chapters")),
    }


def _opened(lines: DataFrame) -> DataFrame:
    return records(spread(lines)).select(
        "line_id",
        objects(F.col("rec.chapters"), "url", "image_filenames").alias("chapters"),
        objects(F.col("rec.similar"), "slug").alias("similar"),
        items(F.col("rec.genre_ids")).alias("genre_ids"),
    )


def children(lines: DataFrame, child: str) -> DataFrame:
    """(line_id, child, parent_pos, pos, child_key) of one target table.

    Absent, null or empty arrays give no row; an object without its key field
    gives a row with a null key; repeated lines give their rows again.
    """
    return _opened(lines).select("line_id", F.inline(child_arrays()[child]))


def all_children(lines: DataFrame) -> DataFrame:
    """The rows of all target tables as one table, made by one inline in one pass over the lines."""
    return _opened(lines).select("line_id", F.inline(F.concat(*child_arrays().values())))
