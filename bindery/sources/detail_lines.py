"""Staging lines: the JSON text of one record, bare or in an outer object.

Every field is read as text first, so a value of an unexpected type never makes
a valid line corrupt; arrays and objects stay JSON text until `items` opens them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.runtime import let

FIELDS = (
    "slug judul tipe thumb_domain_id thumb_path status_id author artist alternative_title sinopsis rating "
    "genre_list genre_ids chapters latest_chapter_number similar _status _error"
).split()
_RECORD = ", ".join(f"{f}: string" for f in FIELDS)
_OUTER = f"{_RECORD}, data: string, payload: string"


def records(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ("line_id", "fetched_at")) -> DataFrame:
    """One row per valid line: the columns `keep` and a struct `rec` of text fields.

    Blank lines, broken JSON (also text after the closing brace), JSON that is no
    object and null lines give no row. A record is the line itself if it has a
    slug, else its `data` or `payload.detail`. Other columns of `lines` are dropped.
    """
    # Within brackets, whatever follows the object is an error too.
    outer = F.from_json(F.concat(F.lit("["), F.col(line), F.lit("]")), f"array<struct<{_OUTER}>>", {"mode": "PERMISSIVE", "allowSingleQuotes": "false"})

    def record(o: Column) -> Column:
        inner = F.coalesce(F.when(o["data"].startswith("{"), o["data"]), F.get_json_object(o["payload"], "$.detail"))
        bare = F.struct(*(o[f].alias(f) for f in FIELDS))
        return F.when(o["slug"].isNotNull(), bare).otherwise(F.from_json(inner, f"struct<{_RECORD}>"))

    # Exploding, not filtering, drops the rest: a filter on the record would parse the line once more.
    found = let(outer, lambda a: F.when(F.size(a) == 1, F.filter(F.transform(a, record), lambda r: r["slug"].isNotNull())))
    return lines.filter(F.col(line).rlike(r"^\s*\{")).select(*keep, F.explode(found).alias("rec"))


def items(text: Column) -> Column:
    """Elements, as text, of a field that holds an array, its JSON text, or a lone element.

    Null gives an empty array; null elements stay, to keep the places of the others.
    """
    array = F.when(text.rlike(r"^\s*\["), F.from_json(text, "array<string>"))
    empty = F.array().cast("array<string>")
    return F.when(text.isNull() | (F.trim(text) == ""), empty).otherwise(F.coalesce(array, F.array(text)))


def objects(text: Column, *names: str) -> Column:
    """Elements, as structs of text fields, of a field like those of `items`.

    An element that is no object stands for its first field. Arrays of nothing
    but objects and nulls, or a lone object, open in one parse; only others go element by element.
    """
    shape = f"struct<{', '.join(f'{n}: string' for n in names)}>"
    lone = lambda e: F.struct(e.alias(names[0]), *(F.lit(None).cast("string").alias(n) for n in names[1:]))
    each = F.transform(items(text), lambda e: F.when(e.startswith("{"), F.from_json(e, shape)).when(e.isNotNull(), lone(e)))
    return F.coalesce(F.when(text.rlike(r"^\s*[\[{]"), F.from_json(text, f"array<{shape}>")), each)


def line_counts(lines: DataFrame, file: str = "file_name") -> DataFrame:
    """(file, n_lines): every line counts, blank and broken ones too."""
    return lines.groupBy(file).agg(F.count(F.lit(1)).alias("n_lines"))


def last_slugs(records_: DataFrame, file: str = "file_name", place: str = "line_no") -> DataFrame:
    """(file, slug): the slug of each file's last record."""
    return records_.groupBy(file).agg(F.max_by("slug", place).alias("slug"))


def newest_file(lines: DataFrame, file: str = "file_name", at: str = "fetched_at") -> DataFrame:
    """(file): the file with the latest line; of equals the last by name."""
    return lines.orderBy(F.col(at).desc(), F.col(file).desc()).limit(1).select(file)
