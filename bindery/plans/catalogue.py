"""Queries of the engine's own operators over the catalogue tables, each with its SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.functions import scalars as S
from bindery.functions.dims import Site, extension_name, genre_ids, lookup, status_id, status_name
from bindery.ml import evaluate
from bindery.operators import extract, feed, merge, read
from bindery.operators.dom import node_table, with_dom
from bindery.plans.pipelines import load, raise_latest
from bindery.plans.store import Store
from bindery.runtime import shared_folder, spread
from bindery.sources.detail_lines import items, last_slugs, line_counts, newest_file, objects, records
from bindery.sources.pages import judged
from bindery.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SITE = Site()


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# --- staged records ------------------------------------------------------------

_KEEP = ("line_id", "file_name", "line_no", "fetched_at")


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return records(spread(table(spark, folder, "detail_lines")), keep=_KEEP).select(*_KEEP, "rec.*")


def _newest(spark: SparkSession, folder: str) -> DataFrame:
    return merge.last_wins(_records(spark, folder), ["slug"], ["file_name", "line_no"])


_REC = """
WITH v AS (SELECT line_id, file_name, line_no, fetched_at, CAST(line AS JSON) AS j FROM detail_lines WHERE json_valid(line) AND ltrim(line) LIKE '{%'),
r AS (SELECT line_id, file_name, line_no, fetched_at, CASE WHEN j->>'$.slug' IS NOT NULL THEN j WHEN json_type(j->'$.data') = 'OBJECT' THEN j->'$.data' ELSE j->'$.payload.detail' END AS d FROM v),
n AS (SELECT * FROM r WHERE d->>'$.slug' IS NOT NULL QUALIFY row_number() OVER (PARTITION BY d->>'$.slug' ORDER BY file_name DESC, line_no DESC) = 1)
"""
_ARRAY = "CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x}->>'$') THEN CAST(CAST({x}->>'$' AS JSON) AS JSON[]) WHEN json_type({x}) = 'ARRAY' THEN CAST({x} AS JSON[]) WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN CAST([] AS JSON[]) ELSE [{x}] END"


def _array(field: str) -> str:
    return _ARRAY.format(x=f"(d->'$.{field}')")


@query(_REC + "SELECT file_name, count(*) AS n_records, count(*) FILTER (d->>'$._status' IS NOT NULL) AS n_errors FROM r GROUP BY 1")
def staged_by_file(spark, folder):
    return _records(spark, folder).groupBy("file_name").agg(F.count(F.lit(1)).alias("n_records"), F.count_if(F.col("_status").isNotNull()).alias("n_errors"))


@query("SELECT file_name, count(*) AS n_lines FROM detail_lines GROUP BY 1")
def staged_line_count(spark, folder):
    return line_counts(table(spark, folder, "detail_lines"))


@query(_REC + "SELECT d->>'$.slug' AS slug, line_id, d->>'$.author' AS author FROM n")
def staged_last_wins(spark, folder):
    return _newest(spark, folder).select("slug", "line_id", "author")


@query(_REC + "SELECT file_name, arg_max(d->>'$.slug', line_no) AS slug FROM r WHERE d->>'$.slug' IS NOT NULL GROUP BY 1")
def staged_last_slug(spark, folder):
    return last_slugs(_records(spark, folder))


@query(_REC + "SELECT line_id, d->>'$.slug' AS slug, d->>'$._status' AS reason FROM r WHERE d->>'$._status' IS NOT NULL")
def dead_letters(spark, folder):
    return _records(spark, folder).filter("_status is not null").select("line_id", "slug", F.col("_status").alias("reason"))


@query("SELECT max(file_name) AS file_name FROM detail_lines WHERE fetched_at = (SELECT max(fetched_at) FROM detail_lines)")
def latest_file(spark, folder):
    return newest_file(table(spark, folder, "detail_lines"))


@query("SELECT event_id, props->>'$.k' AS k, CAST(json_valid(props) AS INT) AS valid FROM events")
def json_field_access(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.coalesce(F.try_parse_json("props").isNotNull(), F.lit(False)).cast("int").alias("valid"))


# --- scalars --------------------------------------------------------------------


@query("SELECT id, slug FROM komik")
def slug_from_url(spark, folder):
    return table(spark, folder, "komik").select("id", S.slug_of(S.series_url(F.col("slug"), SITE), SITE).alias("slug"))


@query(f"SELECT id, CASE WHEN regexp_matches(chapter_url, '^https?://') THEN chapter_url WHEN chapter_url LIKE '/%' THEN '{SITE.base_url}' || chapter_url ELSE '{SITE.base_url}/' || chapter_url END AS url FROM chapters")
def url_absolute(spark, folder):
    return table(spark, folder, "chapters").select("id", S.absolute(F.col("chapter_url"), SITE).alias("url"))


@query("SELECT id, CASE split_part(split_part(chapter_url, '://', 2), '/', 1) WHEN 'baca.komikraya.example' THEN 1 WHEN 'cdn.komikraya.example' THEN 2 WHEN 'img.komikraya.example' THEN 3 END AS domain_id, CASE WHEN split_part(split_part(chapter_url, '://', 2), '/', 1) IN ('baca.komikraya.example', 'cdn.komikraya.example', 'img.komikraya.example') THEN regexp_extract(chapter_url, '^[^:]*://[^/]*/(.*)$', 1) END AS path FROM chapters")
def url_split(spark, folder):
    parts = S.split_url(F.col("chapter_url"), SITE)
    return table(spark, folder, "chapters").select("id", parts["domain_id"].cast("int").alias("domain_id"), parts["path"].alias("path"))


@query("SELECT id, 'https://baca.komikraya.example/' || cdn_path_prefix AS url FROM chapters WHERE cdn_domain_id = 1 AND cdn_path_prefix IS NOT NULL")
def url_joined(spark, folder):
    rows = table(spark, folder, "chapters").filter("cdn_domain_id = 1 and cdn_path_prefix is not null")
    return rows.select("id", S.joined_url(F.col("cdn_domain_id"), F.col("cdn_path_prefix"), SITE).alias("url"))


@query("SELECT id, regexp_replace(thumb_path || '-20x30.x', '-\\d+x\\d+\\.', '.') AS path FROM komik")
def size_stripped_once(spark, folder):
    return table(spark, folder, "komik").select("id", S.without_size(F.concat("thumb_path", F.lit("-20x30.x"))).alias("path"))


@query("SELECT id, CASE WHEN thumb_path IS NOT NULL THEN 2 END AS domain_id, regexp_replace(thumb_path, '-\\d+x\\d+\\.', '.') AS path FROM komik")
def thumbnail_normalised(spark, folder):
    url = F.concat(F.lit("https://cdn.komikraya.example/data/wp-content/uploads/Komik-"), "thumb_path")
    thumb = S.thumbnail(url, SITE)
    return table(spark, folder, "komik").select("id", thumb["domain_id"].cast("int").alias("domain_id"), thumb["path"].alias("path"))


@query("SELECT id, CASE WHEN regexp_matches(thumb_path, '\\.[^.]*$') THEN regexp_extract(thumb_path, '^(.*)\\.[^.]*$', 1) ELSE thumb_path END AS name, CASE WHEN thumb_path IS NULL THEN 0 ELSE CASE lower(regexp_extract(thumb_path, '(\\.[^.]*)$', 1)) WHEN '.jpg' THEN 1 WHEN '.jpeg' THEN 2 WHEN '.png' THEN 3 WHEN '.webp' THEN 4 WHEN '.gif' THEN 5 ELSE 0 END END AS ext_id FROM komik")
def filename_split(spark, folder):
    name = S.split_name(F.col("thumb_path"), SITE)
    return table(spark, folder, "komik").select("id", name["name"].alias("name"), name["ext_id"].cast("int").alias("ext_id"))


@query("SELECT id, regexp_replace(rtrim(chapter_url, '/'), '-chapter-[\\d.]+/?$', '') AS base FROM chapters")
def url_base(spark, folder):
    return table(spark, folder, "chapters").select("id", S.url_base(F.col("chapter_url"), SITE).alias("base"))


@query("SELECT id, 'b-chapter-' || CAST(trunc(chapter_number) AS BIGINT) || CASE WHEN chapter_number = trunc(chapter_number) THEN '' ELSE '-' || rtrim(split_part(printf('%.10f', chapter_number - trunc(chapter_number)), '.', 2), '0') END || '/' AS url FROM chapters")
def chapter_url_built(spark, folder):
    return table(spark, folder, "chapters").select("id", S.chapter_url(F.lit("b"), F.col("chapter_number"), SITE).alias("url"))


@query("SELECT id, try_cast(nullif(regexp_extract(chapter_url, '(?i)chapter-([\\d.]+)', 1), '') AS DOUBLE) AS number FROM chapters")
def chapter_number_from_url(spark, folder):
    return table(spark, folder, "chapters").select("id", S.url_chapter_number(F.col("chapter_url")).alias("number"))


@query("SELECT doc_id, try_cast(nullif(regexp_extract(text, '(?i)chapter\\s*([\\d.]+)', 1), '') AS DOUBLE) AS t, coalesce(try_cast(nullif(regexp_extract(text, '(?i)chapter\\s*([\\d.]+)', 1), '') AS DOUBLE), try_cast(nullif(regexp_extract(text, '(?i)chapter-([\\d.]+)', 1), '') AS DOUBLE)) AS number FROM documents")
def chapter_number_text_then_url(spark, folder):
    text = F.col("text")
    return table(spark, folder, "documents").select("doc_id", S.chapter_number(text, F.lit("")).alias("t"), S.chapter_number(text, text).alias("number"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN event_id WHEN 'view' THEN event_id * 60 WHEN 'signup' THEN event_id * 1440 ELSE 99999 END AS minutes FROM events")
def relative_age_minutes(spark, folder):
    unit = F.when(F.col("event_type") == "click", " Menit lalu").when(F.col("event_type") == "view", "jam lalu").when(F.col("event_type") == "signup", "  hari").otherwise(" abad")
    return table(spark, folder, "events").select("event_id", S.age_minutes(F.concat(F.col("event_id").cast("string"), unit)).alias("minutes"))


@query("SELECT id, regexp_replace(regexp_replace(judul, '(?i)^komik\\s*', ''), '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS judul, coalesce(nullif(author, ''), slug) AS named FROM komik")
def title_cleaned(spark, folder):
    return table(spark, folder, "komik").select("id", S.title(F.col("judul"), SITE).alias("judul"), S.titled(F.col("author"), F.col("slug")).alias("named"))


@query("SELECT doc_id, regexp_replace(text, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS text FROM documents")
def synopsis_cleaned(spark, folder):
    prefixed = F.concat(F.lit("Update chapter terbaru komik apa pun.\nSinopsis Manga  "), "text")
    return table(spark, folder, "documents").select("doc_id", S.synopsis(prefixed, SITE).alias("text"))


@query("SELECT id, regexp_replace(CASE WHEN judul LIKE '%:%' THEN substr(judul, instr(judul, ':') + 1) ELSE judul END, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g') AS value FROM komik")
def label_value(spark, folder):
    return table(spark, folder, "komik").select("id", S.after_label(F.col("judul")).alias("value"))


@query("SELECT id, array_to_string(list_filter(list_transform(string_split(alternative_title, ','), lambda x: regexp_replace(x, '^[\\s\\p{Z}]+|[\\s\\p{Z}]+$', '', 'g')), lambda x: x <> ''), '|') AS parts FROM komik")
def comma_list_parse(spark, folder):
    return table(spark, folder, "komik").select("id", F.array_join(S.comma_list(F.col("alternative_title")), "|").alias("parts"))


@query("SELECT doc_id, CAST(regexp_matches(text, '\\b\\d\\.\\d\\b') AS INT) AS has_rating, CAST(regexp_matches(text, '(?i)(chapter|bab)\\s*\\d+') AS INT) AS has_chapter, CAST(regexp_matches(text, '\\b(19|20)\\d{2}\\b') AS INT) AS has_year, round(least(ln(1 + length(text)) / 6, 1), 9) AS log_length FROM documents")
def text_flags(spark, folder):
    flags = S.flags(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", *(c.cast("int").alias(n) for n, c in flags.items()), F.round(S.log_length(F.col("text")), 9).alias("log_length"))


@query("SELECT id, status_id, CASE status_id WHEN 1 THEN 'Berjalan' WHEN 2 THEN 'Tamat' ELSE '' END AS name FROM komik")
def status_lookup(spark, folder):
    name = status_name(SITE, F.col("status_id"))
    return table(spark, folder, "komik").select("id", F.coalesce(status_id(SITE, F.upper(name)), F.when(name == "", F.col("status_id"))).alias("status_id"), name.alias("name"))


@query("SELECT id, CASE image_ext_id WHEN 1 THEN '.jpg' WHEN 2 THEN '.jpeg' WHEN 3 THEN '.png' WHEN 4 THEN '.webp' WHEN 5 THEN '.gif' ELSE '' END AS ext FROM chapters")
def extension_lookup(spark, folder):
    return table(spark, folder, "chapters").select("id", extension_name(SITE, F.col("image_ext_id")).alias("ext"))


@query(_REC + f", g AS (SELECT line_id, unnest(range(len(l))) AS i, unnest(l)->>'$' AS nama FROM (SELECT line_id, {_array('genre_list')} AS l FROM r)) SELECT line_id, string_agg(genre_id, ',' ORDER BY i) AS ids FROM g JOIN genres USING (nama) GROUP BY 1")
def genre_name_lookup(spark, folder):
    named = _records(spark, folder).select("line_id", items(F.col("genre_list")).alias("names"))
    found = genre_ids(named, table(spark, folder, "genres"), "line_id", "names")
    return found.select("line_id", F.array_join(F.col("genre_ids").cast("array<string>"), ",").alias("ids"))


@query("SELECT id, CAST(contains(lower('https://img.x/data/' || cdn_path_prefix || coalesce(image_filenames, '')), '/data/') AND NOT regexp_matches(lower('https://img.x/data/' || cdn_path_prefix || coalesce(image_filenames, '')), 'fav\\.png|favicon|logo|ads|banner|\\.gif|button|icon|gravatar|emoji') AS INT) AS content FROM chapters WHERE cdn_path_prefix IS NOT NULL")
def content_image(spark, folder):
    url = F.concat(F.lit("https://img.x/data/"), "cdn_path_prefix", F.coalesce("image_filenames", F.lit("")))
    return table(spark, folder, "chapters").filter("cdn_path_prefix is not null").select("id", S.is_content_image(url, SITE).cast("int").alias("content"))


@query("SELECT doc_id, CASE WHEN 200 + doc_id % 300 >= 400 THEN 'status' WHEN regexp_matches(text, '(?i)just a moment|checking your browser|cf-challenge|verify you are human') THEN 'challenge' WHEN strlen(text) < 100 AND (contains(text, 'error') OR contains(text, 'Access denied')) THEN 'short' END AS fault FROM documents")
def response_gates(spark, folder):
    pages = table(spark, folder, "documents").withColumn("status", F.lit(200) + F.col("doc_id") % 300)
    return judged(pages, html="text").select("doc_id", "fault")


# --- merges ----------------------------------------------------------------------


def _delta(spark, folder) -> DataFrame:
    rows = _newest(spark, folder).filter("_status is null")
    return rows.select("slug", S.titled(F.col("judul"), F.col("slug")).alias("judul"), "author", S.number(F.col("latest_chapter_number")).alias("latest"))


_DELTA = _REC + ", x AS (SELECT d->>'$.slug' AS slug, coalesce(nullif(d->>'$.judul', ''), d->>'$.slug') AS judul, d->>'$.author' AS author, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS latest FROM n WHERE d->>'$._status' IS NULL)"


def _base(spark, folder) -> DataFrame:
    return table(spark, folder, "komik").select("slug", "judul", "author", F.col("latest_chapter_number").alias("latest"))


@query(_DELTA + " SELECT * FROM x UNION ALL SELECT slug, judul, author, latest_chapter_number FROM komik WHERE slug NOT IN (SELECT slug FROM x)")
def upsert_series(spark, folder):
    return merge.upsert(_base(spark, folder), _delta(spark, folder), ["slug"])


@query(_DELTA + " SELECT coalesce(x.slug, k.slug) AS slug, coalesce(x.judul, k.judul) AS judul, coalesce(x.author, k.author) AS author, coalesce(x.latest, k.latest_chapter_number) AS latest FROM x FULL JOIN komik k ON k.slug = x.slug")
def upsert_preserving(spark, folder):
    return merge.upsert(_base(spark, folder), _delta(spark, folder), ["slug"], preserve=True)


@query(_DELTA + " SELECT count(*) FILTER (k.slug IS NULL) AS n_new, count(*) FILTER (k.slug IS NOT NULL) AS n_updated FROM x LEFT JOIN komik k ON k.slug = x.slug")
def upsert_counts(spark, folder):
    return merge.upsert_counts(_base(spark, folder), _delta(spark, folder), ["slug"])


def _child_delta(spark, folder) -> DataFrame:
    rows = _newest(spark, folder).join(table(spark, folder, "komik").select("slug", F.col("id").alias("komik_id")), "slug")
    exploded = rows.select("komik_id", F.posexplode(objects(F.col("chapters"), "number", "url")).alias("pos", "c")).filter("c is not null")
    named = exploded.select("komik_id", S.number(F.col("c.number")).alias("chapter_number"), "pos", F.col("c.url").alias("chapter_url")).filter("chapter_number is not null")
    return merge.first_wins(named, ["komik_id", "chapter_number"], ["pos"]).drop("pos")


_CHILD = _REC + f""", c AS (SELECT komik_id, pos, try_cast(e->>'$.number' AS DOUBLE) AS chapter_number, e->>'$.url' AS chapter_url FROM (SELECT k.id AS komik_id, unnest(range(len(l))) AS pos, unnest(l) AS e FROM (SELECT d->>'$.slug' AS slug, {_array('chapters')} AS l FROM n) q JOIN komik k ON k.slug = q.slug) WHERE json_type(e) = 'OBJECT'),
x AS (SELECT komik_id, chapter_number, chapter_url FROM c WHERE chapter_number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY komik_id, chapter_number ORDER BY pos) = 1),
b AS (SELECT komik_id, chapter_number, chapter_url FROM chapters QUALIFY row_number() OVER (PARTITION BY komik_id, chapter_number ORDER BY id DESC) = 1)
"""


@query(_CHILD + "SELECT * FROM x")
def children_first_wins(spark, folder):
    return _child_delta(spark, folder)


@query(_CHILD + "SELECT * FROM x UNION ALL SELECT b.* FROM b LEFT JOIN x ON x.komik_id = b.komik_id AND x.chapter_number = b.chapter_number WHERE x.komik_id IS NULL")
def upsert_children(spark, folder):
    base = merge.keep_greatest_id(table(spark, folder, "chapters"), ["komik_id", "chapter_number"], "id").select("komik_id", "chapter_number", "chapter_url")
    return merge.upsert(base, _child_delta(spark, folder), ["komik_id", "chapter_number"])


@query("SELECT max(id) AS id, komik_id, chapter_number FROM chapters GROUP BY ALL")
def dedup_keep_greatest_id(spark, folder):
    return merge.keep_greatest_id(table(spark, folder, "chapters").select("id", "komik_id", "chapter_number"), ["komik_id", "chapter_number"], "id")


def _sets(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _newest(spark, folder).join(table(spark, folder, "komik").select("slug", F.col("id").alias("komik_id")), "slug")
    members = rows.select("komik_id", F.explode(items(F.col("genre_ids"))).alias("g")).select("komik_id", F.col("g").try_cast("int").alias("genre_id")).filter("genre_id is not null")
    base = table(spark, folder, "komik_genres").select("komik_id", F.col("genre_id").cast("int").alias("genre_id")).distinct()
    return base, members, rows.select("komik_id")


_SETS = _REC + f""", o AS (SELECT k.id AS komik_id, {_array('genre_ids')} AS l FROM n JOIN komik k ON k.slug = n.d->>'$.slug'),
m AS (SELECT DISTINCT komik_id, genre_id FROM (SELECT komik_id, try_cast(unnest(l)->>'$' AS INT) AS genre_id FROM o) WHERE genre_id IS NOT NULL),
b AS (SELECT DISTINCT komik_id, CAST(genre_id AS INT) AS genre_id FROM komik_genres)
"""


@query(_SETS + "SELECT * FROM m UNION ALL SELECT * FROM b WHERE komik_id NOT IN (SELECT komik_id FROM o)")
def replace_sets(spark, folder):
    base, members, owners = _sets(spark, folder)
    return merge.replace_sets(base, members, "komik_id", owners)


@query(_SETS + "SELECT komik_id FROM (SELECT DISTINCT komik_id FROM o) LEFT JOIN (SELECT komik_id, list_sort(list(genre_id)) AS g FROM m GROUP BY 1) a USING (komik_id) LEFT JOIN (SELECT komik_id, list_sort(list(genre_id)) AS h FROM b GROUP BY 1) c USING (komik_id) WHERE a.g IS DISTINCT FROM c.h")
def changed_sets(spark, folder):
    base, members, owners = _sets(spark, folder)
    return merge.changed_sets(base, members, "komik_id", "genre_id", owners)


def _raise(spark, folder):
    base = table(spark, folder, "komik").select("id", F.col("latest_chapter_number").alias("latest"))
    return base, table(spark, folder, "chapters").select(F.col("komik_id").alias("id"), F.col("chapter_number").alias("latest"))


@query("SELECT id, greatest(latest_chapter_number, m) AS latest FROM komik LEFT JOIN (SELECT komik_id, max(chapter_number) AS m FROM chapters GROUP BY 1) c ON c.komik_id = id")
def monotone_update(spark, folder):
    base, delta = _raise(spark, folder)
    return merge.monotone(base, delta, "id", "latest")


@query("SELECT count(*) FILTER (latest_chapter_number IS NULL OR latest_chapter_number < m) AS n_affected FROM komik JOIN (SELECT komik_id, max(chapter_number) AS m FROM chapters GROUP BY 1) c ON c.komik_id = id")
def monotone_affected(spark, folder):
    base, delta = _raise(spark, folder)
    return merge.monotone_count(base, delta, "id", "latest")


@query("SELECT id, komik_id FROM chapters WHERE komik_id NOT IN (SELECT komik_id FROM komik_deleted UNION SELECT id FROM komik WHERE status_id = 2) OR komik_id IS NULL")
def cascade_delete(spark, folder):
    """Chapters without those of series that are deleted, taking the completed series as deleted too (no chapter of a deleted one is stored)."""
    gone = table(spark, folder, "komik_deleted").select(F.col("komik_id").alias("gone")).unionByName(table(spark, folder, "komik").filter("status_id = 2").select(F.col("id").alias("gone")))
    return merge.cascade(table(spark, folder, "chapters").select("id", "komik_id"), gone, "komik_id", "gone")


@query("SELECT (SELECT max(id) FROM komik) + row_number() OVER (ORDER BY slug COLLATE C) AS id, slug FROM (SELECT DISTINCT slug FROM komik_deleted)".replace(" COLLATE C", ""))
def surrogate_keys(spark, folder):
    top = table(spark, folder, "komik").agg(F.max("id")).first()[0]
    return merge.with_ids(table(spark, folder, "komik_deleted").select("slug").distinct(), top, ["slug"])


@query(_REC + "SELECT (SELECT max(id) FROM komik) + row_number() OVER (ORDER BY slug) AS id, slug FROM (SELECT DISTINCT d->>'$.slug' AS slug FROM n)")
def surrogate_keys_series(spark, folder):
    """Ids of every staged series (in the given tables all of them are stored already, so new ones alone would be none)."""
    top = table(spark, folder, "komik").agg(F.max("id")).first()[0]
    return merge.with_ids(_newest(spark, folder).select("slug"), top, ["slug"])


@query("SELECT 1000 + row_number() OVER (ORDER BY komik_id, chapter_number) AS id, komik_id, chapter_number FROM (SELECT DISTINCT komik_id, chapter_number FROM chapters WHERE komik_id IS NOT NULL AND chapter_number IS NOT NULL)")
def surrogate_keys_chapters(spark, folder):
    """Ids of every natural key of a chapter."""
    keys = table(spark, folder, "chapters").filter("komik_id is not null and chapter_number is not null").select("komik_id", "chapter_number").distinct()
    return merge.with_ids(keys, 1000, ["komik_id", "chapter_number"])


# --- feed --------------------------------------------------------------------------


def _feed(spark, folder) -> DataFrame:
    rows = _newest(spark, folder).filter("_status is null")
    return rows.select("slug", S.number(F.col("latest_chapter_number")).alias("number")).filter("number is not null")


_STORED = "SELECT slug, latest_chapter_number AS s FROM komik"
_CLASSIFY = _REC + f""", i AS (SELECT d->>'$.slug' AS slug, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS number FROM n WHERE d->>'$._status' IS NULL),
c AS (SELECT slug, number, s AS stored_latest, CASE WHEN s IS NULL THEN 'new' WHEN number <= s THEN 'skipped' ELSE 'updated' END AS action FROM i LEFT JOIN ({_STORED}) USING (slug) WHERE number IS NOT NULL)
"""


@query(_CLASSIFY + "SELECT *, CASE WHEN action = 'updated' THEN CAST(trunc(number) AS BIGINT) - CAST(trunc(stored_latest) AS BIGINT) END AS gap FROM c")
def classify_feed(spark, folder):
    return feed.classify(_feed(spark, folder), table(spark, folder, "komik").select("slug", F.col("latest_chapter_number").alias("latest")))


@query(_REC + """, i AS (SELECT d->>'$.slug' AS slug, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS number FROM n WHERE d->>'$._status' IS NULL),
w AS (SELECT slug, number, CASE WHEN a.slug_a IS NOT NULL THEN a.s ELSE b.s END AS stored_latest FROM i LEFT JOIN (SELECT slug AS slug_a, latest_chapter_number AS s FROM komik WHERE status_id = 1) a ON a.slug_a = i.slug LEFT JOIN (SELECT slug AS slug_b, CAST(chapter_count AS DOUBLE) AS s FROM komik) b ON b.slug_b = i.slug WHERE number IS NOT NULL)
SELECT *, CASE WHEN stored_latest IS NULL THEN 'new' WHEN number <= stored_latest THEN 'skipped' ELSE 'updated' END AS action, CASE WHEN number > stored_latest THEN CAST(trunc(number) AS BIGINT) - CAST(trunc(stored_latest) AS BIGINT) END AS gap FROM w""")
def classify_two_sources(spark, folder):
    """The feed against running series, and for slugs that are not among them against the chapter counts of all."""
    rows = table(spark, folder, "komik")
    stored = rows.filter("status_id = 1").select("slug", F.col("latest_chapter_number").alias("latest"))
    return feed.classify(_feed(spark, folder), stored, rows.select("slug", F.col("chapter_count").cast("double").alias("latest")))


@query(_CLASSIFY + "SELECT count(*) FILTER (action = 'new') AS n_new, count(*) FILTER (action = 'updated') AS n_updated, count(*) FILTER (action = 'skipped') AS n_skipped FROM c")
def classify_counts(spark, folder):
    return feed.action_counts(classify_feed(spark, folder))


def _paged(spark, folder) -> DataFrame:
    rows = table(spark, folder, "detail_lines")
    newest = rows.agg(F.max("fetched_at").alias("now"))
    minutes = (F.unix_timestamp(F.col("now").cast("timestamp")) - F.unix_timestamp(F.col("fetched_at").cast("timestamp"))) / 60
    page = F.dense_rank().over(Window.orderBy(F.col("file_name").desc()))
    files = rows.select("file_name").distinct().select("file_name", page.alias("page"))
    return rows.join(F.broadcast(newest)).join(files, "file_name").select("line_id", "page", F.col("line_no").alias("place"), F.floor(minutes).cast("long").alias("minutes"))


_AGE_LIMIT = 60 * 24 * 120


@query(f"""WITH i AS (SELECT line_id, dense_rank() OVER (ORDER BY file_name DESC) AS page, line_no AS place, CAST(floor(epoch(max(fetched_at) OVER () - fetched_at) / 60) AS BIGINT) AS minutes FROM detail_lines),
p AS (SELECT page, arg_max(minutes, place) AS last FROM i GROUP BY 1), c AS (SELECT min(page) AS cut FROM p WHERE last >= {_AGE_LIMIT})
SELECT line_id, page, place, minutes FROM i, c WHERE cut IS NULL OR page < cut OR (page = cut AND minutes < {_AGE_LIMIT})""")
def paginate_until_old(spark, folder):
    return feed.until_old(_paged(spark, folder), _AGE_LIMIT)


@query(_REC + "SELECT slug FROM komik WHERE slug NOT IN (SELECT d->>'$.slug' FROM n)")
def resume_anti_join(spark, folder):
    return feed.resume(table(spark, folder, "komik").select("slug"), _newest(spark, folder))


@query("SELECT id FROM komik WHERE id > (SELECT max(id) FROM komik WHERE slug = (SELECT arg_max(slug, (deleted_at, slug)) FROM komik_deleted WHERE slug IN (SELECT slug FROM komik))) OR NOT EXISTS (SELECT 1 FROM komik_deleted WHERE slug IN (SELECT slug FROM komik))")
def resume_after_position(spark, folder):
    listed = table(spark, folder, "komik").select("id", "slug")
    back = table(spark, folder, "komik_deleted").join(listed.select("slug"), "slug", "left_semi").agg(F.max_by("slug", F.struct("deleted_at", "slug"))).first()[0]
    return feed.after(listed, back, "slug", "id").select("id")


@query("SELECT id FROM komik ORDER BY id OFFSET 25")
def skip_first(spark, folder):
    return feed.skipped(table(spark, folder, "komik").select("id"), 25, "id")


# --- reads ---------------------------------------------------------------------------


@query("SELECT id, slug, latest_chapter_number FROM komik ORDER BY id DESC LIMIT 20")
def latest_series(spark, folder):
    return read.latest(table(spark, folder, "komik").select("id", "slug", "latest_chapter_number"), 20)


@query("SELECT komik_id, CAST(row_number() OVER (PARTITION BY komik_id ORDER BY chapter_number DESC, id) AS INT) AS rank, id, chapter_number FROM chapters QUALIFY rank <= 5")
def top_chapters(spark, folder):
    rows = table(spark, folder, "chapters").select("id", "komik_id", "chapter_number")
    return read.top_children(rows, "komik_id", "chapter_number", 5)


@query("""WITH c AS (SELECT komik_id, string_agg(CAST(chapter_number AS DECIMAL(18, 4)), '|' ORDER BY r) AS latest FROM (SELECT komik_id, chapter_number, row_number() OVER (PARTITION BY komik_id ORDER BY chapter_number DESC, id) AS r FROM chapters) WHERE r <= 3 GROUP BY 1),
g AS (SELECT komik_id, string_agg(genre_id, '|' ORDER BY genre_id) AS genres FROM (SELECT DISTINCT komik_id, genre_id FROM komik_genres WHERE genre_id IS NOT NULL) GROUP BY 1)
SELECT id, slug, coalesce(latest, '') AS latest, coalesce(genres, '') AS genres FROM komik LEFT JOIN c ON c.komik_id = id LEFT JOIN g ON g.komik_id = id""")
def series_detail(spark, folder):
    found = read.detail(table(spark, folder, "komik").select("id", "slug"), table(spark, folder, "chapters").select("id", "komik_id", "chapter_number"), table(spark, folder, "komik_genres"), 3)
    numbers = F.transform("latest", lambda n: n.cast("decimal(18,4)").cast("string"))
    return found.select("id", "slug", F.array_join(numbers, "|").alias("latest"), F.array_join(F.col("genre_ids").cast("array<string>"), "|").alias("genres"))


@query("SELECT k.id, k.slug, k.rating FROM komik k WHERE slug = (SELECT min(slug) FROM komik)")
def point_lookup(spark, folder):
    rows = table(spark, folder, "komik")
    return read.lookup(rows, "slug", rows.agg(F.min("slug")).first()[0]).select("id", "slug", "rating")


@query("SELECT (SELECT count(*) FROM komik) AS n_series, (SELECT count(*) FROM chapters) AS n_chapters, (SELECT count(*) FROM komik_genres) AS n_genres")
def counts_all(spark, folder):
    return read.counts({"n_series": table(spark, folder, "komik"), "n_chapters": table(spark, folder, "chapters"), "n_genres": table(spark, folder, "komik_genres")})


@query("SELECT id, slug, latest_chapter_number AS latest FROM komik")
def chapter_map(spark, folder):
    return read.value_map(table(spark, folder, "komik"), "slug", "latest_chapter_number", "latest")


@query("SELECT genre_id, count(*) AS n_series FROM (SELECT DISTINCT komik_id, genre_id FROM komik_genres) JOIN genres USING (genre_id) GROUP BY 1")
def bridge_counts(spark, folder):
    return read.members(table(spark, folder, "komik_genres"), table(spark, folder, "genres"), "komik_id", "genre_id", "n_series")


@query("SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def last_log_row(spark, folder):
    return read.last_row(table(spark, folder, "events"), "ts", "event_id").select("event_id", "event_type")


@query("SELECT komik_id, cdn_domain_id, n FROM (SELECT komik_id, cdn_domain_id, count(*) AS n FROM chapters WHERE cdn_domain_id IS NOT NULL GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY komik_id ORDER BY n DESC, cdn_domain_id) = 1")
def primary_domain(spark, folder):
    return read.modes(table(spark, folder, "chapters").filter("cdn_domain_id is not null"), "komik_id", "cdn_domain_id")


@query("""WITH g AS (SELECT komik_id, min(cdn_path_prefix) AS a, max(cdn_path_prefix) AS b, count(*) AS n FROM chapters WHERE cdn_path_prefix IS NOT NULL GROUP BY 1),
l AS (SELECT komik_id, n, a, b, coalesce(list_max([i FOR i IN range(0, least(length(a), length(b)) + 1) IF a[1:i] = b[1:i]]), 0) AS k FROM g)
SELECT komik_id, a[1:k] AS common, regexp_replace(CASE WHEN n = 1 THEN CASE WHEN contains(a, '/') THEN regexp_replace(a, '/[^/]*$', '') ELSE '' END ELSE a[1:k] END, '/?[^/]*$', '') AS folder FROM l""")
def common_prefixes(spark, folder):
    paths = table(spark, folder, "chapters").filter("cdn_path_prefix is not null").groupBy("komik_id").agg(F.min("cdn_path_prefix").alias("a"), F.max("cdn_path_prefix").alias("b"), F.count(F.lit(1)).alias("n"))
    return paths.select("komik_id", S.common_prefix(F.col("a"), F.col("b")).alias("common"), S.folder_prefix(F.col("a"), F.col("b"), F.col("n")).alias("folder"))


@query("SELECT event_type, done, seconds, total, CASE WHEN seconds = 0 THEN 0 ELSE done * 60.0 / seconds END AS per_minute, CASE WHEN total = 0 THEN 0 ELSE done * 100.0 / total END AS percent, CASE WHEN done = 0 OR seconds = 0 THEN 0 ELSE (total - done) * 60.0 / (done * 60.0 / seconds) END AS seconds_left FROM (SELECT event_type, count(*) AS done, CAST(floor(epoch(max(ts))) - floor(epoch(min(ts))) AS BIGINT) AS seconds, (SELECT count(*) FROM events) AS total FROM events GROUP BY 1)")
def throughput(spark, folder):
    rows = table(spark, folder, "events")
    ts = F.unix_timestamp(F.col("ts").cast("timestamp"))
    done = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("done"), (F.max(ts) - F.min(ts)).alias("seconds"))
    return read.throughput(done.join(F.broadcast(rows.agg(F.count(F.lit(1)).alias("total")))), "done", "seconds", "total")


# --- evaluation -----------------------------------------------------------------------


@query(_REC + f""", a AS (SELECT k.id AS komik_id, list_distinct([trim(lower(x->>'$')) FOR x IN {_array('genre_ids')}]) AS g FROM n JOIN komik k ON k.slug = n.d->>'$.slug'),
b AS (SELECT komik_id, list_distinct(list(CAST(genre_id AS VARCHAR))) AS g FROM komik_genres WHERE genre_id IS NOT NULL GROUP BY 1),
m AS (SELECT komik_id, len(list_intersect(a.g, b.g)) AS i, len(list_filter(a.g, lambda x: x IS NOT NULL)) + CASE WHEN list_contains(list_transform(a.g, lambda x: x IS NULL), true) THEN 1 ELSE 0 END AS na, len(b.g) AS nb FROM a JOIN b USING (komik_id))
SELECT komik_id, CASE WHEN i = na AND i = nb THEN 'ok' WHEN i > 0 THEN 'partial' ELSE 'miss' END AS verdict FROM m""")
def set_overlap(spark, folder):
    rows = _newest(spark, folder).join(table(spark, folder, "komik").select("slug", F.col("id").alias("komik_id")), "slug")
    own = rows.select("komik_id", F.filter(items(F.col("genre_ids")), lambda x: x.isNotNull()).alias("a"))
    stored = table(spark, folder, "komik_genres").filter("genre_id is not null").groupBy("komik_id").agg(F.collect_set(F.col("genre_id").cast("string")).alias("b"))
    return own.join(stored, "komik_id").select("komik_id", S.set_match(F.col("a"), F.col("b")).alias("verdict"))


@query(_REC + """, x AS (SELECT unnest(['author', 'artist']) AS field, unnest([d->>'$.author', d->>'$.artist']) AS a, unnest([author, artist]) AS b FROM n JOIN komik k ON k.slug = n.d->>'$.slug'),
w AS (SELECT field, CASE WHEN a IS NULL OR b IS NULL THEN 'miss' WHEN lower(trim(a, ' ')) = lower(trim(b, ' ')) THEN 'ok' ELSE 'mismatch' END AS v FROM x)
SELECT *, CASE WHEN n_match + n_mismatch + n_miss = 0 THEN 0 ELSE n_match * 100.0 / (n_match + n_mismatch + n_miss) END AS percent FROM (SELECT field, count(*) FILTER (v = 'ok') AS n_match, count(*) FILTER (v = 'mismatch') AS n_mismatch, count(*) FILTER (v = 'miss') AS n_miss FROM w GROUP BY 1)""")
def fuzzy_tally(spark, folder):
    stored = table(spark, folder, "komik").select("slug", F.col("author").alias("b_author"), F.col("artist").alias("b_artist"))
    rows = _newest(spark, folder).join(stored, "slug")
    cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("a"), F.col(f"b_{f}").alias("b")) for f in ("author", "artist")))
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "miss").when(S.fuzzy_equal(F.col("a"), F.col("b")), "ok").otherwise("mismatch")
    return evaluate.tally(rows.select(F.inline(cells)), "field", verdict)


@query("SELECT round(avg(chapter_count), 9) AS mean, round(coalesce(nullif(stddev_pop(chapter_count), 0), 1), 9) AS scale, count(*) AS n FROM komik")
def scaler_stats(spark, folder):
    from bindery.ml.model import scaler

    rows = table(spark, folder, "komik")
    mean, scale = scaler(rows.select(F.array("chapter_count").alias("features")), 1)
    return rows.agg(F.count(F.lit(1)).alias("n")).select(F.round(F.lit(mean[0]), 9).alias("mean"), F.round(F.lit(scale[0]), 9).alias("scale"), "n")


@query()
def scaler_features(spark, folder):
    """Mean and deviation of each of the 44 features over the elements of every page."""
    from bindery.ml.features import NAMES, features
    from bindery.ml.model import scaler

    mean, scale = scaler(features(pages(spark, folder), "line_id"), len(NAMES))
    return spark.createDataFrame([(n, round(m, 9), round(x, 9)) for n, m, x in zip(NAMES, mean, scale)], "feature string, mean double, scale double")


def _scored(spark, folder) -> DataFrame:
    """Series rated by themselves: does the rating tell that a series is complete?"""
    rows = table(spark, folder, "komik").filter("rating is not null and status_id is not null")
    return rows.select("tipe", F.round(F.col("rating") / 10, 2).alias("score"), (F.col("status_id") == 2).cast("int").alias("label"))


_SCORED = "WITH s AS (SELECT tipe, round(rating / 10, 2) AS score, CAST(status_id = 2 AS INT) AS label FROM komik WHERE rating IS NOT NULL AND status_id IS NOT NULL)"


@query(_SCORED + """, p AS (SELECT tipe, score, sum(label) AS p, count(*) AS n FROM s GROUP BY ALL),
c AS (SELECT tipe, score, sum(p) OVER (PARTITION BY tipe ORDER BY score DESC) AS tp, sum(n) OVER (PARTITION BY tipe ORDER BY score DESC) AS n, sum(p) OVER (PARTITION BY tipe) AS al FROM p),
b AS (SELECT tipe, max((2.0 * tp / nullif(n + al, 0), score)) AS m, max(al) AS al FROM c GROUP BY 1)
SELECT tipe, CASE WHEN al > 0 THEN greatest(least(m[2], 0.95), 0.1) ELSE 0.5 END AS threshold, round(CASE WHEN al > 0 THEN m[1] ELSE 0 END, 9) AS f1 FROM b""".replace("m[2]", "struct_extract(m, 2)").replace("m[1]", "struct_extract(m, 1)"))
def pr_thresholds(spark, folder):
    return evaluate.best_thresholds(_scored(spark, folder), group="tipe").withColumn("f1", F.round("f1", 9))


@query(_SCORED + """, c AS (SELECT tipe, count(*) FILTER (score > 0.7 AND label = 1) AS tp, count(*) FILTER (score > 0.7 AND label = 0) AS fp, count(*) FILTER (score <= 0.7 AND label = 1) AS fn, count(*) FILTER (score <= 0.7 AND label = 0) AS tn FROM s GROUP BY 1)
SELECT *, coalesce((tp + tn) * 1.0 / nullif(tp + fp + fn + tn, 0), 0) AS accuracy, coalesce(tp * 1.0 / nullif(tp + fp, 0), 0) AS precision, coalesce(tp * 1.0 / nullif(tp + fn, 0), 0) AS recall, coalesce(2.0 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1 FROM c""")
def confusion_metrics(spark, folder):
    return evaluate.confusion(_scored(spark, folder), F.col("score") > 0.7, F.col("label") == 1, "tipe")


@query("SELECT author, id, rating FROM komik WHERE rating > 5 AND author IS NOT NULL QUALIFY row_number() OVER (PARTITION BY author ORDER BY rating DESC, id) = 1")
def threshold_argmax(spark, folder):
    rows = table(spark, folder, "komik").filter("author is not null and rating is not null").select("author", "id", "rating")
    return evaluate.argmax(rows, "author", "rating", "id", F.lit(5.0))


@query("SELECT author, string_agg(slug, '|' ORDER BY rating DESC, id) AS slugs FROM komik WHERE rating > 8 AND author IS NOT NULL GROUP BY 1")
def multi_rank(spark, folder):
    rows = table(spark, folder, "komik").filter("author is not null and rating is not null").select("author", "id", "rating", "slug")
    found = evaluate.ranked(rows, "author", "rating", "id", F.lit(8.0))
    return found.select("author", F.array_join(F.transform("items", lambda x: x["slug"]), "|").alias("slugs"))


# --- pages ---------------------------------------------------------------------------------


def _escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """(line_id, html): the staged records as detail pages."""
    optional = lambda before, value, after: F.coalesce(F.concat(F.lit(before), _escaped(value), F.lit(after)), F.lit(""))
    link = lambda c: F.concat(F.lit('<li><span class="lchx"><a href="'), _escaped(c["url"]), F.lit('">Chapter '), c["number"], F.lit("</a></span>"))
    links = F.array_join(F.transform(objects(F.col("chapters"), "number", "url"), link), "")
    similar = F.array_join(F.transform(objects(F.col("similar"), "slug"), lambda s: F.coalesce(F.concat(F.lit(f'<li><a class="series" href="{SITE.series_path}'), _escaped(s["slug"]), F.lit('/">x</a>')), F.lit(""))), "")
    html = F.concat(
        F.lit("<html><body><h1 class=titless>Komik "), F.coalesce(_escaped(F.col("judul")), F.lit("")), F.lit('</h1><div class="spe">'),
        optional("<span><b>Pengarang:</b> ", F.col("author"), "</span>"), optional("<span><b>Ilustrator:</b> ", F.col("artist"), "</span>"),
        F.lit('</div><div class="rating"><i>'), F.coalesce(F.col("rating"), F.lit("")), F.lit('</i></div><div class="bxcl"><ul>'), links, F.lit('</ul></div><div id="mirip"><ul>'), similar, F.lit("</ul></div></body></html>"),
    )
    return _records(spark, folder).select("line_id", html.alias("html"))


@query(_REC + f""", c AS (SELECT line_id, e->>'$.url' AS url, try_cast(e->>'$.number' AS DOUBLE) AS number, pos FROM (SELECT line_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT line_id, {_array('chapters')} AS l FROM r)) WHERE json_type(e) = 'OBJECT'),
u AS (SELECT line_id, CASE WHEN url LIKE '/%' THEN '{SITE.base_url}' || url ELSE url END AS url, number, pos FROM c WHERE url IS NOT NULL AND number IS NOT NULL AND contains(url, '-chapter-')),
f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY line_id, url ORDER BY pos) = 1),
a AS (SELECT line_id, count(*) AS n_chapters, max(number) AS latest FROM f GROUP BY 1)
SELECT r.line_id, nullif(trim(d->>'$.author', ' '), '') AS author, nullif(trim(d->>'$.artist', ' '), '') AS artist, try_cast(d->>'$.rating' AS DOUBLE) AS rating, a.n_chapters, a.latest FROM r JOIN a ON a.line_id = r.line_id""")
def page_details(spark, folder):
    found = extract.details(pages(spark, folder), "line_id", SITE)
    marked = F.filter("chapters", lambda c: c["url"].contains(SITE.chapter_mark))
    return found.select("line_id", S.or_null(F.col("author")).alias("author"), S.or_null(F.col("artist")).alias("artist"), "rating", F.size(marked).cast("long").alias("n_chapters"), "latest_chapter_number").withColumnRenamed("latest_chapter_number", "latest").filter("n_chapters > 0")


def whole_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(line_id, html): the staged records as detail pages with every field that the extractor reads."""
    optional = lambda before, value, after: F.coalesce(F.concat(F.lit(before), _escaped(value), F.lit(after)), F.lit(""))
    link = lambda c: F.concat(F.lit('<li><span class="lchx"><a href="'), _escaped(c["url"]), F.lit('">Chapter '), c["number"], F.lit("</a></span>"))
    links = F.array_join(F.transform(objects(F.col("chapters"), "number", "url"), link), "")
    tags = F.array_join(F.transform(items(F.col("genre_list")), lambda g: F.concat(F.lit('<a rel="tag">'), _escaped(g), F.lit("</a>"))), "")
    host = F.coalesce(lookup({str(n): d for d, n in SITE.domains.items()}, F.col("thumb_domain_id")), F.lit("else.example"))
    image = F.concat(F.lit("https://"), host, F.lit("/data/wp-content/uploads/Komik-"), F.col("thumb_path"))
    html = F.concat(
        F.lit("<html><body>"), optional('<div class="thumb"><img src="', image, '"></div>'), F.lit("<h1 class=titless>Komik "), F.coalesce(_escaped(F.col("judul")), F.lit("")), F.lit('</h1><div class="spe">'),
        *(optional(f"<span><b>{label}:</b> ", value, "</span>") for label, value in (("Status", F.nullif(status_name(SITE, F.col("status_id").try_cast("int")), F.lit(""))), ("Tipe", F.col("tipe")), ("Pengarang", F.col("author")), ("Ilustrator", F.col("artist")), ("Alternatif", F.col("alternative_title")))),
        F.lit('</div><div class="genre-info">'), tags, F.lit('</div><div class="rating"><i>'), F.coalesce(F.col("rating"), F.lit("")), F.lit("</i></div>"),
        optional('<div class="entry-content"><p>', F.col("sinopsis"), "</p></div>"), F.lit('<div class="bxcl"><ul>'), links, F.lit("</ul></div></body></html>"),
    )
    return _records(spark, folder).select("line_id", html.alias("html"))


_EDGES = r"'^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g'"
_HOSTS = ", ".join(f"'{n}'" for n in SITE.domains.values())


@query(_REC + f""", c AS (SELECT line_id, e->>'$.url' AS url, try_cast(e->>'$.number' AS DOUBLE) AS number, pos FROM (SELECT line_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT line_id, {_array('chapters')} AS l FROM r)) WHERE json_type(e) = 'OBJECT'),
u AS (SELECT line_id, CASE WHEN url LIKE '/%' THEN '{SITE.base_url}' || url ELSE url END AS url, number, pos, contains(url, '{SITE.chapter_mark}') AS marked FROM c WHERE url <> '' AND number IS NOT NULL),
f AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY line_id, url ORDER BY pos) = 1),
w AS (SELECT * FROM f QUALIFY marked OR NOT bool_or(marked) OVER (PARTITION BY line_id)),
a AS (SELECT line_id, count(*) AS n_chapters, max(number) AS latest FROM w GROUP BY 1),
g AS (SELECT line_id, string_agg(t, '|' ORDER BY pos) AS genres FROM (SELECT line_id, regexp_replace(e->>'$', '^\\s+|\\s+$', '', 'g') AS t, pos FROM (SELECT line_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT line_id, {_array('genre_list')} AS l FROM r))) WHERE t <> '' GROUP BY 1)
SELECT r.line_id, regexp_replace(coalesce(d->>'$.judul', ''), {_EDGES}) AS judul, nullif(trim(d->>'$.tipe'), '') AS tipe, nullif(trim(d->>'$.author'), '') AS author, nullif(trim(d->>'$.artist'), '') AS artist,
CASE WHEN try_cast(d->>'$.status_id' AS INT) IN (1, 2) THEN try_cast(d->>'$.status_id' AS INT) END AS status_id, nullif(regexp_replace(regexp_replace(d->>'$.alternative_title', '^ +', ''), '\\s+$', ''), '') AS alternative_title,
nullif(regexp_replace(regexp_replace(regexp_replace(d->>'$.sinopsis', '^\\s+', ''), '^(Manga|Manhwa|Manhua)\\s+', ''), {_EDGES}), '') AS sinopsis, try_cast(d->>'$.rating' AS DOUBLE) AS rating, coalesce(genres, '') AS genres,
CASE WHEN d->>'$.thumb_path' IS NULL THEN NULL WHEN d->>'$.thumb_domain_id' IN ({_HOSTS}) THEN CAST(d->>'$.thumb_domain_id' AS INT) ELSE 0 END AS thumb_domain_id,
CASE WHEN d->>'$.thumb_domain_id' IN ({_HOSTS}) THEN regexp_replace(d->>'$.thumb_path', '-\\d+x\\d+\\.', '.') ELSE 'https://else.example/data/wp-content/uploads/Komik-' || (d->>'$.thumb_path') END AS thumb_path,
coalesce(a.n_chapters, 0) AS n_chapters, a.latest FROM r LEFT JOIN a ON a.line_id = r.line_id LEFT JOIN g ON g.line_id = r.line_id WHERE d->>'$.slug' IS NOT NULL""")
def page_records(spark, folder):
    """Every field of every record's page, also of pages without chapters."""
    found = extract.details(whole_pages(spark, folder), "line_id", SITE)
    told = (S.or_null(F.col(n)).alias(n) for n in ("tipe", "author", "artist", "alternative_title", "sinopsis"))
    return found.select("line_id", "judul", *told, F.col("status_id").cast("int").alias("status_id"), "rating", F.array_join("genre_list", "|").alias("genres"), F.col("thumb_domain_id").cast("int").alias("thumb_domain_id"), "thumb_path", F.size("chapters").cast("long").alias("n_chapters"), F.col("latest_chapter_number").alias("latest"))


@query(_REC + f""", s AS (SELECT line_id, pos, CASE WHEN json_type(e) = 'OBJECT' THEN e->>'$.slug' ELSE e->>'$' END AS slug FROM (SELECT line_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT line_id, {_array('similar')} AS l FROM r)) WHERE json_type(e) <> 'NULL')
SELECT line_id, split_part(slug, '/', 1) AS slug FROM s WHERE slug IS NOT NULL AND slug <> '' GROUP BY ALL""")
def page_similar(spark, folder):
    return extract.details(pages(spark, folder), "line_id", SITE).select("line_id", F.explode("similar").alias("s")).select("line_id", "s.slug")


def _cards(spark: SparkSession, folder: str, html: Column) -> DataFrame:
    return _records(spark, folder).select("line_id", html.alias("html"))


_LISTED = _REC + f""", s AS (SELECT line_id, pos, split_part(CASE WHEN json_type(e) = 'OBJECT' THEN e->>'$.slug' ELSE e->>'$' END, '/', 1) AS slug FROM (SELECT line_id, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT line_id, {_array('similar')} AS l FROM r)) WHERE json_type(e) <> 'NULL'),
a AS (SELECT line_id, slug, min(pos) AS pos FROM s WHERE slug <> '' GROUP BY 1, 2)
"""


@query(_LISTED + "SELECT line_id, CAST(row_number() OVER (PARTITION BY line_id ORDER BY pos) - 1 AS INT) AS pos, slug FROM a")
def page_lists(spark, folder):
    """Slugs of list pages: the similar series of every record, as a page of links."""
    link = lambda s: F.coalesce(F.concat(F.lit(f'<p><a class="tip" href="{SITE.series_path}'), _escaped(s["slug"]), F.lit('/">x</a></p>')), F.lit(""))
    html = F.concat(F.lit('<div class="listupd">'), F.array_join(F.transform(objects(F.col("similar"), "slug"), link), ""), F.lit("</div>"))
    return extract.list_slugs(_cards(spark, folder, html), "line_id", SITE)


_NUMBERED = _REC + ", f AS (SELECT line_id, line_no, d->>'$.slug' AS slug, d->>'$.tipe' AS tipe, d->>'$.thumb_path' AS thumb, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS number FROM r WHERE d->>'$.slug' IS NOT NULL) "


@query(_NUMBERED + "SELECT line_id, slug, number AS chapter_number, CAST(line_no AS BIGINT) AS minutes FROM f WHERE number IS NOT NULL")
def page_feeds(spark, folder):
    """Cards of feed pages: every record that has a latest number, as many minutes old as its line number."""
    number = S.number(F.col("latest_chapter_number")).cast("string")
    card = F.concat(F.lit(f'<div class="animepost"><h3><a href="{SITE.series_path}'), _escaped(F.col("slug")), F.lit('/">x</a></h3><div class="lsch"><a href="/x-chapter-'), number, F.lit('/">y</a><span class="datech">'), F.col("line_no").cast("string"), F.lit(" menit lalu</span></div></div>"))
    return extract.latest_feed(_cards(spark, folder, card), "line_id", SITE).select("line_id", "slug", "chapter_number", F.col("minutes").cast("long").alias("minutes"))


@query(_NUMBERED + "SELECT line_id, slug, number AS latest, nullif(split_part(trim(tipe), ' ', 1), '') AS tipe, nullif(thumb, '') AS thumbnail FROM f")
def page_homes(spark, folder):
    """Cards of home pages: every record."""
    optional = lambda before, value, after: F.coalesce(F.concat(F.lit(before), _escaped(value), F.lit(after)), F.lit(""))
    card = F.concat(
        F.lit('<div class="listupd"><div class="animepost">'), optional('<div class="limit"><img src="', F.col("thumb_path"), '"></div>'), optional('<span class="typeflag ', F.col("tipe"), '"></span>'),
        F.lit(f'<h3><a href="{SITE.series_path}'), _escaped(F.col("slug")), F.lit('/">x</a></h3>'), optional('<a href="/x-chapter-', S.number(F.col("latest_chapter_number")).cast("string"), '/">y</a>'), F.lit("</div></div>"),
    )
    found = extract.home_updates(_cards(spark, folder, card), "line_id", SITE)
    return found.select("line_id", "slug", F.col("latest_chapter_number").alias("latest"), S.or_null(F.col("tipe")).alias("tipe"), S.or_null(F.col("thumbnail")).alias("thumbnail"))


@query("SELECT id, CAST(CASE WHEN total_images > 0 THEN 3 ELSE 0 END AS INT) AS domain_id, CASE WHEN total_images > 0 THEN 'data/' || id ELSE '' END AS prefix, CAST(coalesce(total_images, 0) AS INT) AS n_images, CASE WHEN total_images > 0 THEN '001' END AS first_name FROM chapters")
def page_readers(spark, folder):
    """Images of reader pages: every chapter, with as many images as it has."""
    n = F.coalesce(F.col("total_images").cast("int"), F.lit(0))
    images = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda i: F.concat(F.lit('<img src="https://img.komikraya.example/data/'), F.col("id").cast("string"), F.lit("/"), F.lpad(i.cast("string"), 3, "0"), F.lit('.jpg">')))
    html = F.concat(F.lit('<div id="chimg-auh">'), F.array_join(images, ""), F.lit("</div>"))
    found = extract.chapter_images(spread(table(spark, folder, "chapters")).select("id", html.alias("html")), "id", SITE)
    return found.select("id", F.col("cdn_domain_id").cast("int").alias("domain_id"), F.col("cdn_path_prefix").alias("prefix"), F.col("total_images").cast("int").alias("n_images"), F.get("image_filenames", F.lit(0)).alias("first_name"))


# --- jobs ---------------------------------------------------------------------------------


def _store(spark: SparkSession) -> Store:
    """A new store in the folder for checkpoints, which executors share."""
    return Store(spark, f"{shared_folder(spark)}/store-{uuid.uuid4().hex}", parts=8)


def _staged_records(spark, folder) -> DataFrame:
    rows = _newest(spark, folder).filter("_status is null")
    chapters = F.transform(F.filter(objects(F.col("chapters"), "number", "url"), lambda c: c.isNotNull()), lambda c: F.struct(S.number(c["number"]).alias("number"), c["url"].alias("url")))
    ids = F.filter(F.transform(items(F.col("genre_ids")), lambda g: g.try_cast("smallint")), lambda g: g.isNotNull())
    return rows.select("slug", "judul", "author", S.number(F.col("latest_chapter_number")).alias("latest_chapter_number"), chapters.alias("chapters"), ids.alias("genre_ids"))


_LOADED = _REC + f""", v2 AS (SELECT * FROM n WHERE d->>'$._status' IS NULL),
c AS (SELECT slug, try_cast(e->>'$.number' AS DOUBLE) AS number, e->>'$.url' AS url, pos FROM (SELECT d->>'$.slug' AS slug, unnest(l) AS e, unnest(range(len(l))) AS pos FROM (SELECT d, {_array('chapters')} AS l FROM v2)) WHERE json_type(e) = 'OBJECT'),
x AS (SELECT slug, number, url FROM c WHERE number IS NOT NULL QUALIFY row_number() OVER (PARTITION BY slug, number ORDER BY pos) = 1)
"""


@query(_LOADED + "SELECT row_number() OVER (ORDER BY d->>'$.slug') AS id, d->>'$.slug' AS slug, coalesce(nullif(d->>'$.judul', ''), d->>'$.slug') AS judul, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS latest FROM v2")
def job_load(spark, folder):
    """Load of all staged records into an empty store, twice: the second load changes no id."""
    store = _store(spark)
    store.setup()
    rows = _staged_records(spark, folder)
    load(rows, store)
    load(rows, store)
    return store.table("series").select("id", "slug", "judul", F.col("latest_chapter_number").alias("latest"))


@query(_LOADED + "SELECT x.slug, number, url FROM x")
def job_load_chapters(spark, folder):
    store = _store(spark)
    store.setup()
    load(_staged_records(spark, folder), store)
    names = store.table("series").select(F.col("id").alias("series_id"), "slug")
    return store.table("chapters").join(names, "series_id").select("slug", F.col("chapter_number").alias("number"), F.col("chapter_url").alias("url"))


@query(_LOADED + "SELECT 'upload' AS operation, 'completed' AS status, count(*) AS total_processed, count(*) AS total_new, CAST(0 AS BIGINT) AS total_updated FROM v2")
def job_log(spark, folder):
    """The log row of a load."""
    store = _store(spark)
    store.setup()
    load(_staged_records(spark, folder), store)
    return store.last_run().select("operation", "status", "total_processed", "total_new", "total_updated")


@query(_LOADED + """, u AS (SELECT d->>'$.slug' AS slug, try_cast(d->>'$.latest_chapter_number' AS DOUBLE) AS own, (SELECT max(chapter_number) FROM chapters JOIN komik ON komik.id = komik_id WHERE komik.slug = d->>'$.slug') AS seen FROM v2)
SELECT slug, greatest(own, seen) AS latest FROM u""")
def job_raise(spark, folder):
    """Latest numbers of a loaded store, raised to those of the stored chapters in the parts that they touch."""
    store = _store(spark)
    store.setup()
    load(_staged_records(spark, folder), store)
    names = table(spark, folder, "komik").select(F.col("id").alias("komik_id"), "slug")
    raise_latest(table(spark, folder, "chapters").join(names, "komik_id").select("slug", F.col("chapter_number").alias("latest_chapter_number")), store)
    return store.table("series").select("slug", F.col("latest_chapter_number").alias("latest"))


@query(_REC + f""", w AS (SELECT * FROM r WHERE d->>'$.slug' IS NOT NULL),
p AS (SELECT count(*) AS n, count(d->>'$.author') + count(d->>'$.artist') AS told FROM w),
c AS (SELECT count(*) AS n FROM (SELECT unnest(l) AS e FROM (SELECT {_array('chapters')} AS l FROM w)) WHERE json_type(e) = 'OBJECT' AND e->>'$.url' IS NOT NULL AND e->>'$.number' IS NOT NULL),
s AS (SELECT count(*) AS n FROM (SELECT unnest(l) AS e FROM (SELECT {_array('similar')} AS l FROM w)) WHERE json_type(e) <> 'NULL' AND CASE WHEN json_type(e) = 'OBJECT' THEN e->>'$.slug' ELSE e->>'$' END IS NOT NULL),
t AS (SELECT unnest(['html', 'body', 'h1', 'div', 'i', 'ul', 'b', 'span', 'li', 'a']) AS tag, unnest([p.n, p.n, p.n, 4 * p.n, p.n, 2 * p.n, p.told, p.told + c.n, c.n + s.n, c.n + s.n]) AS n,
  unnest([0, 1, 2, 2, 3, 3, 4, CASE WHEN c.n > 0 THEN 5 ELSE 3 END, 4, CASE WHEN c.n > 0 THEN 6 ELSE 5 END]) AS deepest FROM p, c, s)
SELECT * FROM t WHERE n > 0""")
def page_elements(spark, folder):
    """Elements of every page by tag."""
    return node_table(with_dom(pages(spark, folder)), "line_id").groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.max("depth").alias("deepest"))


@query()
def page_features(spark, folder):
    """Sum of each feature over the elements of every page."""
    from bindery.ml.features import NAMES, features

    rows = features(pages(spark, folder), "line_id")
    return rows.agg(*(F.round(F.sum(F.col("features")[i].cast("double")), 3).alias(n) for i, n in enumerate(NAMES)))


@query("SELECT table_name AS tbl, column_name AS col, CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'TIMESTAMP_NS' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(data_type) END AS type FROM duckdb_columns() WHERE table_name IN ('komik', 'chapters', 'komik_genres')")
def schema_columns(spark, folder):
    rows = [(t, f.name, f.dataType.simpleString()) for t in ("komik", "chapters", "komik_genres") for f in table(spark, folder, t).schema.fields]
    return spark.createDataFrame(rows, "tbl string, col string, type string")
