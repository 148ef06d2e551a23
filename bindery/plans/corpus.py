"""Queries of the general data problems: nested records, packed fields, snapshots, references."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.operators import flatten, packed, references, snapshots
from bindery.runtime import spread
from bindery.sources.detail_lines import items, objects, records
from bindery.sources.tables import table


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.all_children(table(spark, folder, "detail_lines"))


def p3_chapters(spark: SparkSession, folder: str) -> DataFrame:
    return flatten.children(table(spark, folder, "detail_lines"), "chapters")


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = packed.unpack(table(spark, folder, "komik"), "id", "alternative_title")
    return rows.select(F.col("id").alias("komik_id"), "pos", "val")


def _deliveries(spark: SparkSession, folder: str) -> DataFrame:
    series, chapters = table(spark, folder, "komik_snapshots"), table(spark, folder, "chapter_snapshots")
    number = snapshots.number_text
    return snapshots.deliveries(series, "komik", "komik_id", [number(F.col("latest_chapter_number")), F.col("chapter_count").cast("string")]).unionByName(
        snapshots.deliveries(chapters, "chapters", "chapter_id", [number(F.col("chapter_number"))])
    )


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return snapshots.deltas(_deliveries(spark, folder))


def p5_counts(spark: SparkSession, folder: str) -> DataFrame:
    return p5_found(spark, folder).groupBy("rel", "snapshot_no", "delta").agg(F.count(F.lit(1)).alias("n"))


def _similar(spark: SparkSession, folder: str) -> DataFrame:
    rows = records(spread(table(spark, folder, "detail_lines")))
    slugs = F.transform(objects(F.col("rec.similar"), "slug"), lambda e: e["slug"])
    return rows.select(F.col("line_id").alias("parent_id"), F.explode(slugs).alias("ref_key"), F.col("fetched_at").alias("at"))


def _genres(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "komik_genres").select(F.col("komik_id").alias("parent_id"), F.col("genre_id").cast("string").alias("ref_key"), F.col("created_at").alias("at"))


def _referring(spark: SparkSession, folder: str) -> dict[str, tuple[DataFrame, DataFrame, DataFrame]]:
    """By table: its references, the parents that hold, the keys of deleted ones."""
    series = table(spark, folder, "komik").select(F.col("slug").alias("ref_key"), "created_at")
    taken = table(spark, folder, "komik_deleted").select(F.col("slug").alias("ref_key"))
    kinds = table(spark, folder, "genres").withColumn("ref_key", F.col("genre_id").cast("string"))
    used, unused = kinds.filter("deleted_at is null"), kinds.filter("deleted_at is not null")
    return {"similar": (_similar(spark, folder), series, taken), "komik_genres": (_genres(spark, folder), used, unused)}


def _by_table(spark: SparkSession, folder: str, operator) -> DataFrame:
    a, b = (operator(*tables).select(F.lit(rel).alias("rel"), "*") for rel, tables in _referring(spark, folder).items())
    return a.unionByName(b)


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return _by_table(spark, folder, references.orphans)


def p7_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Bad references and all distinct references per table and month."""
    return _by_table(spark, folder, references.orphans_and_counts)


QUERIES = {f.__name__: f for f in (p3_found, p3_chapters, p4_found, p5_found, p5_counts, p7_found, p7_counts)}

_STATE = """
WITH k AS (
  SELECT 'komik' AS rel, snapshot_no, komik_id AS rec_id, delivered_at,
         concat_ws('/', coalesce(CAST(try_cast(replace(trim(latest_chapter_number), ',', '.') AS DOUBLE) AS VARCHAR), 'null'), coalesce(CAST(chapter_count AS VARCHAR), 'null')) AS v
  FROM komik_snapshots
  UNION ALL
  SELECT 'chapters', snapshot_no, chapter_id, delivered_at,
         coalesce(CAST(try_cast(replace(trim(chapter_number), ',', '.') AS DOUBLE) AS VARCHAR), 'null')
  FROM chapter_snapshots),
s AS (SELECT rel, snapshot_no, rec_id, arg_max(v, delivered_at) AS v FROM k GROUP BY ALL),
n AS (SELECT rel, snapshot_no, lead(snapshot_no) OVER (PARTITION BY rel ORDER BY snapshot_no) AS nxt FROM (SELECT DISTINCT rel, snapshot_no FROM s)),
a AS (SELECT s.rel, n.nxt AS snapshot_no, rec_id, v FROM s JOIN n USING (rel, snapshot_no) WHERE nxt IS NOT NULL),
b AS (SELECT s.* FROM s JOIN n ON n.rel = s.rel AND n.nxt = s.snapshot_no),
f AS (
  SELECT coalesce(a.rel, b.rel) AS rel, coalesce(a.snapshot_no, b.snapshot_no) AS snapshot_no, coalesce(a.rec_id, b.rec_id) AS rec_id,
         CASE WHEN a.v IS NULL THEN 'added' WHEN b.v IS NULL THEN 'removed' ELSE 'changed' END AS delta
  FROM a FULL JOIN b ON a.rel = b.rel AND a.snapshot_no = b.snapshot_no AND a.rec_id = b.rec_id
  WHERE a.v IS DISTINCT FROM b.v)
"""

_RECORDS = """
WITH v AS (SELECT line_id, fetched_at, CAST(line AS JSON) AS j FROM detail_lines WHERE json_valid(line) AND ltrim(line) LIKE '{%'),
r AS (SELECT line_id, fetched_at, CASE WHEN j->>'$.slug' IS NOT NULL THEN j WHEN json_type(j->'$.data') = 'OBJECT' THEN j->'$.data' ELSE j->'$.payload.detail' END AS d FROM v),
"""


def _opened(child: str) -> str:
    """CTE `x_<child>`: (line_id, fetched_at, pos, e) of the elements of an array field."""
    return f"""
{child}_t AS (SELECT line_id, fetched_at, CASE WHEN json_type(d->'$.{child}') = 'VARCHAR' AND json_valid(d->>'$.{child}') THEN CAST(d->>'$.{child}' AS JSON) ELSE d->'$.{child}' END AS x FROM r),
{child}_a AS (SELECT line_id, fetched_at, CASE WHEN x IS NULL OR json_type(x) = 'NULL' THEN CAST([] AS JSON[]) WHEN json_type(x) = 'ARRAY' THEN CAST(x AS JSON[]) ELSE [x] END AS l FROM {child}_t),
x_{child} AS (SELECT line_id, fetched_at, unnest(range(len(l))) AS pos, unnest(l) AS e FROM {child}_a)
"""


_CHAPTERS = "SELECT line_id, 'chapters' AS child, CAST(-1 AS INT) AS parent_pos, CAST(pos AS INT) AS pos, e->>'$.url' AS child_key FROM x_chapters WHERE json_type(e) = 'OBJECT'"
_P7 = (
    _RECORDS
    + _opened("similar")
    + """,
s AS (SELECT line_id, fetched_at, CASE WHEN json_type(e) = 'OBJECT' THEN e->>'$.slug' ELSE e->>'$' END AS k FROM x_similar WHERE json_type(e) <> 'NULL'),
p AS (SELECT slug, min(created_at) AS c FROM komik WHERE slug IS NOT NULL GROUP BY 1),
f AS (SELECT 'similar' AS rel, line_id AS parent_id, k AS ref_key,
        CASE WHEN p.slug IS NULL THEN CASE WHEN k IN (SELECT slug FROM komik_deleted WHERE slug IS NOT NULL) THEN 'deleted' ELSE 'missing' END WHEN c > fetched_at THEN 'late' END AS why, strftime(fetched_at, '%Y-%m') AS ym
      FROM s LEFT JOIN p ON p.slug = s.k WHERE k IS NOT NULL
      UNION
      SELECT 'komik_genres', komik_id, CAST(x.genre_id AS VARCHAR),
        CASE WHEN g.genre_id IS NULL THEN 'missing' WHEN g.deleted_at IS NOT NULL THEN 'deleted' WHEN g.created_at > x.created_at THEN 'late' END, strftime(x.created_at, '%Y-%m')
      FROM komik_genres x LEFT JOIN genres g ON g.genre_id = x.genre_id WHERE x.genre_id IS NOT NULL)
"""
)

ORACLE = {
    "p3_chapters": _RECORDS + _opened("chapters") + _CHAPTERS,
    "p3_found": _RECORDS
    + ",".join(_opened(c) for c in ("chapters", "similar", "genre_ids"))
    + ", i AS (SELECT line_id, pos AS parent_pos, unnest(range(len(l))) AS pos, unnest(l) AS e FROM (SELECT line_id, pos, CAST(e->'$.image_filenames' AS JSON[]) AS l FROM x_chapters WHERE json_type(e->'$.image_filenames') = 'ARRAY')) "
    + _CHAPTERS
    + """ UNION ALL SELECT line_id, 'similar', -1, CAST(pos AS INT), CASE WHEN json_type(e) = 'OBJECT' THEN e->>'$.slug' ELSE e->>'$' END FROM x_similar WHERE json_type(e) <> 'NULL'
UNION ALL SELECT line_id, 'genre_ids', -1, CAST(pos AS INT), e->>'$' FROM x_genre_ids WHERE json_type(e) <> 'NULL'
UNION ALL SELECT line_id, 'image_filenames', CAST(parent_pos AS INT), CAST(pos AS INT), e->>'$' FROM i WHERE json_type(e) <> 'NULL'""",
    "p5_found": _STATE + "SELECT rel, snapshot_no, rec_id, delta FROM f",
    "p5_counts": _STATE + "SELECT rel, snapshot_no, delta, count(*) AS n FROM f GROUP BY ALL",
    "p7_found": _P7 + "SELECT DISTINCT * FROM f WHERE why IS NOT NULL",
    "p7_counts": _P7
    + """, every AS (SELECT rel, ym, count(*) AS n_refs FROM f GROUP BY ALL)
SELECT f.rel, f.ym, why, count(*) AS n_bad, any_value(n_refs) AS n_refs FROM f JOIN every ON every.rel = f.rel AND every.ym = f.ym WHERE why IS NOT NULL GROUP BY ALL""",
}
