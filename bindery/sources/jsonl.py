"""Staging files: one JSON record per line, read with a fixed schema; what does not parse goes to dead letters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.operators.merge import last_wins
from bindery.schemas import STAGED


def read(spark: SparkSession, path: str) -> DataFrame:
    """Staged rows with _corrupt (the text of a bad line), _file and _row (ascending within a file)."""
    rows = spark.read.schema(f"{STAGED}, _corrupt string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))


def parse(lines: DataFrame, line: str = "line") -> DataFrame:
    """As `read`, of a column of lines; blank lines are left out."""
    parsed = F.from_json(F.col(line), f"{STAGED}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    kept = lines.filter(F.trim(F.col(line)) != "").withColumn("_r", parsed)
    return kept.select(*(c for c in lines.columns), "_r.*")


def valid(rows: DataFrame) -> DataFrame:
    """Records: neither corrupt, nor error rows, nor without slug; missing arrays are empty."""
    good = rows.filter("_corrupt is null and _status is null and slug is not null").drop("_corrupt", "_status", "_error")
    arrays = [f.name for f in good.schema.fields if f.dataType.typeName() == "array"]
    return good.withColumns({a: F.coalesce(F.col(a), F.array().cast(good.schema[a].dataType)) for a in arrays})


def dead_letters(rows: DataFrame) -> DataFrame:
    """(slug, reason, detail): corrupt lines and error rows."""
    bad = rows.filter("_corrupt is not null or _status is not null or slug is null")
    reason = F.when(F.col("_corrupt").isNotNull(), "corrupt").when(F.col("_status").isNotNull(), F.col("_status")).otherwise("no slug")
    return bad.select("slug", reason.alias("reason"), F.coalesce("_corrupt", "_error").alias("detail"))


def newest_by_slug(rows: DataFrame, order: list[str]) -> DataFrame:
    """Of several records of a slug the last."""
    return last_wins(rows, ["slug"], order)


def count(spark: SparkSession, path: str) -> int:
    return spark.read.text(path).count()


def last_slug(spark: SparkSession, path: str) -> str | None:
    """The slug of the last line that has one, over all files in order."""
    row = read(spark, path).filter("slug is not null").agg(F.max_by("slug", F.struct("_file", "_block", "_row")).alias("slug")).first()
    return row["slug"]


def latest_file(spark: SparkSession, path: str, pattern: str = "*.jsonl") -> str | None:
    """The file below `path` that was modified last (of equals the last by name); contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", "modificationTime")
    row = files.orderBy(F.col("modificationTime").desc(), F.col("path").desc()).first()
    return row["path"] if row else None


def append(records: DataFrame, path: str) -> None:
    records.write.mode("append").json(path)


def append_errors(errors: DataFrame, path: str) -> None:
    """Error rows (slug, _status, _error) to the same folder."""
    errors.select("slug", "_status", "_error").write.mode("append").json(path)
