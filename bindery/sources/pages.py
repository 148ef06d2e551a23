"""Stored pages: a table (url, html, ...) or a folder of HTML files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.functions.scalars import response_fault


def files(spark: SparkSession, *folders: str) -> DataFrame:
    """(page_id, html) of the HTML files of some folders, whole; challenge pages are left out."""
    rows = spark.read.option("wholetext", True).option("pathGlobFilter", "*.html").text(list(folders))
    named = rows.select(F.col("_metadata.file_path").alias("page_id"), F.col("value").alias("html"))
    return named.filter(~F.coalesce(response_fault(F.lit(200), F.substring("html", 1, 2000)) == "challenge", F.lit(False)))


def wanted(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """The pages of a list of addresses; those that are missing have null html."""
    return urls.select("url").distinct().join(pages, "url", "left")


def judged(pages: DataFrame, status: str = "status", html: str = "html") -> DataFrame:
    """`pages` with fault: why a response is no content, else null."""
    return pages.withColumn("fault", response_fault(F.col(status), F.col(html)))


def fetch_stats(pages: DataFrame, attempts: str = "attempts", html: str = "html", fault: str = "fault") -> DataFrame:
    """(requests, success, failed, retries, bytes, success_rate); the rate is 0 without requests."""
    row = pages.agg(
        F.coalesce(F.sum(attempts), F.lit(0)).alias("requests"), F.count_if(F.col(fault).isNull()).alias("success"), F.count_if(F.col(fault).isNotNull()).alias("failed"),
        F.coalesce(F.sum(F.greatest(F.col(attempts) - 1, F.lit(0))), F.lit(0)).alias("retries"), F.coalesce(F.sum(F.octet_length(html)), F.lit(0)).alias("bytes"),
    )
    return row.withColumn("success_rate", F.coalesce(F.try_divide(F.col("success") * 100.0, F.col("success") + F.col("failed")), F.lit(0.0)))
