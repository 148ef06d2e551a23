"""Streaming twins: staged lines, deduplicated items, change detection into a store."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.operators import feed, merge
from bindery.plans.store import Store
from bindery.runtime import cut
from bindery.schemas import STAGED


def staged(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """The stream of staged records of a folder, with their file and block; bad lines stay visible in _corrupt."""
    rows = spark.readStream.schema(f"{STAGED}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").option("maxFilesPerTrigger", files_per_batch).json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"))


def parquet(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def event_time(items: DataFrame, seen_at: str, minutes: str) -> DataFrame:
    """`items` with event_ts: when the item appeared, by its age when seen."""
    return items.withColumn("event_ts", F.col(seen_at).cast("timestamp") - F.make_dt_interval(mins=F.col(minutes).cast("int")))


def deduplicated(items: DataFrame, keys: list[str], event_ts: str = "event_ts", late: str = "6 hours") -> DataFrame:
    """Each key once within the watermark; later items are dropped as late."""
    return items.withWatermark(event_ts, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(items: DataFrame, by: str, event_ts: str = "event_ts", late: str = "6 hours", width: str = "6 hours") -> DataFrame:
    return items.withWatermark(event_ts, late).groupBy(F.window(event_ts, width), by).agg(F.count(F.lit(1)).alias("n"))


def into_store(items: DataFrame, store: Store, checkpoint: str, trigger: dict | None = None, on_batch: Callable[[DataFrame, int], None] | None = None):
    """Classify each micro-batch against the store and raise its latest numbers.

    The merge is monotone, so a batch that is tried again changes nothing more.
    trigger: {'availableNow': True} (default) or {'processingTime': '6 hours'}.
    """

    from bindery.plans.pipelines import raise_latest

    def run(batch: DataFrame, number: int) -> None:
        single = merge.last_wins(batch, ["slug"], ["number"])
        series = store.table("series")
        told = feed.classify(single, series.select("slug", F.col("latest_chapter_number").alias("latest")))
        if on_batch:
            on_batch(told, number)
        raise_latest(single.select("slug", F.col("number").alias("latest_chapter_number")), store)

    return items.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def load_staged(lines: DataFrame, store: Store, checkpoint: str, letters: str | None = None):
    """Load each micro-batch of staged records: of several of a slug the last by file and line.

    Corrupt lines and error rows go to the folder `letters`, one subfolder for a
    batch, so a batch that is tried again writes them once.
    """
    from bindery.plans.pipelines import load
    from bindery.sources import jsonl

    def run(batch: DataFrame, number: int) -> None:
        # Within a block rows keep the order of their lines.
        rows = cut(batch.withColumn("_row", F.monotonically_increasing_id()))
        if letters:
            jsonl.dead_letters(rows).write.mode("overwrite").json(f"{letters}/batch={number}")
        load(jsonl.newest_by_slug(jsonl.valid(rows), ["_file", "_block", "_row"]).drop("_file", "_block", "_row"), store)

    return lines.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
