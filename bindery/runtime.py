"""Session, lineage cuts and size-checked broadcasts shared by all operators."""

from __future__ import annotations

import re
import sys
import tempfile
from collections.abc import Callable, Hashable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast by hint only up to this many rows, counted first.
BROADCAST_ROWS = 200_000


def session(cpus: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints: the session's (spark.checkpoint.dir); only a local session without one gets a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="bindery-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write `df` to the shared checkpoint folder and go on from the files."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether `df` has at most `rows` rows; stops counting just past the bound."""
    return df.limit(rows + 1).count() <= rows


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if its counted rows are within the bound, else as it is."""
    return F.broadcast(df) if small(df, rows) else df


def spread(df: DataFrame) -> DataFrame:
    """`df` over all cores if its scan has fewer than half as many partitions as there are cores.

    Only a table of a few files is moved; a scan of many splits stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 2 <= cores else df


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once, however often the body names it.

    Catalyst copies an expression into every lambda that names it; a lambda's own
    variable is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def kept(key: Hashable, make: Callable):
    """`make()`, once in a Python process, for as long as the process lives.

    Functions come to workers by value, so what a module keeps would be lost after each task.
    """
    store = sys.__dict__.setdefault("_bindery_kept", {})
    if key not in store:
        if len(store) >= 8:
            store.pop(next(iter(store)))
        store[key] = make()
    return store[key]
