"""A store of Parquet tables with versions: a write makes new folders, a numbered pointer file names what is current.

The pointer with the highest number that is complete counts. A write claims the
next number by creating its file, which must not be there yet; so readers of the
old version are never disturbed, a write that breaks at any point leaves the old
state, all tables of one load change together, and of two writers one fails.

Tables with a key are kept in parts by its hash; `patch` writes only the parts it
touches. `vacuum` removes what no recent pointer names.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.operators.read import last_row
from bindery.schemas import TABLES

#: Parts of a keyed table; how long (seconds) an incomplete pointer counts as another writer at work.
PARTS, LEASE = 64, 600
KEYS = {"series": "slug", "chapters": "series_id", "series_genres": "series_id"}


class Store:
    def __init__(self, spark: SparkSession, root: str, parts: int = PARTS, lease: float = LEASE) -> None:
        self.spark, self.root, self.parts, self.lease = spark, root.rstrip("/"), parts, lease
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- pointer ---
    def _pointers(self) -> list[tuple[int, dict | None, float]]:
        """(number, content or None if incomplete, time) of every pointer, latest first."""
        if not self._fs.exists(self._path(self.root)):
            return []
        found = []
        for status in self._fs.listStatus(self._path(self.root)):
            name = status.getPath().getName()
            if name.startswith("_pointer-") and name.endswith(".json"):
                stream = self._fs.open(status.getPath())
                try:
                    text = self.spark.sparkContext._jvm.scala.io.Source.fromInputStream(stream, "UTF-8").mkString()
                finally:
                    stream.close()
                try:
                    content = json.loads(text)["tables"]
                except (ValueError, KeyError, TypeError):
                    content = None
                found.append((int(name[9:-5]), content, status.getModificationTime() / 1000))
        return sorted(found, key=lambda x: -x[0])

    def _pointer(self) -> tuple[int, dict]:
        return next(((n, content) for n, content, _ in self._pointers() if content is not None), (0, {}))

    def _flip(self, read: int, tables: dict) -> None:
        """Name new versions, as follower of the pointer that was read."""
        number = read + 1
        for n, content, at in sorted(self._pointers()):
            if n >= number:
                if content is not None or time.time() - at < self.lease:
                    raise RuntimeError("another writer has changed the store")
                number = n + 1
        stream = self._fs.create(self._path(f"{self.root}/_pointer-{number:012d}.json"), False)
        stream.write(bytearray(json.dumps({"tables": tables}), "utf-8"))
        stream.close()

    # --- tables ---
    def setup(self) -> None:
        """Make missing tables, empty; tables that are there stay."""
        have = self._pointer()[1]
        missing = {t: self.spark.createDataFrame([], schema) for t, schema in TABLES.items() if t not in have}
        if missing:
            self.replace(missing)

    def _part(self, name: str):
        return F.pmod(F.xxhash64(KEYS[name]), F.lit(self.parts).cast("long")).cast("int")

    def _write(self, name: str, df: DataFrame, stamp: str) -> None:
        if name in KEYS:
            df.withColumn("_part", self._part(name)).write.partitionBy("_part").parquet(f"{self.root}/{name}/{stamp}")
        else:
            df.write.parquet(f"{self.root}/{name}/{stamp}")

    def replace(self, tables: dict[str, DataFrame]) -> None:
        """Write new versions of some tables, then name them all at once."""
        (number, pointer), stamp = self._pointer(), f"v{time.time_ns()}"
        for name, df in tables.items():
            self._write(name, df, stamp)
            pointer = pointer | {name: {stamp: None}}
        self._flip(number, pointer)

    def touched(self, name: str, keys: DataFrame) -> list[int]:
        """The parts of a table that hold some keys; `keys` has the table's key column."""
        return sorted(r[0] for r in keys.select(self._part(name)).distinct().collect())

    def patch(self, name: str, df: DataFrame, parts: list[int]) -> None:
        """Write some parts of a table anew; `df` has all their rows. Other parts stay where they are."""
        if parts:
            (number, pointer), stamp = self._pointer(), f"v{time.time_ns()}"
            self._write(name, df, stamp)
            old = {s: sorted(set(range(self.parts) if ps is None else ps) - set(parts)) for s, ps in pointer[name].items()}
            self._flip(number, pointer | {name: {s: ps for s, ps in old.items() if ps} | {stamp: sorted(parts)}})

    def table(self, name: str, parts: list[int] | None = None) -> DataFrame:
        """The current version, or some parts of it; columns that an older version lacks are null."""
        reader, whole = self.spark.read, None
        for stamp, own in self._pointer()[1][name].items():
            source = reader.schema(TABLES[name] + (", _part int" if name in KEYS else "")) if name in TABLES else reader
            read = source.parquet(f"{self.root}/{name}/{stamp}")
            if name in KEYS:
                wanted = set(range(self.parts) if own is None else own) & set(range(self.parts) if parts is None else parts)
                read = read.filter(F.col("_part").isin(sorted(wanted))).drop("_part")
            whole = read if whole is None else whole.unionByName(read)
        return whole

    def reset(self) -> None:
        """All tables become empty."""
        self.replace({t: self.spark.createDataFrame([], schema) for t, schema in TABLES.items()})

    def drop(self) -> None:
        self._fs.delete(self._path(self.root), True)

    def vacuum(self, keep: int = 2) -> int:
        """Remove versions that none of the latest `keep` complete pointers names, and older pointers; returns how many folders went."""
        complete = [(n, content) for n, content, _ in self._pointers() if content is not None]
        named = {(t, s) for _, content in complete[:keep] for t, stamps in content.items() for s in stamps}
        gone = 0
        for table in {t for _, content in complete for t in content}:
            at = self._path(f"{self.root}/{table}")
            for status in self._fs.listStatus(at) if self._fs.exists(at) else []:
                if (table, status.getPath().getName()) not in named and time.time() - status.getModificationTime() / 1000 >= self.lease:
                    gone += bool(self._fs.delete(status.getPath(), True))
        for n, _ in complete[keep:]:
            self._fs.delete(self._path(f"{self.root}/_pointer-{n:012d}.json"), False)
        return gone

    def columns(self, name: str) -> DataFrame:
        """(column, type, nullable, place) of a table; an unknown name is an error."""
        if name not in TABLES:
            raise ValueError(f"no such table: {name}")
        rows = [(f.name, f.dataType.simpleString(), f.nullable, i) for i, f in enumerate(self.table(name).schema.fields)]
        return self.spark.createDataFrame(rows, "column string, type string, nullable boolean, place int")

    # --- run log ---
    def log(self, operation: str, status: str, processed: int = 0, new: int = 0, updated: int = 0, failed: int = 0, details: str | None = None) -> None:
        row = self.spark.createDataFrame([(operation, status, processed, new, updated, failed, details)], TABLES["run_log"].rsplit(", ", 1)[0]).withColumn("created_at", F.current_timestamp())
        row.write.mode("append").parquet(f"{self.root}/run_log/{next(iter(self._pointer()[1]['run_log']))}")

    def last_run(self) -> DataFrame:
        return last_row(self.table("run_log"), "created_at")
