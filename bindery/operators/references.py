"""References to records that do not exist.

The references are written once as they are read. Their distinct keys (a hot key
collapses on the map side) are anti-joined with the parents, and the bad keys
joined back to the references.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.runtime import cut, small

SALT = 16


def orphans(refs: DataFrame, parents: DataFrame, deleted: DataFrame) -> DataFrame:
    """References whose key is missing, deleted or later than they are; distinct rows.

    refs: (parent_id, ref_key, at); parents: (ref_key, created_at); deleted: (ref_key).
    Null keys refer to nothing. A key in `deleted` counts as deleted only if no
    parent has it. Of several parents with one key the earliest counts. Nulls in
    `at` or `created_at` are never late; the period of a null `at` is null.
    Result: (parent_id, ref_key, why, ym).
    """
    refs = cut(refs.select("parent_id", "ref_key", "at").filter(F.col("ref_key").isNotNull()))
    return _orphans(refs, parents, deleted)


def orphans_and_counts(refs: DataFrame, parents: DataFrame, deleted: DataFrame) -> DataFrame:
    """(ym, why, n_bad, n_refs): distinct bad references, and all distinct references, per period; a period without bad ones has no row."""
    refs = cut(refs.select("parent_id", "ref_key", "at").filter(F.col("ref_key").isNotNull()))
    bad = _orphans(refs, parents, deleted).groupBy("ym", "why").agg(F.count(F.lit(1)).alias("n_bad"))
    every = refs.select("parent_id", "ref_key", F.date_format("at", "yyyy-MM").alias("y")).distinct().groupBy("y").agg(F.count(F.lit(1)).alias("n_refs"))
    return bad.join(every, F.col("ym").eqNullSafe(F.col("y")), "left").select("ym", "why", "n_bad", "n_refs")


def _orphans(refs: DataFrame, parents: DataFrame, deleted: DataFrame) -> DataFrame:
    keys = refs.groupBy("ref_key").agg(F.min("at").alias("first_at"))
    there = parents.filter(F.col("ref_key").isNotNull()).groupBy("ref_key").agg(F.min("created_at").alias("created_at"))
    gone = deleted.select("ref_key").filter(F.col("ref_key").isNotNull()).distinct().withColumn("gone", F.lit(True))
    absent = (
        keys.join(there, "ref_key", "left_anti")
        .join(gone, "ref_key", "left")
        .select("ref_key", F.when(F.col("gone"), "deleted").otherwise("missing").alias("why"), F.lit(None).cast("timestamp_ntz").alias("created_at"))
    )
    late = keys.join(there, "ref_key").filter(F.col("created_at") > F.col("first_at")).select("ref_key", F.lit("late").alias("why"), F.col("created_at").cast("timestamp_ntz"))
    bad = cut(absent.unionByName(late))
    if small(bad):
        joined = refs.join(F.broadcast(bad), "ref_key")
    else:
        salted = bad.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        joined = refs.withColumn("salt", F.pmod(F.hash("parent_id", "at"), F.lit(SALT))).join(salted, ["ref_key", "salt"])
    hit = joined.filter((F.col("why") != "late") | (F.col("created_at") > F.col("at")))
    return hit.select("parent_id", "ref_key", "why", F.date_format("at", "yyyy-MM").alias("ym")).distinct()
