"""Optional relational source and sink over JDBC; options, with credentials, come from the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def pooled(url: str) -> str:
    """The address with the session port in place of the transaction pooler's."""
    return url.replace(":6543/", ":5432/")


def read(spark: SparkSession, table: str, **options: str) -> DataFrame:
    """Give partitionColumn, lowerBound, upperBound and numPartitions for a large table."""
    return spark.read.format("jdbc").options(dbtable=table, **options).load()


def write(df: DataFrame, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").options(dbtable=table, **({"batchsize": "1000"} | options)).mode(mode).save()
