"""Files as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.control import utilization
from ..functions.url import stem


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, mtime, n_bytes, stem) of the files under a folder; contents aren't read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path)
    return found.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("n_bytes"), stem("path").alias("stem"))


def older_than(df: DataFrame, seconds: int, ref: Column, mtime: str = "mtime") -> DataFrame:
    """By an explicit reference time, never the wall clock."""
    return df.where(F.col(mtime) <= ref - F.make_interval(secs=F.lit(seconds)))


def capacity(df: DataFrame, used: str = "used", total: str = "total") -> DataFrame:
    """The row with its utilization, as JSON."""
    return df.withColumn("utilization", utilization(used, total)).select(F.to_json(F.struct("*")).alias("json"))
