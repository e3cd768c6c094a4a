"""The folder that driver and executors share, and tables kept in it."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, the session must be local (tests): a
    temporary folder is set."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return str(kept.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairloom-"))
    return folder(spark)


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that is no table's yet."""
    return f"{folder(spark)}/pairloom-{uuid.uuid4().hex[:12]}-{name}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a path with Hadoop's file system; a session that has ended is left alone."""
    if spark.sparkContext._jsc is None or spark.sparkContext._jvm is None:
        return
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_kept: list[tuple[SparkSession, str]] = []


def _discard_all() -> None:
    while _kept:
        discard(*_kept.pop())


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once, as a Parquet table in the shared folder, its lineage cut; the table
    goes when the driver ends, or by ``discard``."""
    spark = df.sparkSession
    if not _kept:
        atexit.register(_discard_all)
    path = fresh(spark, "kept")
    _kept.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
