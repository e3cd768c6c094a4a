"""Structured Streaming forms of the polling loops.

A file source with a checkpoint ingests each file once; a batch's effects are tables whose
folder is the batch's id, so a batch that is run again overwrites what it left.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.state import route


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 100) -> DataFrame:
    """Q4, Q7: new Parquet files, at most ``files_per_batch`` at once."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


#: The state store: state on the executors' disks, of which a checkpoint gets the changes.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def _conf(spark: SparkSession, settings: dict[str, str]):
    """The session with these settings; a query keeps those that it began with."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def first_of_key(stream: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Q6: a stream's rows whose key no earlier batch had, first by ``order`` within a batch; for output mode update.

    The state is a row a key, updated by the batch's keys alone: nothing seen is read
    again.  Each key has the first and last time of the batches that had it, and is new as long as these
    are one.  A batch's time comes from its offset log, so a batch that is run again has it again.  No two batches
    may have the same time in milliseconds.
    """
    rest = [F.col(c) for c in stream.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)) if rest or order else F.min(F.struct(F.lit(0)))
    timed = stream.where(F.col(key).isNotNull()).withColumn("__at", F.current_timestamp())
    got = timed.groupBy(key).agg(first.alias("__row"), F.min("__at").alias("__from"), F.max("__at").alias("__to"))
    return got.where("__from = __to").select(*(F.col(c) if c == key else F.col(f"__row.{c}").alias(c) for c in stream.columns))


def dedup_once(stream: DataFrame, key: str, order: list[str], out: str, checkpoint: str, trigger: dict | None = None):
    """Q6: ``first_of_key`` into tables: batch n goes to ``out/batch=n`` and is overwritten if it
    is run again, from the state before it.  A batch takes the time of its own rows."""

    def batch(df: DataFrame, n: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={n}")

    with _conf(stream.sparkSession, ROCKSDB):
        found = first_of_key(stream, key, order)
        return found.writeStream.outputMode("update").foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def seen_rows(spark: SparkSession, out: str, schema) -> DataFrame | None:
    """All kept rows with their batch; None before the first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(out)


def routed(stream: DataFrame, language: str = "language") -> DataFrame:
    """D1 on a stream: each row's route; no state."""
    return stream.withColumn("route", route(language))


def to_memory(stream: DataFrame, name: str, checkpoint: str):
    """A test's sink: everything available, into a table in memory."""
    return stream.writeStream.format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
