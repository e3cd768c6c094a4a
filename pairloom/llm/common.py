"""What the corpus operators share: written tables in the shared folder, whole-text
word rules, and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the five ASCII controls.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows up to which a table of one short row per key may be broadcast (about 100 bytes each).
BROADCAST_ROWS = 100_000


#: Bytes of texts that a worker takes in at once.
SLICE_BYTES = 8 << 20

#: Bytes of a row group of large rows.
LARGE_BYTES = 16 << 20

_paths: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset, the session must be local (tests): a temporary folder is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    kept = spark.sparkContext._jsc.sc().getCheckpointDir()
    if kept.isDefined():
        return str(kept.get()).rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pairloom-"))
    return shared_dir(spark)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted by ``cleanup``, or when the driver ends."""
    path = f"{shared_dir(spark)}/pairloom-{uuid.uuid4().hex[:12]}-{name}"
    if not _paths:
        atexit.register(lambda: cleanup(SparkSession.getActiveSession() or spark))
    _paths.append(path)
    return path


def cleanup(spark: SparkSession) -> None:
    """Delete the tables written so far; results that still read them must be consumed first."""
    while _paths:
        delete(spark, _paths.pop())


def mark() -> int:
    """A place to give to ``discard``."""
    return len(_paths)


def discard(spark: SparkSession, since: int) -> None:
    """Delete the tables written since ``mark``, but the last; what read them must be written."""
    for path in _paths[since:-1]:
        delete(spark, path)
    del _paths[since:-1]


def delete(spark: SparkSession, path: str) -> None:
    """Delete a path with Hadoop's file system; a session that has ended is left alone."""
    jvm = spark.sparkContext._jvm
    if jvm is None or spark.sparkContext._jsc is None:
        return
    try:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as e:  # the gateway may be gone at exit
        print(f"pairloom: could not delete {path}: {type(e).__name__}")


def written(df: DataFrame, name: str, plain: bool = False, large: bool = False) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again.

    This cuts the lineage: what was computed is not computed again, and it outlives
    any executor.  A column of type void becomes a string.  ``plain``: without compression
    and dictionaries, for narrow tables of numbers.  The planner takes a file's size for
    the table's; sorted numbers compress so well that it would broadcast tables many
    times its threshold.  ``large``: for rows of megabytes.  A writer looks at the size of what it holds
    after 100 rows only, unless told; so it closes a row group of some ``LARGE_BYTES`` after any row.
    """
    spark = df.sparkSession
    df = df.withColumns({c: df[c].cast("string") for c, kind in df.dtypes if kind == "void"})
    path = new_path(spark, name)
    writer = df.write.option("compression", "none").option("parquet.enable.dictionary", "false") if plain else df.write.option("compression", "zstd")
    if large:
        writer = writer.option("parquet.page.size.row.check.min", "1").option("parquet.block.size", str(LARGE_BYTES))
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` (a written or otherwise cheap table) has at most ``rows`` rows."""
    return df.limit(rows + 1).count() <= rows


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is small; else as it is, for a shuffled join
    whose hot keys adaptive execution splits."""
    return F.broadcast(df) if small(df, rows) else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table as it is read, dealt out anew if that has fewer tasks than the cluster has cores, as
    one small file has.  Not for what comes behind a shuffle: asking for its tasks would run it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def text_or_empty(c: str | Column = "text") -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def word_count(text: str | Column) -> Column:
    """The number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slices(batches, rows: int = 256, size: int = SLICE_BYTES):
    """Arrow record batches cut to at most ``rows`` rows and some ``size`` bytes of strings
    and binaries (one row may be longer), to bound what Python holds."""
    for b in batches:
        held = np.zeros(b.num_rows, np.int64)
        for c in b.columns:
            if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
                held += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(held)
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(total, (total[i - 1] if i else 0) + size, "right"))
            j = min(max(j, i + 1), i + rows, b.num_rows)
            yield b.slice(i, j - i)
            i = j
