"""Delimited and JSON sources (S3-S8, S10, S15, P14), read with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.image import opens
from ..functions.text import shard_text_repair
from ..schemas import CANDIDATE, DATAPOINTS, DATASET

#: Order of the columns in the tab-separated candidate files.
CANDIDATE_COLUMNS = [f.name for f in CANDIDATE.fields]


def pipe_csv(spark: SparkSession, path: str, schema: T.StructType = DATASET) -> DataFrame:
    """S3, K2: bar-separated with a header; malformed lines are dropped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").csv(path, sep="|", header=True, multiLine=True, escape='"')


def tab_txt(spark: SparkSession, path: str, schema: T.StructType = CANDIDATE) -> DataFrame:
    """Tab-separated without a header; lines with a NUL byte are dropped."""
    lines = spark.read.text(path).where(~F.col("value").contains("\0"))
    fields = F.split("value", "\t", -1)
    good = lines.where(F.size(fields) == len(schema.fields))
    return good.select(*(fields[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)))


def datapoints(spark: SparkSession, path: str) -> DataFrame:
    """Epoch seconds and three counts; ``ts`` in UTC (the session's zone is UTC)."""
    return spark.read.schema(DATAPOINTS).csv(path, sep="\t").withColumn("ts", F.timestamp_seconds("epoch"))


LOG = r"^\[(\d{4}/\d{2}/\d{2}_\d{2}:\d{2})\] \S+ (\d+) \S+ (\d+) \S+ (\d+) \S+ (\d+)(?: \S+)?$"


def filter_log(spark: SparkSession, path: str) -> DataFrame:
    """Ts and the numbers of a space-separated log whose words are labels."""
    part = lambda i: F.regexp_extract("value", LOG, i)
    lines = spark.read.text(path).where(F.col("value").rlike(LOG))
    names = ("unique_pairs", "total", "clipped", "failed")
    return lines.select(F.to_timestamp(part(1), "yyyy/MM/dd_HH:mm").alias("ts"), *(part(i + 2).cast("long").alias(n) for i, n in enumerate(names)))


def parquet_tree(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All Parquet files under a folder."""
    reader = spark.read.option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).parquet(path)


def json_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON result files."""
    return spark.read.schema(schema).json(path, multiLine=True)


def shard_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Whole files, repaired (a newline before a bar) and then parsed as S3; the first
    line is the header."""
    lines = spark.read.text(path, wholetext=True).select(F.explode(F.split(shard_text_repair("value"), "\n")).alias("line"))
    header = "|".join(f.name for f in schema.fields)
    rows = lines.where((F.col("line") != "") & (F.col("line") != header))
    return rows.select(F.from_csv("line", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields), {"sep": "|"}).alias("r")).select("r.*")


def openable(df: DataFrame, content: str = "content") -> DataFrame:
    """The rows whose image opens."""
    return df.where(opens(content))


def flattened(df: DataFrame, column: str, schema: str) -> DataFrame:
    """A JSON column's fields as columns, nested ones under dotted names."""
    parsed = df.select(F.from_json(column, schema).alias("j"))

    def leaves(kind: T.StructType, path: str, name: str):
        for f in kind.fields:
            at, label = f"{path}.`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, at, f"{label}.")
            else:
                yield F.col(at).alias(label)

    return parsed.select(*leaves(parsed.schema["j"].dataType, "j", ""))
