"""Sinks (K1-K12)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DOWNLOAD_CSV

ROUTE = "route"


def append_routed(df: DataFrame, path: str) -> None:
    """K1, K2: append, partitioned by route."""
    df.write.mode("append").partitionBy(ROUTE).parquet(path)


def pipe_csv(df: DataFrame, path: str) -> None:
    """K3, K4: bar-separated with a header."""
    df.write.mode("overwrite").option("escape", '"').csv(path, sep="|", header=True)


def legacy_download_csv(df: DataFrame, path: str) -> None:
    """K4 with the names of the old files, in which the labels of height and width are
    swapped."""
    swap = {"HEIGHT": "width", "WIDTH": "height"}
    pipe_csv(df.select(*(F.col(swap.get(f.name, f.name.lower())).cast(f.dataType).alias(f.name) for f in DOWNLOAD_CSV.fields)), path)


def scored(df: DataFrame, path: str, jobset: str) -> None:
    """K5: Parquet for nolang, else K4."""
    df.write.mode("overwrite").parquet(path) if jobset == "nolang" else pipe_csv(df, path)


def keys(df: DataFrame, path: str, column: str = "hash") -> None:
    """K6, K7: one key a line."""
    df.select(F.col(column).cast("string")).where(F.col(column).isNotNull()).write.mode("overwrite").text(path)


def tab_txt(df: DataFrame, path: str) -> None:
    """K8: tab-separated without header or quotes; nulls are empty."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    df.select(F.concat_ws("\t", *fields)).write.mode("overwrite").text(path)


def examples(meta: DataFrame, images: DataFrame, path: str, on: str = "path") -> None:
    """K9: (sample_id, image, format, label, height, width) as Parquet with the image's bytes."""
    meta.join(images.select(on, F.col("content").alias("image")), on).select("sample_id", "image", "format", F.col("text").alias("label"), "height", "width").write.mode("overwrite").parquet(path)


def embeddings(df: DataFrame, path: str) -> None:
    """By sample id, never by position."""
    df.select("sample_id", "embedding").write.mode("overwrite").parquet(path)


def dated(ts: str | Column, padded: bool = True) -> Column:
    """The date folder of a time, padded or not."""
    return F.date_format(ts, "yyyy-MM-dd" if padded else "yyyy-M-d")


def archive(df: DataFrame, path: str, ts: str) -> None:
    """Partitioned by date and hour."""
    parts = df.withColumns({"dt": F.date_format(ts, "yyyy-MM-dd"), "hr": F.date_format(ts, "HH")})
    parts.write.mode("append").partitionBy("dt", "hr").parquet(path)


def archive_class(path: str | Column) -> Column:
    """Where a file goes by its extension."""
    p = F.col(path) if isinstance(path, str) else path
    return F.when(p.endswith(".clp"), "clipped").when(p.endswith(".hsh"), "hashes").when(p.endswith(".gz"), "archive").when(p.endswith(".txt"), "text").otherwise("other")
