"""Counts, ratios and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from . import ranges
from .state import route


def pending(table: DataFrame, by: list[str] | None = None, status: str = "status") -> DataFrame:
    """A1."""
    return table.groupBy(*(by or [])).agg(F.count_if(F.col(status) == 0).alias("pending"))


def language_counts(df: DataFrame, by: list[str] | None = None, language: str = "language") -> DataFrame:
    """A2."""
    r = route(language)
    return df.groupBy(*(by or [])).agg(*(F.count_if(r == k).alias(k) for k in ("en", "intl", "nolang")))


def kept_and_seen(df: DataFrame, seen: Column) -> DataFrame:
    """A3."""
    return df.agg(F.count_if(~seen).alias("kept"), F.count_if(seen).alias("seen"))


def shard_counts(df: DataFrame, path: str = "path") -> DataFrame:
    """A4: rows by the path's second part, most first."""
    shard = F.get(F.split(path, "/"), F.lit(1))
    return df.groupBy(shard.alias("shard")).agg(F.count("*").alias("cnt")).orderBy(F.desc("cnt"), "shard")


def totals(df: DataFrame, value: str = "similarity") -> DataFrame:
    """A5."""
    return df.agg(F.count("*").alias("total"), F.count(value).alias("with_value"))


def trailing_sums(df: DataFrame, ts: str, values: list[str], ref: Column, scale: float = 1e-6) -> DataFrame:
    """Sums over all time, the last day and the last seven before ``ref``."""
    aggs = []
    for v in values:
        aggs.append((F.sum(v) * scale).alias(f"{v}_total"))
        for name, days in (("day", 1), ("week", 7)):
            inside = F.col(ts) > ref - F.expr(f"INTERVAL {days} DAYS")
            aggs.append((F.coalesce(F.sum(F.when(inside, F.col(v))), F.lit(0)) * scale).alias(f"{v}_{name}"))
    return df.agg(*aggs)


def deltas(df: DataFrame, keys: list[str], order: str, value: str, out: str = "delta") -> DataFrame:
    """A8, W4, corrected: each cumulative value less the one before; the first is itself."""
    return ranges.last_before(df, keys, order, value, "__before", False).withColumn(out, F.col(value) - F.coalesce("__before", F.lit(0))).drop("__before")


def error_rate(df: DataFrame, failed: Column, seconds: str | Column, by: list[str] | None = None) -> DataFrame:
    """A10: requests, exceptions, rate in percent (rounded to 2 decimals before it is made a
    percentage) and mean seconds."""
    n = F.count("*")
    bad = F.count_if(failed)
    rate = F.round(bad / n, 2) * 100
    return df.groupBy(*(by or [])).agg(n.alias("requests"), bad.alias("exceptions"), rate.alias("rate_percent"), F.avg(col(seconds)).alias("mean_s"))


def throughput(df: DataFrame, rows: str, seconds: str) -> DataFrame:
    """Rows a second over all; null for no time."""
    return df.agg((F.sum(rows) / F.nullif(F.sum(seconds), F.lit(0))).alias("per_s"))


def most_common(df: DataFrame, column: str) -> DataFrame:
    """The mode; the least of several."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), column).limit(1)


def stats_page(sums: DataFrame) -> DataFrame:
    """The report as JSON text, one row."""
    return sums.select(F.to_json(F.struct("*")).alias("json"))
