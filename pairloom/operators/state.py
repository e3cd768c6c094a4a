"""Records that change state.

Tables are immutable: each operator maps a snapshot (and a delta) to the next snapshot or
to the two halves of a split.  One writer swaps snapshots; nothing here reads a clock.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from .dedup import insert_ignore, last_by, maybe_broadcast

NEW, CLAIMED, OK, FAILED = 0, 1, 2, 9


def route(language: str | Column) -> Column:
    """En, nolang for none, intl for the rest."""
    return F.when(F.coalesce(col(language), F.lit("")) == "", "nolang").when(col(language) == "en", "en").otherwise("intl")


def ingest(table: DataFrame, batch: DataFrame, required: list[str], key: str = "sampleid", order: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to append, with route, status and illegal at their defaults; rows set
    aside because the key or a required column is null)."""
    bad = F.lit(False)
    for c in [key, *required]:
        bad = bad | F.col(c).isNull()
    good = insert_ignore(table, batch.where(~bad), key, order or [c for c in batch.columns if c != key])
    good = good.withColumns({"route": route("language"), "status": F.lit(NEW).cast("short"), "illegal": F.lit(False)})
    return good, batch.where(bad)


def claim(table: DataFrame, key: str, n: int, status: str = "status", sample_percent: float | None = None) -> DataFrame:
    """Q1, Q2: the next ``n`` new rows, by key, as claimed."""
    from .dedup import hash_sample

    free = table.where(F.col(status) == NEW)
    if sample_percent is not None:
        free = hash_sample(free, key, sample_percent)
    return free.orderBy(key).limit(n).withColumn(status, F.lit(CLAIMED))


def apply_claim(table: DataFrame, claimed: DataFrame, key: str, now: Column | None = None, status: str = "status") -> DataFrame:
    """Q1: the snapshot in which the claimed rows are so."""
    ids = maybe_broadcast(claimed.select(F.col(key).alias("__key"), F.lit(CLAIMED).alias("__status")))
    joined = table.join(ids, F.col(key) == F.col("__key"), "left")
    changed = {status: F.coalesce("__status", status)}
    if now is not None:
        changed["modified"] = F.when(F.col("__status").isNotNull(), now).otherwise(F.col("modified"))
    return joined.withColumns(changed).select(*table.columns)


def complete(table: DataFrame, results: DataFrame, key: str, columns: list[str], now: Column | None = None, order: list[str] | None = None) -> DataFrame:
    """``columns`` of the rows that have a result are the result's, nulls too.

    Of several results for a key the last by ``order`` counts (by default the greatest
    values), so a row of the table stays one row.
    """
    names = {c: f"__new_{c}" for c in columns}
    order = order or columns
    last = last_by(results.where(F.col(key).isNotNull()).select(key, *dict.fromkeys([*order, *columns])), [key], order)
    new = last.select(F.col(key).alias("__key"), *(F.col(c).alias(n) for c, n in names.items()))
    joined = table.join(new, F.col(key) == F.col("__key"), "left")
    hit = F.col("__key").isNotNull()
    changed = {c: F.when(hit, F.col(n)).otherwise(F.col(c)) for c, n in names.items()}
    if now is not None:
        changed["modified"] = F.when(hit, now).otherwise(F.col("modified"))
    return joined.withColumns(changed).select(*table.columns)


def sweep(table: DataFrame, claimed: DataFrame, results: DataFrame, key: str, status: str = "status") -> DataFrame:
    """Rows of this claim that are still claimed and have no result become failed."""
    ids = claimed.select(F.col(key).alias("__claimed")).distinct()
    done = results.select(F.col(key).alias("__done")).distinct()
    joined = table.join(ids, F.col(key) == F.col("__claimed"), "left").join(done, F.col(key) == F.col("__done"), "left")
    lost = F.col("__claimed").isNotNull() & F.col("__done").isNull() & (F.col(status) == CLAIMED)
    return joined.withColumn(status, F.when(lost, FAILED).otherwise(F.col(status))).select(*table.columns)


def split(table: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(exported, remaining); a condition that is null leaves a row where it is."""
    hit = F.coalesce(condition, F.lit(False))
    return table.where(hit), table.where(~hit)


def add_jobs(jobs: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """New job ids, status 0; those that exist stay as they are."""
    new = ids.select("jobid").distinct().join(jobs.select(F.col("jobid").alias("__there")), F.col("jobid") == F.col("__there"), "left_anti")
    return jobs.unionByName(new.select("jobid", F.lit(NEW).alias("status"), now.alias("modified")))


def job_archives(jobs: DataFrame, files: DataFrame, stem: str = "stem") -> DataFrame:
    """Archives of jobs that are past the claim."""
    done = jobs.where("status > 1").select("jobid", "status")
    return files.join(done, F.col(stem) == F.col("jobid"))


def counts_or_zero(keys: DataFrame, rows: DataFrame, key: str, out: str = "cnt") -> DataFrame:
    """Rows by key for every key; none is 0."""
    n = rows.groupBy(F.col(key).alias("__k")).agg(F.count("*").alias(out))
    return keys.join(n, F.col(key) == F.col("__k"), "left").withColumn(out, F.coalesce(out, F.lit(0))).drop("__k")


def may_load(table: DataFrame, most: int, status: str = "status") -> bool:
    """Q10: whether fewer than ``most`` rows wait."""
    return table.where(F.col(status) == NEW).count() <= most
