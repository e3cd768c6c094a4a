"""Dedup, membership and ids.

The kept row of a key is found by an aggregation with map-side combine, not by a window, so
a key with a third of all rows doesn't land in one task.  Membership is tested after that,
with one row a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranges

#: Rows up to which a side of a join is broadcast.
BROADCAST_ROWS = 100_000


def maybe_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` for a broadcast join if it has at most ``rows`` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def _one(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    if len(order) == 1 and not rest:  # a plain column needs no sort to combine
        return df.groupBy(*keys).agg(pick(order[0]).alias(order[0])).select(*df.columns)
    value = F.struct(*order, *(F.col(c) for c in rest))
    got = df.groupBy(*keys).agg(pick(value).alias("__row"))
    return got.select(*(F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the first by ``order`` (ties: the least other columns)."""
    return _one(df, keys, order, F.min)


def last_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row a key, the last by ``order``."""
    return _one(df, keys, order, F.max)


def unseen(batch: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None, normalize=F.trim) -> DataFrame:
    """The batch's rows whose key is not in ``seen``; exact.  A null key was never seen.

    A semi or anti join needs no distinct keys.  A seen set that is stored normalised and
    bucketed by its key (and ``normalize`` that leaves it as it is) isn't shuffled at all.
    """
    k = normalize(F.col(key))
    there = seen.select(normalize(F.col(seen_key or key)).alias("__seen"))
    return batch.join(there, k == F.col("__seen"), "left_anti")


def already_seen(batch: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None, normalize=F.trim) -> DataFrame:
    """The batch's rows whose key is in ``seen``."""
    k = normalize(F.col(key))
    there = seen.select(normalize(F.col(seen_key or key)).alias("__seen"))
    return batch.join(there, k == F.col("__seen"), "left_semi")


def unseen_in_all(batch: DataFrame, seen: list[DataFrame], key: str) -> DataFrame:
    """One seen set after the other."""
    for s in seen:
        batch = unseen(batch, s, key)
    return batch


def new_keys(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """The distinct keys to add to ``seen``; their number is what the service returned."""
    return unseen(batch.select(F.trim(key).alias(key)).where(F.col(key).isNotNull()).distinct(), seen, key)


def union_all(*frames: DataFrame) -> DataFrame:
    """By name, missing columns null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def insert_ignore(table: DataFrame, batch: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The rows of ``batch`` that a table with this primary key takes."""
    fresh = first_by(batch.where(F.col(key).isNotNull()), [key], order)
    return fresh.join(table.select(F.col(key).alias("__there")), F.col(key) == F.col("__there"), "left_anti")


def with_ids(df: DataFrame, per: list[str], order: list[str], start: str | Column, out: str = "sampleid") -> DataFrame:
    """Dense ids from ``start`` in the order of each ``per`` group (one crawl file)."""
    first = F.col(start) if isinstance(start, str) else start
    return ranges.numbered(df, per, order, "__number").withColumn(out, (first + F.col("__number") - 1).cast("long")).drop("__number")


#: Rows that one task may sort and cut.
ONE_TASK_ROWS = 100_000


def first_rows(df: DataFrame, n: int, order: list[str], most: int = ONE_TASK_ROWS) -> DataFrame:
    """O1, O2: the first ``n`` by ``order``, which should be total.  More than ``most`` rows are
    cut by ranges, not in one task."""
    return df.orderBy(*order).limit(n) if n <= most else ranges.first_rows(df, n, order)


def hash_sample(df: DataFrame, key: str, percent: float, buckets: int = 1_000_000) -> DataFrame:
    """O3: rows whose key falls in a share of hash buckets; repeatable."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 12), 16, 10).cast("long") % buckets
    return df.where(bucket < int(percent / 100 * buckets))


def shuffled(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """In an order by hash, which spreads a domain's links."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))), key)


def by_number(df: DataFrame, column: str) -> DataFrame:
    """Text numbers in the order of their values."""
    return df.orderBy(F.col(column).cast("long"))
