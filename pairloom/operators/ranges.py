"""Windows over groups of any size.

Where no group has more than ``GROUP_ROWS`` rows (counted first, with map-side combine), a plain
window does.  Else a group's rows are dealt to ranges of its order, so a key with a third of all rows is many
ranges.  A window works within a range; what goes over a range's edge is one row a
group and range, summed up by a second, small window and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..shared import kept

RANGE = "__range"
#: Rows of a group that one task sorts.
GROUP_ROWS = 1_000_000


def _bounded(df: DataFrame, keys: list[str]) -> bool:
    """Whether every group of ``df`` has at most ``GROUP_ROWS`` rows."""
    if df.count() <= GROUP_ROWS:
        return True
    most = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"]
    return (most or 0) <= GROUP_ROWS


def dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` with the number of each row's range; it is kept, so that every reader sees the
    same ranges."""
    return kept(df.repartitionByRange(*keys, *order).withColumn(RANGE, F.spark_partition_id()))


def _joined(df: DataFrame, keys: list[str], edges: DataFrame) -> DataFrame:
    """``df`` with the columns of its range's row of ``edges`` (named apart); null keys meet."""
    names = {c: f"__of_{c}" for c in (*keys, RANGE)}
    on = F.lit(True)
    for c, n in names.items():
        on = on & F.col(c).eqNullSafe(F.col(n))
    return df.join(edges.withColumnsRenamed(names), on, "left").drop(*names.values())


def _earlier(keys: list[str]) -> Window:
    return Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` with each row's number from 1 in its group."""
    if _bounded(df, keys):
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long"))
    rows = dealt(df, keys, order)
    counts = rows.groupBy(*keys, RANGE).agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(_earlier(keys)), F.lit(0))).drop("__n")
    here = F.row_number().over(Window.partitionBy(*keys, RANGE).orderBy(*order))
    return _joined(rows.withColumn("__here", here), keys, before).withColumn(out, (F.col("__here") + F.col("__before")).cast("long")).select(*df.columns, out)


def last_before(df: DataFrame, keys: list[str], order: str, value: str, out: str, inclusive: bool) -> DataFrame:
    """``df`` with the last ``value`` that isn't null before each row of its group, or, where
    ``inclusive``, at or before it."""
    if _bounded(df, keys):
        w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
        return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
    rows = dealt(df, keys, [order])
    valued = F.when(F.col(value).isNotNull(), F.struct(order, F.col(value).alias("__v")))
    lasts = rows.groupBy(*keys, RANGE).agg(F.max(valued)["__v"].alias("__last"))
    before = lasts.withColumn("__carried", F.last("__last", ignorenulls=True).over(_earlier(keys))).drop("__last")
    w = Window.partitionBy(*keys, RANGE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    here = rows.withColumn("__here", F.last(value, ignorenulls=True).over(w))
    return _joined(here, keys, before).withColumn(out, F.coalesce("__here", "__carried")).select(*df.columns, out)


def first_rows(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """The first ``n`` rows by ``order``, of any number: ranges are kept whole until they have
    ``n`` rows, and only the range in which the n-th row lies is cut."""
    rows = dealt(df, [], order)
    counts = rows.groupBy(RANGE).agg(F.count("*").alias("__n"))
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    some = before.where(F.col("__before") < n)
    whole = _joined(rows, [], some.where(F.col("__before") + F.col("__n") <= n)).where("__n is not null")
    cut = _joined(rows, [], some.where(F.col("__before") + F.col("__n") > n)).where("__n is not null")
    cut = cut.withColumn("__here", F.row_number().over(Window.partitionBy(RANGE).orderBy(*order))).where(F.col("__here") + F.col("__before") <= n)
    return whole.select(*df.columns).unionByName(cut.select(*df.columns))
