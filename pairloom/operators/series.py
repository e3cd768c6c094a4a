"""Time series."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ranges

FORECAST_FACTOR = 1.1
SAMPLED = 40


def resample(df: DataFrame, ts: str, values: list[str], hours: int, dense: bool = True, drop_edges: bool = True) -> DataFrame:
    """Sums by ``hours``-hour buckets counted from midnight; empty buckets between
    are 0 where ``dense``, and the first and last bucket go where ``drop_edges``.

    The buckets are aggregated first; the sequence of starts comes from their least and
    greatest, one row exploded.
    """
    start = F.window(F.col(ts).cast("timestamp"), f"{hours} hours")["start"]
    got = df.where(F.col(ts).isNotNull()).groupBy(start.alias("bucket")).agg(*(F.sum(v).alias(v) for v in values))
    ends = got.agg(F.min("bucket").alias("lo"), F.max("bucket").alias("hi"))
    if dense:
        every = ends.where("lo is not null").select(F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {hours} HOURS"))).alias("bucket"))
        got = every.join(got, "bucket", "left").select("bucket", *(F.coalesce(v, F.lit(0)).alias(v) for v in values))
    if drop_edges:
        got = got.where((F.col("bucket") > ends.select("lo").scalar()) & (F.col("bucket") < ends.select("hi").scalar()))
    return got


def polynomial(df: DataFrame, keys: list[str], order: str, value: str, degree: int = 5) -> DataFrame:
    """M6: keys, ``order`` and the least-squares polynomial's value at each point, over equal
    steps from 0 to 1.

    By aggregation: polynomials that are orthogonal over n equal steps follow a recurrence
    whose coefficients depend on n alone, so a series' fit is ``degree`` + 1 sums of value times
    polynomial, over sums of squares that are known in closed form.  Points are numbered by
    ranges of a series (``ranges.numbered``), so a series may be of any length.  A series
    of n points gets a polynomial of degree n - 1 at most; null values count as no number, and make the fit so.
    """
    numbered = ranges.numbered(df.select(*keys, order, value), keys, [order], "__i")
    counts = numbered.groupBy(*keys).agg(F.count("*").alias("__n"))
    same = lambda t, prefix: functools.reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys), F.lit(True))
    points = numbered.join(counts.withColumnsRenamed({k: f"__c_{k}" for k in keys}), same(counts, "__c_"), "left")
    n, x = F.col("__n").cast("double"), (2 * F.col("__i") - 1 - F.col("__n")).cast("double") / F.col("__n")
    # p0 = 1, p1 = x, p(k+1) = x pk - c(k) p(k-1); the centred steps are (2i - 1 - n) / n, which keeps all within 1.
    p, norm = [F.lit(1.0), x], [n]
    for k in range(1, degree + 1):
        c = (F.lit(float(k * k)) * (n * n - k * k)) / (F.lit(float(4 * k * k - 1)) * n * n)
        norm.append(norm[-1] * c)
        p.append(x * p[k] - c * p[k - 1])
    p = [F.when(n > k, q) for k, q in enumerate(p[: degree + 1])]
    sums = points.groupBy(*keys).agg(*(F.sum(F.col(value).cast("double") * q).alias(f"__s{k}") for k, q in enumerate(p)), F.count_if(F.col(value).isNull()).alias("__nulls"))
    both = points.join(sums.withColumnsRenamed({k: f"__f_{k}" for k in keys}), same(sums, "__f_"), "left")
    fitted = functools.reduce(lambda a, b: a + b, (F.coalesce(F.col(f"__s{k}") / norm[k] * p[k], F.lit(0.0)) for k in range(degree + 1)))
    return both.select(*keys, order, F.when(F.col("__nulls") == 0, fitted).otherwise(F.lit(float("nan"))).alias("fitted"))


def holt_path(y: np.ndarray, level: float, trend: float, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Fitted and forecast values of Holt's method with a multiplicative trend; the first
    level is y[0], the first trend y[1] / y[0]."""
    y = np.asarray(y, float)
    if len(y) < 2 or y[0] == 0:
        return y.copy(), np.full(steps, y[-1] if len(y) else np.nan)
    lev, tr = y[0], y[1] / y[0]
    fitted = [y[0]]
    for v in y[1:]:
        fitted.append(lev * tr)
        new = level * v + (1 - level) * lev * tr
        tr = trend * new / lev + (1 - trend) * tr if lev else tr
        lev = new
    return np.array(fitted), lev * tr ** np.arange(1, steps + 1)


def holt(df: DataFrame, keys: list[str], order: str, value: str, level: float, trend: float, steps: int, factor: float = FORECAST_FACTOR) -> DataFrame:
    """M7: keys, step (from 1) and forecast of each series."""
    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "step int, forecast double"])

    def run(f: pd.DataFrame) -> pd.DataFrame:
        f = f.sort_values(order)
        _, ahead = holt_path(f[value].to_numpy(), level, trend, steps)
        out = pd.DataFrame({"step": np.arange(1, steps + 1), "forecast": ahead * factor})
        for k in keys:
            out[k] = f[k].iloc[0]
        return out[[*keys, "step", "forecast"]]

    return df.select(*keys, order, value).groupBy(*keys).applyInPandas(run, schema)


def rmse(a: DataFrame, b: DataFrame, on: str, x: str, y: str) -> DataFrame:
    """Root of the mean squared difference of aligned points, two decimals."""
    return a.join(b, on).agg(F.round(F.sqrt(F.avg(F.pow(F.col(x) - F.col(y), 2))), 2).alias("rmse"))


def extrapolated(forecast: Column, observed: Column, sampled: int = SAMPLED) -> Column:
    """Struct of billions of candidates and of samples kept (a tenth), two decimals."""
    total = F.floor(forecast * sampled + observed * sampled)
    return F.struct(F.round(total / 1e9, 2).alias("candidates_billion"), F.round(total / 1e10, 2).alias("kept_billion"))
