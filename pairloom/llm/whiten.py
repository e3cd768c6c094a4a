"""Whitening of embeddings by matrix-free block subspace iteration.

The covariance is never formed.  Vectors become integers, x = floor(1024 c) + 100000, and are
written once as blocks of rows.  A pass over the blocks computes V Q = Xᵀ(X Q) / n on centred
rows for a block Q of orthonormal columns; each task adds its blocks up, and the sums are
added in levels, so the driver gets a few matrices of d x b numbers.  There the passes'
results are turned into Ritz pairs (Rayleigh-Ritz) and a new Q (QR), until the residuals
|Vq - eq| of all k components are at most ``TOLERANCE`` of the largest eigenvalue.  Where
the block's own eigenvalues say that this takes more than ``SLOW`` passes, the block is doubled; at d columns
one pass is exact.

Sums, and with them the centring, are exact: n x - S is an integer, divided once.

Which rows: those whose vector is not null, not empty, and without null or non-finite
entries; of vectors of several lengths, those of the most frequent length (ties: the longest).  All
of these are the fit.

Edge cases: a component whose eigenvalue is at most ``RANK`` of the largest is none (fewer
components, and no rows where the vectors are all equal); equal eigenvalues have some basis
of their space; a null vec_id stays; repeated rows count and come back each; no rows give
no rows; other columns are ignored.  An x beyond 2^52 counts as 2^52, and a deviation
that is no 64-bit number is null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import written

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Columns of the first block, beyond those asked for.
BLOCK = 32
#: Residual of a component, of the largest eigenvalue.
TOLERANCE = 1e-13
#: What is accepted where a full block's residuals, which are rounding alone, are above that.
ROUNDING = 1e-10
RANK = 1e-10
SLOW = 6
PASSES = 60
SEED = 12
#: Bytes of a block of rows as 64-bit numbers.
BLOCK_BYTES = 4 << 20
#: Matrices that the driver, or a task, adds up at once.
FAN = 16
LIMIT = 1 << 52
LOW = (1 << 26) - 1


def _integers(entries: np.ndarray) -> np.ndarray:
    scaled = np.floor(SCALE * entries.astype(np.float64)) + SHIFT
    return np.clip(scaled, -LIMIT, LIMIT).astype(np.int64)


def to_blocks(df: DataFrame, vector: str, key: str) -> DataFrame:
    """dim, ids, x (rows of integers, one after the other), wide (of 8 bytes, else of 4) and the
    columns' sums, in a high and a low part: one row a block."""

    def run(batches):
        for b in batches:
            lists = b.column(1)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            ends = np.cumsum(lengths)
            bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False).astype(np.float64))  # a null is NaN here
            good = (lengths > 0) & (np.concatenate([[0], np.cumsum(bad)])[ends] == np.concatenate([[0], np.cumsum(bad)])[ends - lengths])
            values = flat.to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[good]).tolist():
                rows = np.flatnonzero(good & (lengths == dim))
                step = max(1, BLOCK_BYTES // (8 * dim))
                for i in range(0, len(rows), step):
                    here = rows[i : i + step]
                    x = _integers(values[(ends[here] - dim)[:, None] + np.arange(dim)])
                    wide = bool(np.abs(x).max() >= 1 << 31)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "dim": pa.array([dim], pa.int32()),
                            "n": pa.array([len(here)], pa.int64()),
                            "ids": pa.array([b.column(0).take(pa.array(here)).to_pylist()], pa.list_(pa.int64())),
                            "wide": pa.array([wide]),
                            "x": pa.array([x.astype("<i8" if wide else "<i4").tobytes()], pa.binary()),
                            "high": pa.array([(x >> 26).sum(0)], pa.list_(pa.int64())),
                            "low": pa.array([(x & LOW).sum(0)], pa.list_(pa.int64())),
                        }
                    )

    schema = "dim int, n long, ids array<long>, wide boolean, x binary, high array<long>, low array<long>"
    entries = F.col(vector) if dict(df.dtypes)[vector] == "array<float>" else F.col(vector).cast("array<double>")
    return df.select(F.col(key).cast("long").alias("id"), entries.alias("v")).mapInArrow(run, schema)


class Fit:
    """The rows of a blocks table: their number n, dimension d and the exact sums."""

    def __init__(self, blocks: DataFrame):
        self.n = self.d = 0
        lengths = blocks.groupBy("dim").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
        if not lengths:
            return
        self.d, self.n = lengths[0]["dim"], lengths[0]["n"]
        self.blocks = blocks.where(F.col("dim") == self.d)
        parts = self.blocks.select(F.posexplode(F.arrays_zip("high", "low")).alias("j", "s"))
        exact = lambda c: F.sum(F.col(f"s.{c}").cast("decimal(38,0)")).alias(c)
        self.sums = [0] * self.d
        for r in parts.groupBy("j").agg(exact("high"), exact("low")).collect():
            self.sums[r["j"]] = (int(r["high"]) << 26) + int(r["low"])

    def centred(self):
        """A function from a block's (x, wide) to n x - S, as integers where they fit, and
        x - S / n."""
        n, d, sums = self.n, self.d, self.sums
        most = max(map(abs, sums), default=0)
        # Each mean as a whole number and a rest, so that the rest alone is rounded.
        whole = np.array([s // n for s in sums], np.int64)
        rest = np.array([(s % n) / n for s in sums])
        plain = np.array(sums, np.int64) if most < 1 << 62 else None

        def of(x: bytes, wide: bool):
            v = np.frombuffer(x, "<i8" if wide else "<i4").reshape(-1, d).astype(np.int64)
            fits = plain is not None and n * max(1, int(np.abs(v).max())) < 1 << 62
            scaled = n * v - plain if fits else None
            return v, scaled, scaled / n if fits else (v - whole) - rest

        return of

    def deviations(self):
        """A function from a block's x and n x - S to each row's sum over dimensions of (n x - S)^2."""
        n, d, sums = self.n, self.d, self.sums

        def of(v: np.ndarray, scaled: np.ndarray | None) -> list[int | None]:
            if scaled is not None and d * int(np.abs(scaled).max()) ** 2 < 1 << 63:
                return (scaled * scaled).sum(1).tolist()
            exact = (sum((n * x - s) ** 2 for x, s in zip(row, sums, strict=True)) for row in v.tolist())
            return [got if got < 1 << 63 else None for got in exact]

        return of


def summed(blocks: DataFrame, part) -> np.ndarray:
    """The sum over all blocks of ``part(x, wide)``, an array: within a task, then in levels."""

    def run(batches):
        total = None
        for b in batches:
            for x, wide in zip(b.column(0), b.column(1), strict=True):
                got = part(x.as_py(), wide.as_py())
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    def add(batches):
        total = None
        for b in batches:
            for m in b.column(0):
                got = np.frombuffer(m.as_py())
                total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_pydict({"m": pa.array([total.tobytes()], pa.binary())})

    sums = blocks.select("x", "wide").mapInArrow(run, "m binary")
    parts = sums.rdd.getNumPartitions()
    while parts > FAN:
        parts = -(-parts // FAN)
        sums = sums.repartition(parts).mapInArrow(add, "m binary")
    return np.sum([np.frombuffer(r["m"]) for r in sums.toLocalIterator()], axis=0)


def components(fit: Fit, k: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray, float, list[float]]:
    """Unit eigenvectors (columns), falling eigenvalues, the trace, and the residuals of at most ``k``
    components."""
    n, d = fit.n, fit.d
    k = min(k, d)
    centred = fit.centred()
    rng = np.random.default_rng(SEED)
    b = min(d, max(2 * k, BLOCK))
    q = np.linalg.qr(rng.standard_normal((d, b)))[0]
    before = np.inf
    for _ in range(PASSES):

        def part(x, wide, q=q):
            c = centred(x, wide)[2]
            return np.append((c.T @ (c @ q)).ravel(), np.square(c).sum())

        got = summed(fit.blocks, part)
        y, trace = got[:-1].reshape(d, b) / n, float(got[-1] / n)
        t = q.T @ y
        e, u = np.linalg.eigh((t + t.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        vectors, image = q @ u, y @ u
        largest = max(float(e[0]), 0.0)
        residual = np.linalg.norm(image[:, :k] - vectors[:, :k] * e[:k], axis=0)
        worst = float(residual.max())
        if largest == 0 or worst <= TOLERANCE * largest or (b == d and worst <= ROUNDING * largest and worst > before / 2):
            found = int((e[:k] > RANK * largest).sum()) if largest > 0 else 0
            return vectors[:, :found], e[:found], trace, residual[:found].tolist()
        rate = max(float(e[-1]), 0.0) / max(float(e[k - 1]), RANK * largest)
        # The first pass is over random columns, whose values tell nothing of the rate yet.
        if b < d and before < np.inf and np.log(TOLERANCE * largest / worst) < SLOW * np.log(max(rate, 1e-300)):
            b = min(d, 2 * b)
            image = np.hstack([image, rng.standard_normal((d, b - image.shape[1]))])
        before = worst
        q = np.linalg.qr(image / np.maximum(np.linalg.norm(image, axis=0), 1e-300))[0]
    raise ArithmeticError(f"residuals of {worst:.3g} after {PASSES} passes")


def whiten(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id", k: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each row
    of the fit and component."""
    spark = embeddings.sparkSession
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fit = Fit(written(to_blocks(embeddings, vector, key), "blocks"))
    if not fit.n:
        return spark.createDataFrame([], schema)
    vectors, e, trace, _ = components(fit, k)
    if not len(e):
        return spark.createDataFrame([], schema)
    n, m = fit.n, len(e)
    centred, deviations = fit.centred(), fit.deviations()
    scaled_vectors = vectors / np.sqrt(e)

    def squares(x, wide):
        w = centred(x, wide)[2] @ scaled_vectors
        return np.append((w.T @ w).ravel(), w.sum(0))

    got = summed(fit.blocks, squares)
    mean = got[m * m :] / n
    error = float(np.abs(got[: m * m].reshape(m, m) / n - np.outer(mean, mean) - np.eye(m)).max())
    explained = e / trace

    def run(batches):
        for b in batches:
            for ids, x, wide in zip(b.column(0), b.column(1), b.column(2), strict=True):
                v, scaled, c = centred(x.as_py(), wide.as_py())
                w = c @ scaled_vectors
                r = len(v)
                each = pa.array(np.repeat(np.arange(r), m))
                yield pa.RecordBatch.from_pydict(
                    {
                        key: pa.array(ids.values).take(each),
                        "component": pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), r)),
                        "n": pa.array(np.full(r * m, n, np.int64)),
                        "deviation": pa.array(deviations(v, scaled), pa.int64()).take(each),
                        "whitened": pa.array(w.ravel()),
                        "explained": pa.array(np.tile(explained, r)),
                        "identity_error": pa.array(np.full(r * m, error)),
                    }
                )

    return fit.blocks.select("ids", "x", "wide").mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
