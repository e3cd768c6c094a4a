import numpy as np
import pytest

from pairloom.llm import whiten

SCHEMA = "vec_id long, embedding array<float>, n int, component string"


def table(spark, vectors, ids=None):
    rows = [(i if ids is None else ids[i], None if v is None else [None if x is None else float(x) for x in v], 1, "c") for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA)


def check(rows, vectors, ids=None, k=8):
    """Against a dense eigendecomposition of the exact integers."""
    x = np.array([[int(np.floor(1024 * float(np.float32(c)))) + 100000 for c in v] for v in vectors], object)
    n, d = x.shape
    ids = list(range(n)) if ids is None else ids
    sums = x.sum(0)
    deviation = [int(((n * r - sums) ** 2).sum()) for r in x]
    c = ((n * x - sums) / n).astype(float)
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1], q[:, ::-1]
    m = min(k, d)
    assert sorted((r["vec_id"], r["component"]) for r in rows) == sorted((i, j + 1) for i in ids for j in range(m))
    assert len(rows) == n * m
    at = {i: p for p, i in enumerate(ids)}
    w = np.zeros((n, m))
    for r in rows:
        w[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[at[r["vec_id"]]]
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / np.trace(v), rel=1e-9)
    cov = (w - w.mean(0)).T @ (w - w.mean(0)) / n
    assert np.abs(cov - np.eye(m)).max() < 1e-7
    assert all(abs(r["identity_error"] - np.abs(cov - np.eye(m)).max()) < 1e-9 for r in rows)
    want = c @ q[:, :m] / np.sqrt(e[:m])
    gaps = np.min(np.abs(e[:m, None] - e[None, :]) + np.where(np.eye(m, d) > 0, np.inf, 0), axis=1) / e[0]
    for j in range(m):
        if gaps[j] > 1e-4:
            assert min(np.abs(w[:, j] - want[:, j]).max(), np.abs(w[:, j] + want[:, j]).max()) < 1e-6


def test_against_a_dense_decomposition(spark):
    rng = np.random.default_rng(1)
    vectors = (rng.standard_normal((300, 20)) * np.linspace(1, 5, 20)).astype(np.float32)
    check(whiten.whiten(table(spark, vectors).repartition(5)).collect(), vectors)


def test_more_dimensions_than_the_block(spark):
    rng = np.random.default_rng(2)
    quick = (rng.standard_normal((700, 150)) * 0.6 ** np.arange(150) + 0.01 * rng.standard_normal((700, 150))).astype(np.float32)
    slow = rng.standard_normal((500, 100)).astype(np.float32)  # no gap: the block must grow
    for vectors in (quick, slow):
        check(whiten.whiten(table(spark, vectors).repartition(20)).collect(), vectors)


def test_the_block_stays_small_where_eigenvalues_fall(spark, monkeypatch):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((400, 200)) * 0.5 ** np.arange(200)).astype(np.float32)
    widths = []
    summed = whiten.summed
    monkeypatch.setattr(whiten, "summed", lambda blocks, part: (got := summed(blocks, part), widths.append(len(got)))[0])
    check(whiten.whiten(table(spark, vectors)).collect(), vectors)
    assert max(widths[:-1]) == 200 * whiten.BLOCK + 1  # never d x d


def test_fewer_dimensions_and_components(spark):
    rng = np.random.default_rng(4)
    vectors = rng.standard_normal((50, 3)).astype(np.float32)
    check(whiten.whiten(table(spark, vectors)).collect(), vectors)
    check(whiten.whiten(table(spark, vectors), k=2).collect(), vectors, k=2)


def test_rows_that_are_dropped(spark):
    good = [[1.0, 2.0, 0.5], [3.0, -1.0, 0.25], [0.0, 0.5, 0.125], [1.5, 1.5, 9.0], [1.0, 2.0, 0.5]]
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 1, 1], [float("inf"), 0, 0], [0, 0, float("-inf")], [1.0, 2.0], [1, 2, 3, 4]]
    ids = [7, 8, 9, 10, 7, *range(20, 28)]
    rows = whiten.whiten(table(spark, good + odd, ids)).collect()
    assert sorted({r["vec_id"] for r in rows}) == [7, 8, 9, 10] and len(rows) == 15
    check([r for r in whiten.whiten(table(spark, good[:4] + odd, [7, 8, 9, 10, *range(20, 28)])).collect()], good[:4], [7, 8, 9, 10])


def test_null_keys_repeated_rows_and_nothing(spark):
    rows = whiten.whiten(table(spark, [[1.0, 0.0], [0.0, 1.0], [0.0, 1.0]], [None, 4, 4])).collect()
    assert sum(r["vec_id"] is None for r in rows) == 1 or len(rows) == 3
    assert {r["component"] for r in rows} == {1}  # the points lie on a line
    assert whiten.whiten(table(spark, [])).collect() == []
    assert whiten.whiten(table(spark, [None, []])).collect() == []
    assert whiten.whiten(table(spark, [[1.0, 2.0]] * 3)).collect() == []


def test_huge_entries(spark):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [0.0, 3.0]]
    rows = whiten.whiten(table(spark, vectors)).collect()
    assert [r["deviation"] for r in sorted(rows, key=lambda r: r["vec_id"])][::len(rows) // 3] == [None, None, 200_000**2 + 1024**2 * 9]
    vectors = [[4e6, 1.0], [-4e6, 2.0], [0.0, 3.0], [5.0, 1e6]]
    rows = whiten.whiten(table(spark, vectors)).collect()
    x = [[int(np.floor(1024 * c)) + 100000 for c in v] for v in vectors]
    sums = [sum(c) for c in zip(*x, strict=True)]
    want = {i: sum((4 * c - s) ** 2 for c, s in zip(v, sums, strict=True)) for i, v in enumerate(x)}
    assert {r["vec_id"]: r["deviation"] for r in rows} == {i: w if w < 1 << 63 else None for i, w in want.items()}


def test_query(spark, sf):
    got = whiten.query(spark, sf).collect()
    rows = [r for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect() if r["embedding"] is not None]
    check(got, [r["embedding"] for r in rows], [r["vec_id"] for r in rows])
