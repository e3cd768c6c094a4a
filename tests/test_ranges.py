"""Windows over groups of any size, against plain loops; one key holds a third of the rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions import text as X
from pairloom.functions import url as U
from pairloom.functions.language import native_language
from pairloom.operators import dedup as D
from pairloom.operators import links as L
from pairloom.operators import metrics as M
from pairloom.operators import ranges as R
from pairloom.operators import series as Q
from pairloom.operators import state as S


def rows():
    rnd = random.Random(4)
    return [("hot" if i % 3 == 0 else None if i % 3 == 1 else f"k{rnd.randrange(40)}", i, rnd.choice((None, i, i * 2))) for i in rnd.sample(range(3000), 3000)]


@pytest.fixture(scope="module")
def df(spark):
    """With ranges as they are: adaptive execution would make one of so few rows."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield spark.createDataFrame(rows(), "k string, n long, v long").repartition(5)
    spark.conf.set(name, before)


def groups():
    out = {}
    for k, n, v in sorted(rows(), key=lambda r: r[1]):
        out.setdefault(k, []).append((n, v))
    return out


def test_a_hot_key_lies_in_several_ranges(df):
    got = R.dealt(df, ["k"], ["n"]).groupBy("k").agg(F.count_distinct("__range").alias("n")).collect()
    assert max(r.n for r in got) > 1


@pytest.fixture(params=[50, 10**6])
def most(request, monkeypatch):
    """Groups beyond what a task sorts, and within it."""
    monkeypatch.setattr(R, "GROUP_ROWS", request.param)


def test_ids(df, most):
    want = {n: 100 + i for g in groups().values() for i, (n, _) in enumerate(g)}
    assert {r.n: r.sampleid for r in D.with_ids(df, ["k"], ["n"], F.lit(100)).collect()} == want
    assert D.with_ids(df.limit(0), ["k"], ["n"], F.lit(1)).count() == 0


def test_carried_and_deltas(df, most):
    carried, deltas = {}, {}
    for g in groups().values():
        last = None
        for n, v in g:
            deltas[n] = None if v is None else v - (last or 0)
            last = v if v is not None else last
            carried[n] = last
    assert {r.n: r.c for r in L.carried(df, ["k"], "n", "v", "c").collect()} == carried
    assert {r.n: r.delta for r in M.deltas(df, ["k"], "n", "v").collect()} == deltas


@pytest.mark.parametrize("n", [0, 1, 700, 2999, 3000, 5000])
def test_first_rows(df, n):
    got = D.first_rows(df, n, ["n"], most=0)
    assert got.columns == df.columns and sorted(r.n for r in got.collect()) == list(range(min(n, 3000)))


def test_trends_of_a_hot_series(spark, most):
    rng = random.Random(5)
    rows = [("long", i, rng.random()) for i in range(400)] + [(None, i, float(i)) for i in range(3)] + [("one", 0, 7.0)] + [("null", i, None if i == 1 else 1.0) for i in range(4)]
    df = spark.createDataFrame(rows, "k string, o int, v double").repartition(5)
    got = {(r.k, r.o): r.fitted for r in Q.polynomial(df, ["k"], "o", "v").collect()}
    x = np.linspace(-1, 1, 400)
    want = np.polynomial.Chebyshev.fit(x, [v for k, _, v in rows if k == "long"], 5)(x)
    assert [got["long", i] for i in range(400)] == pytest.approx(want)
    assert [got[None, i] for i in range(3)] == pytest.approx([0, 1, 2], abs=1e-12) and got["one", 0] == pytest.approx(7.0)
    assert all(np.isnan(got["null", i]) for i in range(4)) and Q.polynomial(df.limit(0), ["k"], "o", "v").count() == 0


def test_results_twice_for_a_key(spark):
    table = spark.createDataFrame([(i, 1, 5) for i in range(30)], "id long, status int, width int")
    done = spark.createDataFrame([(3, 2, 10)] * 20 + [(4, 2, None), (None, 9, 9)], "id long, status int, width int")
    got = {r.id: (r.status, r.width) for r in S.complete(table, done, "id", ["status", "width"]).collect()}
    assert len(got) == 30 and got[3] == (2, 10) and got[4] == (2, None) and got[5] == (1, 5)


def test_hosts_of_addresses_as_they_occur(spark):
    paths = ["a|b.png", "img[1].jpg", "a%zz.jpg", "a{b}.png", "a^b.png", "a\\b.png", 'a"b.png', "a`b.png", "x y"]
    values = ["http://example.com/" + p for p in paths] + ["http://exämple.com/x.png", "https://u:p@[::1]:80/x", "http://A.example?x@y/z", "http://", "x", None]
    got = [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", U.host("v").alias("h")).orderBy("i").select("h").collect()]
    assert got == ["example.com"] * len(paths) + ["exämple.com", "::1", "a.example", None, None, None]


def test_languages_and_repairs(spark):
    def one(f, *values):
        rows = spark.createDataFrame(list(enumerate(values)), "i int, v string").select("i", f("v").alias("x")).orderBy("i").collect()
        return [r.x for r in rows]

    said = one(native_language, "the cat and the dog", "der Hund und die Katze", "le chat et la souris dans les bois", "это кошка", "日本の猫です", "这是一只猫", "xyzzy", "", None, "12 34")
    assert [(r.language, r.reliable) for r in said] == [("en", True), ("de", True), ("fr", True), ("ru", True), ("ja", True), ("zh", True), ("", False), ("", False), ("", False), ("", False)]
    broken = [t.encode().decode("cp1252") for t in ("Grüße", "café – naïve", "“x")]
    assert one(X.mended, *broken, "Grüße", "Ã alone", "日本 Ã¼", "", None) == ["Grüße", "café – naïve", "“x", "Grüße", "Ã alone", "日本 ü", "", None]
