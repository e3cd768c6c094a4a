import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom import plans
from pairloom.operators import dedup as D
from pairloom.operators import links as L
from pairloom.operators import metrics as M
from pairloom.operators import series as R
from pairloom.operators import state as S
from pairloom.operators.bloom import Sketch, unseen_exact

CC = "http://creativecommons.org/licenses/by/4.0/"


def crawl(base, links, mark=True):
    kinds = [{"path": "IMG@/src" if mark else "A@/href", **x} for x in links]
    return json.dumps({"Envelope": {"WARC-Header-Metadata": {"WARC-Target-URI": base}, "Payload-Metadata": {"HTTP-Response-Metadata": {"HTML-Metadata": {"Links": kinds}}}}})


def lines(spark):
    a = crawl(
        "http://p.example/a/b.html",
        [
            {"url": "http://i.example/1.png", "alt": "before a license"},
            {"url": CC, "alt": None},
            {"url": "http://i.example/2.png", "alt": "after a license"},
            {"url": CC.replace("by", "by-sa")},
            {"url": "http://i.example/1.png", "alt": "again, other text"},
            {"url": "c.png", "alt": "a relative one"},
            {"alt": "no address at all"},
            {"url": "http://i.example/x.svg", "alt": "a drawing of it"},
            {"url": "http://i.example/3.png", "alt": "tiny"},
            {"url": "http://i.example/4.png", "alt": "tab\tand|bar"},
        ],
    )
    rows = [(1, 0, a), (1, 1, "IMG@ but no json"), (1, 2, crawl("http://q.example/", [{"url": "http://i.example/9.png", "alt": "unmarked line"}], mark=False)), (2, 0, crawl("http://q.example/", [{"url": "http://i.example/1.png", "alt": "other file"}]))]
    return spark.createDataFrame(rows, "wat int, line long, value string")


def test_parse_stage(spark):
    seen = spark.createDataFrame([(" http://i.example/2.png ",)], "url string")
    out = plans.parse(lines(spark), seen, F.col("wat") * 1000, detector=lambda t: ("en" if "a" in t else "xx-Latn", True))
    rows = {(r.wat, r.url): r for r in out["rows"].collect()}
    assert set(rows) == {(1, "http://i.example/1.png"), (1, "http://i.example/4.png"), (2, "http://i.example/1.png")}
    first = rows[1, "http://i.example/1.png"]
    assert (first.text, first.license, first.sampleid, first.route, first.domain) == ("before a license", "?", 1000, "en", "i.example")
    fourth = rows[1, "http://i.example/4.png"]
    # The tab isn't printable and goes before the cut; the bar becomes a space.
    assert (fourth.text, fourth.license) == ("taband bar", CC.replace("by/", "by-sa/"))
    assert sorted(r.sampleid for r in rows.values()) == [1000, 1001, 2000]
    assert {r.url for r in out["keys"].collect()} == {"http://i.example/1.png", "http://i.example/4.png"}
    resolved = plans.parse(lines(spark), seen, F.lit(0), mode="resolve")["rows"].collect()
    assert "http://p.example/c.png" in {r.url for r in resolved}
    # Without a detector the library's own tells languages: reliably, or not at all.
    assert {r.text: r.route for r in resolved}["before a license"] == "en" and {r.route for r in resolved} <= {"en", "nolang"}
    with pytest.raises(ValueError):
        L.candidates(L.crawl_links(lines(spark)), "other")


def test_licenses_and_shards(spark):
    got = [r.license for r in L.with_license(L.crawl_links(lines(spark)), ["wat", "line"]).where("wat = 1").orderBy("pos").collect()]
    assert got[:5] == ["?", CC, CC, CC.replace("by/", "by-sa/"), CC.replace("by/", "by-sa/")]
    df = spark.createDataFrame([("f", i) for i in range(5)] + [("g", 0)], "wat string, line long")
    assert sorted((r.wat, r.line, r.shard) for r in L.line_shard(df).collect()) == [("f", 0, 0), ("f", 1, 0), ("f", 2, 0), ("f", 3, 1), ("f", 4, 1), ("g", 0, 0)]


def test_media_links(spark):
    html = '<a href="/x.mp3">A <b>song</b></a><audio><source type="a" src="y.mp3"></audio><a href="z.ogg">no</a>'
    df = spark.createDataFrame([("http://a.example/p", html)], "url string, html string")
    assert [(r.media_url, r.label) for r in L.media_links(df).orderBy("pos").collect()] == [("http://a.example/x.mp3", "A song"), ("http://a.example/p/y.mp3", "")]
    assert L.anchors(spark.createDataFrame([(1, None), (2, "")], "i int, html string")).count() == 0


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 3, None), (None, 4, "z"), (None, 5, "w")], "k string, o int, v string")
    for parts in (1, 8):
        d = df.repartition(parts)
        assert sorted(map(str, D.first_by(d, ["k"], ["o"]).collect())) == sorted(map(str, df.where("o in (1, 3, 4)").collect()))
        assert sorted(r.o for r in D.last_by(d, ["k"], ["o"]).collect()) == [2, 3, 5]


def test_membership(spark):
    batch = spark.createDataFrame([("a",), (" b ",), ("c",), (None,), ("c",)], "k string")
    seen = spark.createDataFrame([("b",), ("c ",), (None,)], "k string")
    assert sorted(str(r.k) for r in D.unseen(batch, seen, "k").collect()) == ["None", "a"]
    assert sorted(r.k for r in D.already_seen(batch, seen, "k").collect()) == [" b ", "c", "c"]
    assert D.unseen(batch, seen, "k").count() + D.already_seen(batch, seen, "k").count() == batch.count()
    assert [r.k for r in D.new_keys(batch, seen, "k").collect()] == ["a"]
    assert sorted(str(r.k) for r in D.unseen_in_all(batch, [seen, batch.where("k = 'a'")], "k").collect()) == ["None"]
    assert unseen_exact(batch, seen, "k").count() == 2


def test_sketch_never_misses(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"))
    s = Sketch.build(df, "k", 5000, 0.01)
    again = Sketch.restore(spark, s.dump(spark))
    assert all(again.contains(f"k{i}") for i in range(0, 5000, 7))
    assert sum(again.contains(f"x{i}") for i in range(1000)) < 50
    other = Sketch.build(spark.createDataFrame([("zz",)], "k string"), "k", 5000, 0.01)
    assert s.merged(other).contains("zz")
    with pytest.raises(ValueError):
        Sketch.build(df, "k", 10**10)


def test_ids_samples_and_orders(spark):
    df = spark.createDataFrame([("f", i, f"u{i}") for i in range(20)], "wat string, o int, url string")
    assert [r.sampleid for r in D.with_ids(df.repartition(5), ["wat"], ["o"], F.lit(7)).orderBy("o").collect()] == list(range(7, 27))
    assert [r.url for r in D.shuffled(df, "url", 3).collect()] == [r.url for r in D.shuffled(df.repartition(7), "url", 3).collect()] != [r.url for r in df.collect()]
    n = D.hash_sample(spark.range(20_000), "id", 10.0).count()
    assert 1700 < n < 2300
    assert [r.c for r in D.by_number(spark.createDataFrame([("10",), ("9",)], "c string"), "c").collect()] == ["9", "10"]


@pytest.mark.parametrize(("language", "want"), [("", "nolang"), (None, "nolang"), ("en", "en"), ("fr", "intl"), ("zh", "intl")])
def test_route(spark, language, want):
    df = spark.createDataFrame([(language,)], "l string")
    assert df.select(S.route("l")).first()[0] == want


def records(spark):
    return spark.createDataFrame([(i, i % 3, 0, 0, None) for i in range(9)], "sampleid long, status int, width int, height int, modified timestamp")


def test_claim_complete_sweep(spark):
    t = records(spark)
    now = F.lit("2024-01-01").cast("timestamp")

    def fetch(claimed):
        return claimed.where("sampleid <> 3").select("sampleid", F.when(F.col("sampleid") == 0, 2).otherwise(10).alias("status"), F.lit(5).alias("width"), F.lit(6).alias("height"))

    out = plans.download(t, 3, fetch, now=now)
    got = {r.sampleid: r for r in out["table"].collect()}
    assert [got[i].status for i in range(9)] == [2, 1, 2, 9, 1, 2, 10, 1, 2]  # 1, 4 and 7 belong to another claim
    assert (got[0].width, got[0].height) == (5, 6) and got[0].modified is not None and got[1].modified is None
    assert [r.sampleid for r in out["results"].collect()] == [0]
    assert plans.download(t.where("status > 0"), 3, fetch)["table"].count() == 6


def test_ingest_split_jobs(spark):
    table = spark.createDataFrame([(1,)], "sampleid long")
    batch = spark.createDataFrame([(1, "a", "en"), (2, "b", ""), (2, "a", "fr"), (3, None, "en"), (None, "x", "en")], "sampleid long, text string, language string")
    good, bad = S.ingest(table, batch, ["text"])
    assert [(r.sampleid, r.text, r.route, r.status, r.illegal) for r in good.collect()] == [(2, "a", "intl", 0, False)]
    assert bad.count() == 2
    t = spark.createDataFrame([(1, 2), (2, None), (3, 9)], "id int, status int")
    out, left = S.split(t, F.col("status") == 2)
    assert (out.count(), left.count()) == (1, 2)
    jobs = spark.createDataFrame([("a", 2, None)], "jobid string, status int, modified timestamp")
    more = S.add_jobs(jobs, spark.createDataFrame([("a",), ("b",), ("b",)], "jobid string"), F.lit("2024-01-01").cast("timestamp"))
    assert sorted((r.jobid, r.status) for r in more.collect()) == [("a", 2), ("b", 0)]
    assert S.job_archives(more, spark.createDataFrame([("a",), ("b",), ("c",)], "stem string")).count() == 1
    assert S.may_load(t, 0) and S.may_load(t.withColumn("status", F.lit(0)), 3) and not S.may_load(t.withColumn("status", F.lit(0)), 2)


def test_score_stage(spark):
    cats = {
        "main": spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.9, 0.1]), (19, [0.0, 1.0]), (20, [0.1, 0.9])], "idx int, vec array<double>"),
        "ages": spark.createDataFrame([(1, [1.0, 0.0]), (4, [0.0, 1.0]), (5, [0.1, 1.0])], "idx int, vec array<double>"),
        "animals": spark.createDataFrame([(0, [0.0, 1.0]), (22, [1.0, 0.0])], "idx int, vec array<double>"),
    }
    safe, bold = [1.0, 0.05], [0.05, 1.0]
    rows = [
        (1, 1, "u", "old", "en", safe, safe),
        (2, 1, "u", "old", "en", safe, [0.0, 1.0]),
        (1, 2, "v", "bold", "en", bold, bold),
        (1, 3, "w", "teen", "en", bold, bold),
        (1, 4, "s", "seen", "en", safe, safe),
    ]
    pairs = spark.createDataFrame(rows, "shard_seq int, row_seq int, url string, text string, route string, image_vec array<float>, text_vec array<float>")
    import hashlib

    seen = spark.createDataFrame([(hashlib.md5(b"sseen").hexdigest(),)], "hash string")
    out = plans.score(pairs, seen, cats)
    got = {r.url: (r.nsfw, r.dropped) for r in out["scored"].collect()}
    assert got == {"u": (None, True), "v": ("NSFW", False), "w": ("NSFW", True)}  # the last copy of u is kept, and is too unlike
    assert [r.url for r in out["kept"].collect()] == ["v"]


def test_resample_fills_gaps(spark):
    rows = [("2024-01-01 00:10:00", 1), ("2024-01-01 03:10:00", 2), ("2024-01-01 12:10:00", 3), ("2024-01-01 15:00:00", 4), (None, 9)]
    df = spark.createDataFrame(rows, "t string, n long").select(F.col("t").cast("timestamp_ntz").alias("ts"), "n")
    got = [(r.bucket.hour, r.n) for r in R.resample(df, "ts", ["n"], 3).orderBy("bucket").collect()]
    assert got == [(3, 2), (6, 0), (9, 0), (12, 3)]
    assert R.resample(df, "ts", ["n"], 3, dense=False, drop_edges=False).count() == 4
    assert R.resample(df.limit(0), "ts", ["n"], 3).count() == 0


def test_series_models(spark):
    x = np.linspace(0, 1, 30)
    y = 3 - 2 * x + x**5
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(y)] + [("one", 0, 5.0)], "k string, o int, v double")
    got = {(r.k, r.o): r.fitted for r in R.polynomial(df, ["k"], "o", "v").collect()}
    assert got["one", 0] == pytest.approx(5.0) and all(got["s", i] == pytest.approx(v) for i, v in enumerate(y))
    assert [got["s", i] for i in range(30)] == pytest.approx(np.polyval(np.polyfit(x, y, 5), x))
    grown = [100 * 1.1**i for i in range(8)]
    fitted, ahead = R.holt_path(np.array(grown), 0.8, 0.3, 3)
    assert ahead == pytest.approx([100 * 1.1**i for i in (8, 9, 10)]) and fitted[1:] == pytest.approx(grown[1:])
    df = spark.createDataFrame([("s", i, v) for i, v in enumerate(grown)], "k string, o int, v double")
    assert [r.forecast for r in R.holt(df, ["k"], "o", "v", 0.8, 0.3, 2).orderBy("step").collect()] == pytest.approx([110 * 1.1**8, 110 * 1.1**9])
    a = spark.createDataFrame([(1, 2.0), (2, 4.0)], "d int, x double")
    b = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 9.0)], "d int, y double")
    assert R.rmse(a, b, "d", "x", "y").first().rmse == round(math.sqrt(5), 2)


def test_metrics(spark):
    df = spark.createDataFrame([("save/a/1",), ("save/b/1",), ("save/a/2",), ("x",)], "path string")
    assert [(r.shard, r.cnt) for r in M.shard_counts(df).collect()] == [("a", 2), (None, 1), ("b", 1)]
    t = spark.createDataFrame([(1, 1.0), (2, None)], "id int, similarity double")
    assert tuple(M.totals(t).first()) == (2, 1)
    assert json.loads(M.stats_page(M.totals(t)).first().json) == {"total": 2, "with_value": 1}
    d = spark.createDataFrame([("f", 1, 5), ("f", 2, 9), ("f", 3, 9)], "k string, o int, c int")
    assert [r.delta for r in M.deltas(d, ["k"], "o", "c").orderBy("o").collect()] == [5, 4, 0]
    assert M.throughput(t.limit(0).withColumn("s", F.lit(1)), "id", "s").first().per_s is None
