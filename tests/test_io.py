import datetime
import os

import time

import pytest
from pyspark.sql import functions as F

from pairloom import catalog_io, schemas, sinks
from pairloom import streaming as T
from pairloom.sources import delimited as D
from pairloom.sources import fetch, files


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_pipe_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", 'a "quoted" text', 5), (2, "v", "line\nbreak", None)], "sample_id long, url string, text string, width int")
    sinks.pipe_csv(df, str(tmp_path / "x"))
    assert rows(D.pipe_csv(spark, str(tmp_path / "x"), df.schema)) == rows(df)


def test_legacy_download_csv_swaps_labels(spark, tmp_path):
    df = spark.createDataFrame([(1, "p", "u", "t", 10, 20, "?", "en", 2)], schemas.DOWNLOAD)
    sinks.legacy_download_csv(df, str(tmp_path / "x"))
    r = D.pipe_csv(spark, str(tmp_path / "x"), schemas.DOWNLOAD_CSV).first()
    assert (r.HEIGHT, r.WIDTH) == (10, 20)


def test_tab_txt(spark, tmp_path):
    df = spark.createDataFrame([(1, "u", "t", "?", "d", 3, "h", "en"), (2, "u", None, "?", "d", 3, "h", "")], schemas.CANDIDATE)
    sinks.tab_txt(df, str(tmp_path / "x"))
    (tmp_path / "x" / "extra.txt").write_text("bad\tline\n3\tu\t\0\t?\td\t3\th\ten\n4\tu\tt\t?\td\tx\th\ten\n")
    got = {r.sampleid: r for r in D.tab_txt(spark, str(tmp_path / "x")).collect()}
    assert sorted(got) == [1, 2, 4] and got[2].text == "" and got[4].wat is None


def test_keys_and_routes(spark, tmp_path):
    df = spark.createDataFrame([("h1", "en", 1), ("h2", "intl", 2), (None, "en", 3)], "hash string, route string, id int")
    sinks.keys(df, str(tmp_path / "k"))
    assert rows(spark.read.text(str(tmp_path / "k"))) == [("h1",), ("h2",)]
    sinks.append_routed(df, str(tmp_path / "r"))
    sinks.append_routed(df, str(tmp_path / "r"))
    got = spark.read.parquet(str(tmp_path / "r"))
    assert got.where("route = 'en'").count() == 4 and D.parquet_tree(spark, str(tmp_path / "r")).count() == 6
    for jobset in ("nolang", "en"):
        sinks.scored(df, str(tmp_path / jobset), jobset)
    assert spark.read.parquet(str(tmp_path / "nolang")).count() == 3
    assert D.pipe_csv(spark, str(tmp_path / "en"), df.schema).count() == 3


def test_archives_examples_embeddings(spark, tmp_path):
    df = spark.createDataFrame([("a.clp", datetime.datetime(2024, 3, 5, 7)), ("b.gz", datetime.datetime(2024, 11, 5, 17))], "path string, ts timestamp")
    assert rows(df.select(sinks.dated("ts"), sinks.dated("ts", False), sinks.archive_class("path"))) == [("2024-03-05", "2024-3-5", "clipped"), ("2024-11-05", "2024-11-5", "archive")]
    sinks.archive(df, str(tmp_path / "a"), "ts")
    assert sorted(os.listdir(tmp_path / "a" / "dt=2024-03-05")) == ["hr=07"]
    meta = spark.createDataFrame([(1, "p", "JPEG", "t", 2, 3)], "sample_id long, path string, format string, text string, height int, width int")
    sinks.examples(meta, spark.createDataFrame([("p", bytearray(b"x"))], "path string, content binary"), str(tmp_path / "e"))
    r = spark.read.parquet(str(tmp_path / "e")).first()
    assert bytes(r.image) == b"x" and r.label == "t"
    sinks.embeddings(spark.createDataFrame([(1, [0.5])], schemas.EMBEDDING), str(tmp_path / "v"))
    assert spark.read.parquet(str(tmp_path / "v")).first().embedding == [0.5]


def test_logs(spark, tmp_path):
    (tmp_path / "d.txt").write_text("1638000000.5\t3\t4\t5\n")
    r = D.datapoints(spark, str(tmp_path / "d.txt")).first()
    assert (r.ts, r.en, r.intl, r.nolang) == (datetime.datetime(2021, 11, 27, 8, 0, 0, 500000), 3, 4, 5)
    (tmp_path / "l.txt").write_text("[2021/12/01_10:05] unique 10 total 20 clipped 3 failed 0 x\njunk\n")
    assert rows(D.filter_log(spark, str(tmp_path / "l.txt"))) == [(datetime.datetime(2021, 12, 1, 10, 5), 10, 20, 3, 0)]


def test_repaired_shards_and_json(spark, tmp_path):
    schema = spark.createDataFrame([], "ID long, URL string, TEXT string").schema
    (tmp_path / "s.csv").write_text("ID|URL|TEXT\n1|u|a\n2|v\n|b\n")
    assert rows(D.shard_csv(spark, str(tmp_path / "s.csv"), schema)) == [(1, "u", "a"), (2, "v", "b")]
    (tmp_path / "j.json").write_text('[{"ID": 1, "URL": "u"},\n {"ID": 2}]')
    assert rows(D.json_results(spark, str(tmp_path / "j.json"), schema)) == [(1, "u", None), (2, None, None)]
    df = spark.createDataFrame([('{"a": {"b": 1, "c": "x"}, "d": 2}',)], "j string")
    got = D.flattened(df, "j", "a struct<b: int, c: string>, d int")
    assert got.columns == ["a.b", "a.c", "d"] and tuple(got.first()) == (1, "x", 2)


def test_listing(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for n, age in (("a.gz", 4000), ("b.gz", 10), ("c.txt", 4000)):
        (tmp_path / "f" / n).write_text("12345")
        os.utime(tmp_path / "f" / n, (1_700_000_000 - age,) * 2)
    found = files.listing(spark, str(tmp_path / "f"), "*.gz")
    ref = F.timestamp_seconds(F.lit(1_700_000_000))
    assert rows(files.older_than(found, 3600, ref).select("stem", "n_bytes")) == [("a", 5)]
    cap = spark.createDataFrame([(1, 3)], "used long, total long")
    assert files.capacity(cap).first().json == '{"used":1,"total":3,"utilization":0.33}'


def test_fetching(spark):
    def fetcher():
        def get(url, connect, total):
            if "bad" in url:
                raise OSError("no")
            return {"url": url + "?moved", "n_bytes": 4000 if "small" in url else 9000, "width": 10, "height": 20, "format": "PNG"}

        return get

    req = spark.createDataFrame([(1, "http://ok", "t", "?", "en"), (2, "http://bad", "t", "?", "en"), (3, "http://small", "t", "?", "en")], "sample_id long, url string, text string, license string, language string")
    got = {r.sample_id: r for r in fetch.fetched(req, fetcher).collect()}
    assert (got[1].status, got[2].status, got[3].status) == (2, 9, 16)
    assert got[1].url == "http://ok?moved" and got[2].url == "http://bad" and got[2].width is None


def test_fetches_end_and_hosts_have_a_rate(spark):
    asked = []

    def get(url, connect, total):
        asked.append((url.split("/")[2], time.monotonic()))
        if "hang" in url:
            time.sleep(8)
        if "bad" in url:
            raise OSError("no")
        return {"n_bytes": 9000, "width": 10, "height": 20, "format": "PNG"}

    rows = [{"host": h, "url": f"http://{h}/{kind}{i}", "sample_id": i} for i in range(12) for h, kind in (("a", "x"), ("b", "hang"), ("c", "bad"), (None, "x"))]
    for r in rows:
        r["url"] = r["url"].replace("None", "none")
    began = time.monotonic()
    got = list(fetch.ended(iter(rows), get, 5, 0.1, 0.4, 20.0))
    assert time.monotonic() - began < 4
    assert sorted(g["url"] for g in got) == sorted(r["url"] for r in rows)
    assert all(g.get("fault") == {"x": None, "hang": "timeout", "bad": "error"}["hang" if "hang" in g["url"] else "bad" if "bad" in g["url"] else "x"] for g in got)
    for h in "ac":
        times = sorted(t for host, t in asked if host == h)
        assert len(times) == 12 and times[-1] - times[0] >= 11 / 20.0 - 0.01
    assert list(fetch.ended(iter([]), get, 5, 0.1, 0.4, 20.0)) == []


SCHEMA = "id long, k string, language string"


def put(spark, path, n, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(str(path))


@pytest.mark.parametrize("files_per_batch", [1, 10])
def test_stream_dedup_equals_batch(spark, tmp_path, files_per_batch):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    put(spark, src, 0, [(1, "a", "en"), (2, "a", "fr"), (3, "b", "")])
    stream = lambda: T.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema, files_per_batch)
    T.dedup_once(stream(), "k", ["id"], out, cp).awaitTermination()
    put(spark, src, 1, [(4, "b", "en"), (5, "c", "en"), (6, None, "en"), (7, "c", "en")])
    T.dedup_once(stream(), "k", ["id"], out, cp).awaitTermination()
    T.dedup_once(stream(), "k", ["id"], out, cp).awaitTermination()  # nothing new
    got = spark.read.parquet(out)
    assert rows(got.select("id", "k")) == [(1, "a"), (3, "b"), (5, "c")]


def test_stream_route_equals_batch(spark, tmp_path):
    from pairloom.operators.state import route

    src = str(tmp_path / "src")
    data = [(1, "a", "en"), (2, "b", None), (3, "c", "fr")]
    put(spark, src, 0, data)
    stream = T.routed(T.file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema))
    T.to_memory(stream, "routed_rows", str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.table("routed_rows")) == rows(spark.createDataFrame(data, SCHEMA).withColumn("route", route("language")))


def test_batches_of_a_stream_do_not_grow_with_the_files(spark, sf, tmp_path, monkeypatch):
    """Three arrivals of several files each are three batches, and each key is kept once across them."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs.unionByName(docs.withColumn("doc_id", F.col("doc_id") + 1000)).repartition(12).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(catalog_io, "_path", lambda spark, name: f"{tmp_path}/{name}")
    got = {r.h: r.copies for r in catalog_io.stream_once(spark, str(tmp_path)).collect()}
    assert got == {r.h: r.n * 2 for r in docs.groupBy(F.md5("text").alias("h")).agg(F.count("*").alias("n")).collect()}
    assert len(list((tmp_path / "stream-in").glob("*.parquet"))) > 6
    assert sorted(p.name for p in (tmp_path / "stream-out").iterdir()) == ["batch=0", "batch=1", "batch=2"]


def test_parts_of_a_host_in_one_task_keep_their_rates(spark):
    """1200 addresses of one host at 800 a second take some 1.5 seconds, though all its parts are in one task."""

    def fetcher():
        return lambda url, connect, total: {"n_bytes": 9000, "width": 10, "height": 20, "format": "PNG"}

    req = spark.range(0, 1200, 1, 4).select(F.col("id").alias("sample_id"), F.concat(F.lit("http://one/"), F.col("id").cast("string")).alias("url"), *(F.lit("?").alias(c) for c in ("text", "license", "language")))
    fetch.fetched(req.limit(5), fetcher).collect()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        began = time.monotonic()
        got = fetch.fetched(req, fetcher, rate=800.0).collect()
        took = time.monotonic() - began
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len({r.sample_id for r in got}) == 1200 and 1.3 < took < 4
