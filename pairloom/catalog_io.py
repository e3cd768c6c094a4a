"""Registered queries of sources, sinks, streams and injected models: what a sink writes to
the shared folder is read back by the source of the same kind and compared."""

from __future__ import annotations

import atexit

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas, sinks, streaming
from .catalog import _ANCHORS, _SERIES, _TYPES, _resample_sql, register, table
from .functions import image as I  # noqa: E741
from .functions import media as A
from .functions import text as X
from .functions import url as U
from .functions import vector as V
from .operators import dedup as D
from .operators import links as L
from .operators import metrics as M
from .operators import series as R
from .operators import state as S
from .shared import discard, fresh
from .sources import delimited, files

_written: list[tuple[SparkSession, str]] = []


def _path(spark: SparkSession, name: str) -> str:
    """A fresh folder, deleted when the driver ends."""
    if not _written:
        atexit.register(_clean)
    _written.append((spark, fresh(spark, name)))
    return _written[-1][1]


def _clean() -> None:
    for spark, path in _written:
        discard(spark, path)


# ---------------------------------------------------------------- crawl lines


@register(f"WITH {_ANCHORS} SELECT page_id, pos::BIGINT AS pos, regexp_replace(regexp_extract(url, '(?s)^(.*)/', 1), '/+$', '') AS base, href, label FROM anchors")
def crawl_lines(spark, sf_dir):
    """pages' anchors as lines of crawl metadata, written and parsed again."""
    path = _path(spark, "crawl")
    both = F.arrays_zip(F.regexp_extract_all("html", F.lit(L.ANCHOR), 1).alias("href"), F.regexp_extract_all("html", F.lit(L.ANCHOR), 2).alias("label"))
    links = F.transform(both, lambda x: F.struct(F.lit("IMG@/src").alias("path"), x["href"].alias("url"), x["label"].alias("alt")))
    html = F.struct(F.struct(F.struct(links.alias("Links")).alias("HTML-Metadata")).alias("HTTP-Response-Metadata"))
    inner = html.getField("HTTP-Response-Metadata")
    line = F.struct(F.struct(F.struct(F.col("url").alias("WARC-Target-URI")).alias("WARC-Header-Metadata"), F.struct(inner.alias("HTTP-Response-Metadata")).alias("Payload-Metadata")).alias("Envelope"), F.col("page_id").alias("id"))
    table(spark, sf_dir, "pages").select(F.to_json(line)).write.text(path)
    lines = spark.read.text(path).select(F.lit(1).alias("wat"), F.get_json_object("value", "$.id").cast("long").alias("line"), "value")
    found = L.crawl_links(lines)
    return found.select(F.col("line").alias("page_id"), F.col("pos").cast("long").alias("pos"), "base", F.col("url").alias("href"), F.col("alt").alias("label"))


@register("WITH l AS (SELECT page_id, page_id % 5 AS wat, row_number() OVER (PARTITION BY page_id % 5 ORDER BY page_id) - 1 AS line, count(*) OVER (PARTITION BY page_id % 5) AS n FROM pages) SELECT page_id, least(floor(line * 2 / n), 1)::INT AS shard FROM l")
def line_halves(spark, sf_dir):
    """Each file's lines in two halves."""
    lines = D.with_ids(table(spark, sf_dir, "pages").select("page_id", (F.col("page_id") % 5).alias("wat")), ["wat"], ["page_id"], F.lit(0), "line")
    return L.line_shard(lines).select("page_id", "shard")


@register("SELECT page_id, url || '/' || page_id || '.mp3' AS media_url, 'song ' || page_id AS label FROM pages WHERE page_id % 3 = 0 UNION ALL SELECT page_id, regexp_extract(url, '^([A-Za-z]+://[^/?#]+)', 1) || '/' || page_id || '.mp3', '' FROM pages WHERE page_id % 3 = 1")
def audio_links(spark, sf_dir):
    """mp3 addresses put into pages, found again."""
    m = F.col("page_id") % 3
    number = F.col("page_id").cast("string")
    more = F.when(m == 0, F.concat(F.lit('<a class="x" href="'), number, F.lit('.mp3"><b>song</b> '), number, F.lit("</a>"))).when(m == 1, F.concat(F.lit("<audio controls src='/"), number, F.lit(".mp3'></audio>"))).otherwise("<a href='x.mp4'>x</a>")
    found = L.media_links(table(spark, sf_dir, "pages").withColumn("html", F.concat("html", more)))
    return found.where(U.is_audio("media_url")).select("page_id", "media_url", "label")


# ---------------------------------------------------------------- delimited text and JSON

_KEPT = "doc_id AS sampleid, 'http://' || source || '/' || doc_id AS url, md5(text) AS text, lang AS language"


@register("SELECT doc_id AS sampleid, 'say \"' || source || '\", a\\b' AS text, lang AS language, CASE WHEN doc_id % 3 = 0 THEN NULL ELSE source END AS domain, (doc_id % 7)::INT AS wat, doc_id % 2 = 0 AS illegal FROM documents")
def bar_csv(spark, sf_dir):
    """S3, K3: bar-separated files with quotes, backslashes and nulls, written and read."""
    path = _path(spark, "csv")
    df = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("sampleid"),
        F.concat(F.lit('say "'), "source", F.lit('", a\\b')).alias("text"),
        F.col("lang").alias("language"),
        F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("domain"),
        (F.col("doc_id") % 7).cast("int").alias("wat"),
        (F.col("doc_id") % 2 == 0).alias("illegal"),
    )
    sinks.pipe_csv(df, path)
    return delimited.pipe_csv(spark, path, df.schema)


@register(f"SELECT {_KEPT}, 'CC' AS license, source AS domain, 1 AS wat, md5(source) AS hash FROM documents WHERE doc_id % 10 <> 3")
def tab_lines(spark, sf_dir):
    """Tab-separated candidates, written and read; lines with a NUL are dropped."""
    path = _path(spark, "tab")
    nul = F.when(F.col("doc_id") % 10 == 3, F.concat(F.col("source"), F.lit("\0"))).otherwise(F.col("source"))
    df = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("sampleid"), F.concat(F.lit("http://"), "source", F.lit("/"), "doc_id").alias("url"), F.md5("text").alias("text"), F.lit("CC").alias("license"), nul.alias("domain"), F.lit(1).alias("wat"), F.md5("source").alias("hash"), F.col("lang").alias("language"))
    sinks.tab_txt(df, path)
    return delimited.tab_txt(spark, path)


@register(_resample_sql(3).replace("click", "en").replace("view", "intl").replace("purchase", "nolang").replace("event_type = 'en'", "event_type = 'click'").replace("event_type = 'intl'", "event_type = 'view'").replace("event_type = 'nolang'", "event_type = 'purchase'"))
def datapoint_series(spark, sf_dir):
    """Hourly counts as datapoint files, read with their epochs and summed by 3 hours."""
    path = _path(spark, "datapoints")
    names = dict(zip(_SERIES, ("en", "intl", "nolang"), strict=True))
    hour = F.unix_seconds(F.date_trunc("hour", F.col("ts").cast("timestamp")))
    counts = table(spark, sf_dir, "events").groupBy(hour.alias("epoch")).agg(*(F.count_if(F.col("event_type") == t).alias(n) for t, n in names.items()))
    sinks.tab_txt(counts.withColumn("epoch", F.col("epoch").cast("double")), path)
    df = R.resample(delimited.datapoints(spark, path), "ts", list(names.values()), 3)
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@register("SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS ts, count(DISTINCT user_id) AS unique_pairs, count(*) AS total, count(*) FILTER (event_type = 'click') AS clipped, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1")
def log_lines(spark, sf_dir):
    """Hourly counts as lines of a filter log, with junk between, parsed again."""
    path = _path(spark, "log")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    # Users once an hour first, so that the distinct count is two partial aggregations.
    users = table(spark, sf_dir, "events").groupBy(hour.alias("h"), "user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "click").alias("c"), F.count_if(F.col("event_type") == "error").alias("f"))
    rows = users.groupBy("h").agg(F.count("*").alias("u"), F.sum("n").alias("n"), F.sum("c").alias("c"), F.sum("f").alias("f"))
    line = F.concat(F.lit("["), F.date_format("h", "yyyy/MM/dd_HH:mm"), F.lit("] unique "), "u", F.lit(" total "), "n", F.lit(" clipped "), "c", F.lit(" failed "), "f", F.lit(" pairs"))
    rows.select(F.explode(F.array(line, F.lit("restarted"), F.lit("[2024/01/01] unique x")))).write.text(path)
    return delimited.filter_log(spark, path).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm"))


@register("SELECT o_orderkey, o_custkey, o_orderpriority, round(o_totalprice, 2) AS o_totalprice FROM orders")
def json_arrays(spark, sf_dir):
    """A JSON array a file, written and read."""
    path = _path(spark, "json")
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", F.round("o_totalprice", 2).alias("o_totalprice"))
    # A thousand orders a file, so that no array grows with the table.
    packs = df.groupBy(F.expr("o_orderkey div 4000").alias("pack")).agg(F.to_json(F.collect_list(F.struct(*df.columns))).alias("value"))
    packs.write.partitionBy("pack").text(path)
    return delimited.json_results(spark, f"{path}/*", df.schema)


@register("""SELECT event_id AS "id", user_id AS "who.user", json_extract_string(props, '$.k')::BIGINT AS "who.props.k", event_type AS "kind" FROM events""")
def json_flattened(spark, sf_dir):
    """Nested JSON as columns with dotted names."""
    props = F.from_json("props", "k bigint")
    j = F.to_json(F.struct(F.col("event_id").alias("id"), F.struct(F.col("user_id").alias("user"), props.alias("props")).alias("who"), F.col("event_type").alias("kind")))
    return delimited.flattened(table(spark, sf_dir, "events").select(j.alias("j")), "j", "id bigint, who struct<user: bigint, props: struct<k: bigint>>, kind string")


@register("SELECT c_custkey AS SAMPLE_ID, c_name AS TEXT, (c_custkey % 300)::INT AS WIDTH, CASE WHEN c_custkey % 4 = 0 THEN 'gif' WHEN c_custkey % 4 = 1 THEN 'png' ELSE 'webp' END AS KIND FROM customer WHERE c_custkey % 4 <> 3")
def shard_repaired(spark, sf_dir):
    """Whole files with a newline before a bar, repaired and parsed; rows whose image
    doesn't open go."""
    path = _path(spark, "shard")
    m = F.col("c_custkey") % 4
    heads = {"gif": "474946383961", "png": "89504E470D0A1A0A", "webp": "52494646000000005745425056"}
    content = F.when(m == 0, heads["gif"]).when(m == 1, heads["png"]).when(m == 2, heads["webp"]).otherwise("3C68746D6C3E")
    kind = F.when(m == 0, "gif").when(m == 1, "png").otherwise("webp")
    line = F.concat_ws("|", F.col("c_custkey").cast("string"), F.concat(F.col("c_name"), F.when(F.col("c_custkey") % 5 == 0, "\n").otherwise("")), (F.col("c_custkey") % 300).cast("string"), kind, content)
    table(spark, sf_dir, "customer").select(F.explode(F.array(F.lit("SAMPLE_ID|TEXT|WIDTH|KIND|CONTENT"), line))).write.text(path)
    rows = delimited.shard_csv(spark, path, schemas._struct("SAMPLE_ID long, TEXT string, WIDTH int, KIND string, CONTENT string"))
    return delimited.openable(rows.withColumn("content", F.unhex("CONTENT"))).select("SAMPLE_ID", "TEXT", "WIDTH", "KIND")


@register("SELECT c_custkey, 'a' || chr(10) || c_custkey AS field, list_element(['en', 'intl', 'nolang'], (c_custkey % 3 + 1)::INT) AS kind, c_custkey * 3 AS payload FROM customer WHERE c_custkey % 7 <> 0")
def messages(spark, sf_dir):
    """records whose fields hold newlines; messages of one colon."""
    kind = F.element_at(F.array(F.lit("en"), F.lit("intl"), F.lit("nolang")), (F.col("c_custkey") % 3 + 1).cast("int"))
    message = F.concat(kind, F.lit(":"), (F.col("c_custkey") * 3).cast("string"), F.when(F.col("c_custkey") % 7 == 0, ":more").otherwise(""))
    record = F.concat(F.col("c_custkey").cast("string"), F.lit("\ta\n"), F.col("c_custkey").cast("string"), F.lit("\t"), message)
    both = F.concat(record, F.lit("\n"), record, F.lit("\n"))
    df = table(spark, sf_dir, "customer").select(X.records(both, 3).alias("r")).select(F.explode(F.array_distinct("r")).alias("r"))
    return df.select(F.col("r")[0].cast("long").alias("c_custkey"), F.col("r")[1].alias("field"), X.message(F.col("r")[2]).alias("m")).where("m is not null").select("c_custkey", "field", "m.kind", F.col("m.payload").cast("long").alias("payload"))


# ---------------------------------------------------------------- tables, keys, archives


@register("SELECT CASE WHEN n_chars < 400 THEN 'nolang' WHEN lang = 'en' THEN 'en' ELSE 'intl' END AS route, count(*) AS cnt, sum(doc_id)::BIGINT AS ids FROM documents GROUP BY 1")
def routed_append(spark, sf_dir):
    """Two batches appended to a table in folders by route."""
    path = _path(spark, "routed")
    df = table(spark, sf_dir, "documents").select("doc_id", S.route(F.when(F.col("n_chars") < 400, "").otherwise(F.col("lang"))).alias("route"))
    for half in (0, 1):
        sinks.append_routed(df.where(F.col("doc_id") % 2 == half), path)
    return spark.read.parquet(path).groupBy("route").agg(F.count("*").alias("cnt"), F.sum("doc_id").alias("ids"))


@register("SELECT doc_id FROM documents")
def parquet_files(spark, sf_dir):
    """Every Parquet file under a folder, whatever its depth."""
    path = _path(spark, "tree")
    df = table(spark, sf_dir, "documents").select("doc_id", "source")
    df.write.partitionBy("source").parquet(f"{path}/a/b")
    return delimited.parquet_tree(spark, path, schemas._struct("doc_id long"))


@register("SELECT c_custkey AS SAMPLE_ID, c_name AS TEXT, (c_custkey % 300)::INT AS HEIGHT, (c_custkey % 200)::INT AS WIDTH, 2 AS STATUS FROM customer")
def download_csv(spark, sf_dir):
    """K4: the legacy file, in which the labels of height and width are swapped."""
    path = _path(spark, "legacy")
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.lit("p").alias("path"), F.lit("u").alias("url"), F.col("c_name").alias("text"), (F.col("c_custkey") % 300).cast("int").alias("width"), (F.col("c_custkey") % 200).cast("int").alias("height"), F.lit("?").alias("license"), F.lit("en").alias("language"), F.lit(2).alias("status"))
    sinks.legacy_download_csv(df, path)
    return delimited.pipe_csv(spark, path, schemas.DOWNLOAD_CSV).select("SAMPLE_ID", "TEXT", "HEIGHT", "WIDTH", "STATUS")


@register("SELECT c_custkey AS sample_id, md5(c_name) AS hash, jobset FROM customer, (SELECT unnest(['nolang', 'en']) AS jobset)")
def scored_sets(spark, sf_dir):
    """K5: Parquet for nolang, bar-separated for the rest."""
    df = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("sample_id"), F.md5("c_name").alias("hash"))
    a, b = _path(spark, "scored-nolang"), _path(spark, "scored-en")
    sinks.scored(df, a, "nolang")
    sinks.scored(df, b, "en")
    return spark.read.parquet(a).withColumn("jobset", F.lit("nolang")).unionByName(delimited.pipe_csv(spark, b, df.schema).withColumn("jobset", F.lit("en")))


@register("SELECT lang AS folder, sum(length(md5(text)) + 1)::BIGINT AS n_bytes FROM documents GROUP BY lang")
def key_files(spark, sf_dir):
    """Key files by folder, listed without their contents."""
    path = _path(spark, "keys")
    docs = table(spark, sf_dir, "documents").select("lang", F.md5("text").alias("hash"))
    docs.write.partitionBy("lang").text(path)  # a folder a language
    found = files.listing(spark, path, "part-*")
    return found.select(F.regexp_extract("path", "/lang=([^/]*)/[^/]*$", 1).alias("folder"), "n_bytes").groupBy("folder").agg(F.sum("n_bytes").alias("n_bytes"))


@register("SELECT DISTINCT md5(text) AS key FROM documents")
def key_lines(spark, sf_dir):
    """Keys written one a line and read."""
    path = _path(spark, "lines")
    sinks.keys(table(spark, sf_dir, "documents").select(F.md5("text").alias("hash")).distinct(), path)
    return spark.read.text(path).select(F.col("value").alias("key"))


@register("SELECT vec_id AS sample_id, 'label ' || label AS label, (vec_id % 300)::INT AS height, (vec_id % 200)::INT AS width, hex(('img' || vec_id)::BLOB) AS image, list_sum(embedding::DOUBLE[])::DECIMAL(18, 4)::DOUBLE AS total FROM embeddings WHERE vec_id % 3 <> 0")
def example_files(spark, sf_dir):
    """Examples with their images' bytes, and embeddings by sample id."""
    a, b = _path(spark, "examples"), _path(spark, "embeddings")
    df = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), "embedding", F.concat(F.lit("label "), "label").alias("text"), (F.col("vec_id") % 300).cast("int").alias("height"), (F.col("vec_id") % 200).cast("int").alias("width"), F.lit("PNG").alias("format"), F.col("vec_id").cast("string").alias("path"))
    images = df.where("sample_id % 3 <> 0").select("path", F.concat(F.lit("img"), "path").cast("binary").alias("content"))
    sinks.examples(df, images, a)
    sinks.embeddings(df, b)
    total = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double"))
    both = spark.read.parquet(a).join(spark.read.parquet(b), "sample_id")
    return both.select("sample_id", "label", "height", "width", F.hex("image").alias("image"), total.cast("decimal(18,4)").cast("double").alias("total"))


@register("SELECT strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr, count(*) AS cnt FROM events GROUP BY 1, 2")
def archive_folders(spark, sf_dir):
    """An archive by date and hour."""
    path = _path(spark, "archive")
    sinks.archive(table(spark, sf_dir, "events").select("event_id", "ts"), path, "ts")
    found = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").parquet(path)
    return found.groupBy(F.date_format("dt", "yyyy-MM-dd").alias("dt"), F.lpad(F.col("hr").cast("string"), 2, "0").alias("hr")).agg(F.count("*").alias("cnt"))


@register(
    """WITH f AS (SELECT event_id, 'save/' || md5(user_id::VARCHAR) || '/' || event_id || '.' || list_element(['clp', 'hsh', 'tar.gz', 'txt', 'bin'], (event_id % 5 + 1)::INT) AS path, ts FROM events)
SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'clipped' WHEN 1 THEN 'hashes' WHEN 2 THEN 'archive' WHEN 3 THEN 'text' ELSE 'other' END AS class, event_id::VARCHAR AS stem FROM f WHERE ts <= TIMESTAMP '2024-01-10' - INTERVAL 3600 SECONDS"""
)
def old_files(spark, sf_dir):
    """Files older than an hour before a reference time, and their class."""
    kinds = F.array(*map(F.lit, ("clp", "hsh", "tar.gz", "txt", "bin")))
    path = F.concat(F.lit("save/"), F.md5(F.col("user_id").cast("string")), F.lit("/"), F.col("event_id").cast("string"), F.lit("."), F.element_at(kinds, (F.col("event_id") % 5 + 1).cast("int")))
    df = table(spark, sf_dir, "events").select("event_id", path.alias("path"), F.col("ts").cast("timestamp").alias("mtime"))
    old = files.older_than(df.where(U.is_work_folder(U.component("path", 1))), 3600, F.lit("2024-01-10 00:00:00").cast("timestamp"))
    return old.select("event_id", sinks.archive_class("path").alias("class"), U.stem("path").alias("stem"))


@register(
    """SELECT 'capacity' AS page, s_suppkey AS id, '{"used":' || s_suppkey || ',"total":100,"utilization":' || round(s_suppkey / 100, 2)::DOUBLE || '}' AS json FROM supplier
UNION ALL SELECT 'stats', NULL, '{"suppliers":' || count(*) || ',"keys":' || sum(s_suppkey)::BIGINT || ',"nations":' || count(DISTINCT s_nationkey) || '}' FROM supplier"""
)
def capacity_json(spark, sf_dir):
    """Rows with their utilization, and the page of sums, as JSON."""
    df = table(spark, sf_dir, "supplier")
    each = files.capacity(df.select(F.col("s_suppkey").cast("long").alias("used"), F.lit(100).cast("long").alias("total")))
    each = each.select(F.lit("capacity").alias("page"), F.get_json_object("json", "$.used").cast("long").alias("id"), "json")
    sums = df.agg(F.count("*").alias("suppliers"), F.sum(F.col("s_suppkey").cast("long")).alias("keys"), F.countDistinct("s_nationkey").alias("nations"))
    return each.unionByName(M.stats_page(sums).withColumn("page", F.lit("stats")), allowMissingColumns=True)


# ---------------------------------------------------------------- membership and order


@register("WITH d AS (SELECT doc_id, md5(text) AS h FROM documents) SELECT doc_id FROM d WHERE doc_id % 4 = 1 AND h NOT IN (SELECT h FROM d WHERE doc_id % 4 = 2) AND h NOT IN (SELECT h FROM d WHERE doc_id % 4 = 3)")
def anti_chain(spark, sf_dir):
    """One seen set after the other."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    part = lambda i: df.where(F.col("doc_id") % 4 == i)
    return D.unseen_in_all(part(1), [part(2), part(3)], "h").select("doc_id")


@register("SELECT doc_id FROM documents WHERE doc_id % 3 <> 0")
def anti_stem(spark, sf_dir):
    """Files whose stem was not done."""
    done = table(spark, sf_dir, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").cast("string").alias("stem"))
    found = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("a/"), F.col("doc_id").cast("string"), F.lit(".tar.gz")).alias("path"))
    return D.unseen(found.withColumn("stem", U.stem("path")), done, "stem").select("doc_id")


@register("SELECT doc_id, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS place FROM documents")
def shuffled_places(spark, sf_dir):
    """Each row's place in the order that ``shuffled`` gives."""
    df = table(spark, sf_dir, "documents").select("doc_id")
    # Ids that rise in the order in which rows come, from partition to partition.
    came = D.shuffled(df, "doc_id", 7).withColumn("at", F.monotonically_increasing_id())
    return D.with_ids(came.withColumn("one", F.lit(1)), ["one"], ["at"], F.lit(1), "place").select("doc_id", "place")


@register("SELECT (o_orderkey % 1000)::VARCHAR AS number, o_orderkey FROM orders ORDER BY o_orderkey % 1000, o_orderkey LIMIT 300")
def numbers_in_order(spark, sf_dir):
    """Text numbers by value; the first 300 are asked for."""
    df = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 1000).cast("string").alias("number"), "o_orderkey")
    least = D.by_number(df, "number").select("number").limit(300).agg(F.max(F.col("number").cast("long"))).first()[0]
    return D.first_rows(df.where(F.col("number").cast("long") <= least).withColumn("value", F.col("number").cast("long")), 300, ["value", "o_orderkey"]).drop("value")


@register("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 2000")
def first_by_ranges(spark, sf_dir):
    """O1: an export batch beyond what one task may hold (here 100 rows), cut by ranges."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return D.first_rows(df, 2000, ["o_orderdate", "o_orderkey"], most=100).drop("o_orderdate")


# ---------------------------------------------------------------- jobs and streams

_WHEN = "TIMESTAMP '2024-03-01 00:00:00'"


@register(f"WITH c AS (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0 ORDER BY 1 LIMIT 100) SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 <> 0 THEN 2 WHEN o_orderkey IN (SELECT o_orderkey FROM c) THEN 1 ELSE 0 END AS status, strftime(CASE WHEN o_orderkey IN (SELECT o_orderkey FROM c) THEN {_WHEN} ELSE TIMESTAMP '2024-01-01' END, '%Y-%m-%d') AS modified FROM orders")
def claim_modified(spark, sf_dir):
    """A claim sets the time of change."""
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 5 == 0, 0).otherwise(2).alias("status"), F.lit("2024-01-01").cast("timestamp").alias("modified"))
    got = S.apply_claim(df, S.claim(df, "id", 100), "id", F.lit("2024-03-01").cast("timestamp"))
    return got.withColumn("modified", F.date_format("modified", "yyyy-MM-dd"))


@register("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 9 ELSE 1 END AS status, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 20 ELSE 5 END AS width FROM orders")
def complete_twice(spark, sf_dir):
    """Two results for a key, the last counts; a null is written."""
    df = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit(1).alias("status"), F.lit(5).alias("width"))
    done = df.where("id % 2 = 0")
    first = done.select("id", F.lit(1).alias("n"), F.lit(2).alias("status"), F.lit(10).alias("width"))
    second = done.select("id", F.lit(2).alias("n"), F.lit(9).alias("status"), F.when(F.col("id") % 3 != 0, 20).alias("width"))
    return S.complete(df, first.unionByName(second), "id", ["status", "width"], order=["n"])


@register(f"SELECT md5(c::VARCHAR) AS jobid, CASE WHEN c % 2 = 0 THEN 3 ELSE 0 END AS status, strftime(CASE WHEN c % 2 = 0 THEN TIMESTAMP '2024-01-01' ELSE {_WHEN} END, '%Y-%m-%d') AS modified FROM (SELECT c_custkey AS c FROM customer)")
def jobs_added(spark, sf_dir):
    """New jobs are added, those there stay."""
    df = table(spark, sf_dir, "customer").select("c_custkey", F.md5(F.col("c_custkey").cast("string")).alias("jobid"))
    there = df.where("c_custkey % 2 = 0").select("jobid", F.lit(3).alias("status"), F.lit("2024-01-01").cast("timestamp").alias("modified"))
    got = S.add_jobs(there, df.unionByName(df).select("jobid"), F.lit("2024-03-01").cast("timestamp"))
    return got.withColumn("modified", F.date_format("modified", "yyyy-MM-dd"))


@register("SELECT md5(text) AS h, count(*) AS copies FROM documents GROUP BY 1")
def stream_once(spark, sf_dir):
    """Q4, Q6, Q7: files as a stream, each key kept once across batches; beside each the number
    of its rows, by a plain aggregation.  The stream goes on from its checkpoint after each arrival."""
    path, out, mark = (_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    df = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    for i in range(3):  # three arrivals
        df.where(F.col("doc_id") % 3 == i).write.mode("append").parquet(path)
        streaming.dedup_once(streaming.file_stream(spark, path, df.schema), "h", ["doc_id"], out, mark).awaitTermination()
    kept = streaming.seen_rows(spark, out, df.schema)
    return kept.select("h").join(df.groupBy("h").agg(F.count("*").alias("copies")), "h")


@register("SELECT CASE WHEN lang = 'en' THEN 'en' ELSE 'intl' END AS route, count(*) AS cnt FROM documents GROUP BY 1")
def stream_routed(spark, sf_dir):
    """A routed stream, everything available, to a table."""
    path, out, mark = (_path(spark, n) for n in ("routed-in", "routed-out", "routed-mark"))
    df = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("language"))
    df.write.parquet(path)
    stream = streaming.routed(streaming.file_stream(spark, path, df.schema))
    stream.writeStream.format("parquet").option("checkpointLocation", mark).trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.parquet(out).groupBy("route").agg(F.count("*").alias("cnt"))


# ---------------------------------------------------------------- models and media


def _toy_encoder():
    """A deterministic encoder: length, words, and the share of vowels in thousandths."""

    def encode(f: pd.DataFrame) -> pd.DataFrame:
        s = f["text"].fillna("")
        vowels = s.str.count("[aeiou]") * 1000 // s.str.len().clip(lower=1)
        return pd.DataFrame({"doc_id": f["doc_id"], "embedding": [[float(a), float(b), float(c)] for a, b, c in zip(s.str.len(), s.str.count(" "), vowels, strict=True)]})

    return encode


@register("SELECT doc_id, length(text)::FLOAT AS a, (length(text) - length(replace(text, ' ', '')))::FLOAT AS b, (length(regexp_replace(text, '[^aeiou]', '', 'g')) * 1000 // greatest(length(text), 1))::FLOAT AS c FROM documents")
def encoded_batches(spark, sf_dir):
    """M1: whole texts through an encoder in batches."""
    got = V.encoded(table(spark, sf_dir, "documents"), ["doc_id", "text"], "doc_id long, embedding array<float>", _toy_encoder)
    return got.select("doc_id", *(F.col("embedding")[i].alias(c) for i, c in enumerate("abc")))


@register("SELECT n_regionkey AS category, n_nationkey AS label_id, lower(n_name) AS label, length(n_name)::FLOAT AS a, (length(n_name) - length(replace(n_name, ' ', '')))::FLOAT AS b FROM nation")
def category_vectors(spark, sf_dir):
    """M5: categories and their labels from a table, and what an encoder makes of the labels."""
    labels = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("category"), F.col("n_nationkey").cast("long").alias("doc_id"), F.lower("n_name").alias("text"))
    vectors = V.encoded(labels, ["doc_id", "text"], "doc_id long, embedding array<float>", _toy_encoder)
    return labels.join(vectors, "doc_id").select("category", F.col("doc_id").cast("int").alias("label_id"), F.col("text").alias("label"), F.col("embedding")[0].alias("a"), F.col("embedding")[1].alias("b"))


@register("SELECT c_custkey, 40 AS n, (c_custkey * 40 + 389.5)::DOUBLE AS total FROM customer")
def audio_resampled(spark, sf_dir):
    """M8: a ramp of 20 samples at half the rate has 40, half a step apart, the last held."""
    ramp = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda x: (x + F.col("c_custkey")).cast("float"))
    df = table(spark, sf_dir, "customer").select("c_custkey", ramp.alias("s"))
    got = df.select("c_custkey", A.resampled("s", F.lit(A.AUDIO_RATE // 2)).alias("r"))
    return got.select("c_custkey", F.size("r").alias("n"), F.aggregate("r", F.lit(0.0), lambda s, x: s + x.cast("double")).alias("total"))


@register("SELECT l_orderkey, l_linenumber, l_linenumber % 4 <> 3 AS opens FROM lineitem")
def images_that_open(spark, sf_dir):
    """By the bytes that a file begins with."""
    heads = ("FFD8FFE0", "89504E470D0A1A0A00", "524946460A00000057454250", "3C3F786D6C")
    content = F.unhex(F.element_at(F.array(*map(F.lit, heads)), (F.col("l_linenumber") % 4 + 1).cast("int")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", I.opens(content).alias("opens"))
