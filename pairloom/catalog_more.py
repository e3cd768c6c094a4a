"""Registered queries of seen sets, image bytes, languages, repair, record files, byte ranges,
fetching and claims, each over a given table."""

from __future__ import annotations

from pyspark.sql import functions as F

from .catalog import register, table
from .catalog_io import _path
from .functions import imagebytes as I  # noqa: E741
from .functions import language as G
from .functions import text as X
from .sources import fetch
from .sources.byteranges import ByteRanges
from .sources.recordfiles import RecordFiles
from .operators.claims import Claims
from .operators.seen import SeenSet, filled, merged

# ---------------------------------------------------------------- seen sets

_HASHED = "d AS (SELECT doc_id, md5(text) AS h FROM documents)"


def _seen(spark, sf_dir):
    """A seen set of the documents with an even id, and all documents' keys."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    seen = SeenSet(spark, _path(spark, "seen"), 1_000_000, 16)
    seen.add(docs.where("doc_id % 2 = 0"), "h", "even")
    return seen, docs


@register(f"WITH {_HASHED} SELECT doc_id, h IN (SELECT h FROM d WHERE doc_id % 2 = 0) AS seen FROM d")
def seen_sharded(spark, sf_dir):
    """All documents against a sharded set of half of them."""
    seen, docs = _seen(spark, sf_dir)
    found = seen.already_seen(docs, "h").select("doc_id", F.lit(True).alias("seen"))
    return found.unionByName(seen.unseen(docs, "h").select("doc_id", F.lit(False).alias("seen")))


@register(f"WITH {_HASHED}, f AS (SELECT h, min(doc_id % 3) AS batch FROM d GROUP BY h) SELECT 'b' || batch AS batch, count(*) AS new_keys FROM f GROUP BY batch")
def seen_additions(spark, sf_dir):
    """Three batches added one after the other, the second twice; the new keys of each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    seen = SeenSet(spark, _path(spark, "seen"), 1_000_000, 16)
    for i in (0, 1, 1, 2):
        seen.add(docs.where(F.col("doc_id") % 3 == i), "h", f"b{i}")
    return seen.keys().groupBy("batch").agg(F.count("*").alias("new_keys"))


@register(
    f"""WITH {_HASHED}, s AS (SELECT DISTINCT h FROM d WHERE doc_id % 2 = 0), q AS (SELECT DISTINCT md5(text) AS h FROM benchmark UNION SELECT h FROM d WHERE doc_id % 2 = 1)
SELECT (SELECT count(*) FROM q) AS asked, (SELECT count(*) FROM q WHERE h IN (SELECT h FROM s)) AS found, (SELECT count(*) FROM s) AS held, true AS few_false_claims"""
)
def seen_share(spark, sf_dir):
    """U8: keys asked, found and held, and whether the filter claimed at most one in a hundred of the others."""
    seen, docs = _seen(spark, sf_dir)
    asked = docs.where("doc_id % 2 = 1").select("h").unionByName(table(spark, sf_dir, "benchmark").select(F.md5("text").alias("h")))
    of = lambda what: F.max(F.when(F.col("what") == what, F.col("keys")))
    got = seen.share_read(asked, "h").agg(*(of(w).alias(w) for w in ("asked", "claimed", "found", "held")))
    return got.select("asked", "found", "held", ((F.col("claimed") - F.col("found")) * 100 <= F.col("asked")).alias("few_false_claims"))


@register("SELECT count(DISTINCT md5(text)) AS held, count(DISTINCT md5(text)) AS claimed FROM documents")
def sketch_restored(spark, sf_dir):
    """Filters of two halves dumped to files, read back and merged claim every key that was added."""
    keys = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key")).where("key is not null")
    blocks, path = 5000, _path(spark, "filters")
    for i in range(2):
        filled(keys.where(F.col("doc_id") % 2 == i), blocks).write.parquet(f"{path}/half={i}")
    both = merged(spark.read.parquet(path))
    one = filled(keys.select("key").distinct(), blocks)
    # A merged filter is the filter of all keys, bit by bit; so it claims what that one claims.
    same = both.join(one, [c for c in one.columns], "left_semi").select("block")
    asked = keys.select("key").distinct().withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    claimed = asked.join(same, "block", "left_semi").select("key", F.lit(1).alias("claimed"))
    return asked.join(claimed, "key", "left").agg(F.count("*").alias("held"), F.count("claimed").alias("claimed"))


# ---------------------------------------------------------------- image bytes

_FORMS = "f AS (SELECT p_partkey, p_partkey % 9 AS form, 20 + p_partkey % 100 AS w, 20 + p_partkey * 7 % 90 AS h, 3000 + p_partkey % 4000 AS n FROM part)"
_FILE_SIZE = "CASE WHEN form IN (0, 1) THEN (w + 1) * h + 68 WHEN form = 2 THEN ((w + 1) * h + 68) // 2 WHEN form IN (3, 8) THEN n + 37 WHEN form = 4 THEN n + 35 WHEN form = 5 THEN n + 26 WHEN form = 6 THEN 2 * n + 30 ELSE 0 END"


def _hexed(value, bytes_: int, little: bool = False):
    """A number as bytes, in hex."""
    digits = F.lpad(F.hex(value.cast("long")), 2 * bytes_, "0")
    return F.concat(*(F.substring(digits, 2 * i - 1, 2) for i in range(bytes_, 0, -1))) if little else digits


def _image_files(spark, sf_dir):
    """An image file for each part: sound, lying, cut, of a format that isn't kept, huge, or none."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.pmod("p_partkey", F.lit(9)).alias("form"))
    part = part.withColumns({"w": 20 + F.pmod("p_partkey", F.lit(100)), "h": 20 + F.pmod(F.col("p_partkey") * 7, F.lit(90)), "n": 3000 + F.pmod("p_partkey", F.lit(4000))})
    form, w, h, n = (F.col(c) for c in ("form", "w", "h", "n"))
    zeros = lambda count: F.repeat(F.lit("00"), count.cast("int"))

    def chunk(kind: str, body, wrong=None):
        crc = _hexed(F.crc32(F.unhex(F.concat(F.lit(kind), body))), 4)
        return F.concat(_hexed(F.length(body) / 2, 4), F.lit(kind), body, crc if wrong is None else F.when(wrong, F.lit("00" * 4)).otherwise(crc))

    rows = (w + 1) * h
    stored = F.concat(F.lit("780101"), _hexed(rows, 2, True), _hexed(65535 - rows, 2, True), zeros(rows), _hexed(rows % 65521, 2), F.lit("0001"))
    png = F.concat(F.lit("89504E470D0A1A0A"), chunk("49484452", F.concat(_hexed(w, 4), _hexed(h, 4), F.lit("0800000000")), form == 1), chunk("49444154", stored), chunk("49454E44", F.lit("")))
    png = F.when(form == 2, F.substring(png, F.lit(1), (F.floor(F.length(png) / 4) * 2).cast("int"))).otherwise(png)
    side = lambda x: F.when(form == 8, F.lit(60000)).otherwise(x)
    jpeg = F.concat(F.lit("FFD8FFC0001108"), _hexed(side(h), 2), _hexed(side(w), 2), F.lit("03" + "00" * 9 + "FFDA000C" + "00" * 10), zeros(n), F.when(form == 4, F.lit("")).otherwise(F.lit("FFD9")))
    gif = F.concat(F.lit("474946383961"), _hexed(w, 2, True), _hexed(h, 2, True), F.lit("000000" + "2C" + "00" * 9 + "02" + "00" + "3B"), zeros(n))
    webp = F.concat(F.lit("52494646"), _hexed(2 * n + 22, 4, True), F.lit("5745425056503820"), _hexed(2 * n + 10, 4, True), F.lit("1000009D012A"), _hexed(w, 2, True), _hexed(h, 2, True), zeros(2 * n))
    made = F.when(form <= 2, png).when(form.isin(3, 4, 8), jpeg).when(form == 5, gif).when(form == 6, webp)
    return part.select("p_partkey", F.unhex(made).alias("content"))


@register(
    f"""WITH {_FORMS}, s AS (SELECT *, CASE WHEN ({_FILE_SIZE}) < 5000 THEN 8 ELSE 0 END AS small FROM f)
SELECT p_partkey, CASE WHEN form <= 2 THEN 'PNG' WHEN form IN (3, 4, 8) THEN 'JPEG' WHEN form = 5 THEN 'GIF' WHEN form = 6 THEN 'WEBP' END AS format,
    CASE WHEN form = 8 THEN 60000 WHEN form <> 7 THEN w END AS width, CASE WHEN form = 8 THEN 60000 WHEN form <> 7 THEN h END AS height,
    CASE WHEN form = 1 THEN 'corrupt' WHEN form IN (2, 4) THEN 'truncated' WHEN form = 7 THEN 'empty' END AS problem,
    CASE WHEN form IN (1, 2, 4, 7) THEN 9 + small WHEN form = 8 THEN 12 + small WHEN form = 5 THEN 10 + small WHEN small = 8 THEN 16 ELSE 2 END AS status
FROM s"""
)
def image_status(spark, sf_dir):
    """Format, size, fault and status of files, from their bytes."""
    return I.with_status(_image_files(spark, sf_dir)).select("p_partkey", "format", "width", "height", "problem", "status")


# ---------------------------------------------------------------- languages


def _language_sql() -> str:
    """The model counted from its seeds and applied, in SQL."""
    seeds = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in G.SEEDS.items())
    cut = "SELECT {key}, unnest(list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i::INT, 3))) AS g FROM (SELECT {key}, unnest(regexp_extract_all(lower({text}), '\\p{{L}}+')) AS w FROM {table})"
    return f"""WITH seeds(lang, t) AS (VALUES {seeds}), sg AS ({cut.format(key="lang", text="t", table="seeds")}),
n3 AS (SELECT lang, g, count(*) AS n FROM sg GROUP BY ALL), n3p AS (SELECT lang, substr(g, 1, 2) AS g, count(*) AS n FROM sg GROUP BY ALL),
n2 AS (SELECT lang, substr(g, 2, 2) AS g, count(*) AS n FROM sg GROUP BY ALL), n2p AS (SELECT lang, substr(g, 2, 1) AS g, count(*) AS n FROM sg GROUP BY ALL),
n1 AS (SELECT lang, substr(g, 3, 1) AS g, count(*) AS n FROM sg GROUP BY ALL), n0 AS (SELECT lang, count(*) AS n FROM sg GROUP BY ALL),
size AS (SELECT 2 + count(DISTINCT c) AS z FROM (SELECT unnest(string_split(t, '')) AS c FROM (SELECT lower(t) AS t FROM seeds)) WHERE regexp_full_match(c, '\\p{{L}}')),
dg AS (SELECT doc_id, g, count(*) AS times FROM ({cut.format(key="doc_id", text="text", table="documents")}) GROUP BY ALL),
kinds AS (SELECT DISTINCT g, lang FROM dg, n0),
p AS (SELECT k.g, k.lang, n3.n IS NOT NULL AS own,
    (coalesce(n3.n, 0) + {G.LEAN} * (coalesce(n2.n, 0) + {G.LEAN} * (coalesce(n1.n, 0) + {G.SMOOTHING}) / (n0.n + {G.SMOOTHING} * z)) / (coalesce(n2p.n, 0) + {G.LEAN})) / (coalesce(n3p.n, 0) + {G.LEAN}) AS p
    FROM kinds k JOIN n0 USING (lang), size LEFT JOIN n3 ON n3.lang = k.lang AND n3.g = k.g LEFT JOIN n3p ON n3p.lang = k.lang AND n3p.g = substr(k.g, 1, 2)
    LEFT JOIN n2 ON n2.lang = k.lang AND n2.g = substr(k.g, 2, 2) LEFT JOIN n2p ON n2p.lang = k.lang AND n2p.g = substr(k.g, 2, 1) LEFT JOIN n1 ON n1.lang = k.lang AND n1.g = substr(k.g, 3, 1)),
sums AS (SELECT doc_id, lang, sum(times * floor(100 * ln(p) + 0.5)) AS s, sum(times) FILTER (own) AS own, sum(times) AS letters FROM dg JOIN p USING (g) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER w AS place, s - lead(s) OVER w AS ahead FROM sums WINDOW w AS (PARTITION BY doc_id ORDER BY s DESC, lang))
SELECT d.doc_id, CASE WHEN ahead >= {G.MARGIN} AND letters >= {G.LEAST_TRIGRAMS} AND {G.OWN} * coalesce(own, 0) >= letters THEN lang ELSE '' END AS language
FROM (SELECT doc_id FROM documents) d LEFT JOIN ranked r ON r.doc_id = d.doc_id AND place = 1"""


@register(_language_sql())
def language_native(spark, sf_dir):
    """the built-in detector, gated by its reliability."""
    df = table(spark, sf_dir, "documents").select("doc_id", G.native_language("text").alias("d"))
    return df.select("doc_id", X.gated_language("d.language", "d.reliable").alias("language"))


@register("SELECT lang, count(*) AS docs, true AS told FROM documents GROUP BY lang")
def language_held_out(spark, sf_dir):
    """the documents of each language, of which the model saw none, and whether at least 97 of 100 are told, reliably."""
    df = table(spark, sf_dir, "documents").select("lang", G.native_language("text").alias("d"))
    right = F.count_if(F.col("d.reliable") & (F.col("d.language") == F.col("lang")))
    return df.groupBy("lang").agg(F.count("*").alias("docs"), (right * 100 >= F.count("*") * 97).alias("told"))


# ---------------------------------------------------------------- repair


def _evenly(df):
    """A table as it is read, dealt by doc_id if the task with most rows has over twice an even share,
    as of files with few row groups.  Counting reads no column."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return df.repartition(max(cores, df.rdd.getNumPartitions()), "doc_id") if rows and max(rows) * cores > 2 * sum(rows) else df


@register("SELECT doc_id, md5(replace(text, chr(10), ' ')) AS mended, md5('日本 ' || replace(text, chr(10), ' ')) AS mended_twice FROM documents")
def text_mended(spark, sf_dir):
    """all documents read with the wrong encoding once, and twice behind a sound word, are mended."""
    df = _evenly(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumn("text", F.replace("text", F.lit("\n"), F.lit(" ")))

    def misread(c):
        """Bytes as Latin-1 characters, of which Windows-1252 shows some otherwise; ASCII stays."""
        raw = F.translate(F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"), X._CP1252_BYTES, X.CP1252)
        return F.when(F.octet_length(c) == F.length(c), F.col(c)).otherwise(raw)

    # Columns one after the other, so that each is made once.
    df = df.select("doc_id", misread("text").alias("once"))
    df = df.select("doc_id", "once", F.concat(F.lit("日本 "), misread("once")).alias("twice"))
    return df.select("doc_id", F.md5(X.mended("once")).alias("mended"), F.md5(X.mended("twice")).alias("mended_twice"))


# ---------------------------------------------------------------- files


@register("SELECT count(*) AS examples, count(DISTINCT doc_id) AS ids, sum(strlen(text))::BIGINT AS n_bytes FROM documents")
def record_files(spark, sf_dir):
    """K9: documents as examples in record files, and read back: a line of JSON before the text's bytes."""
    spark.dataSource.register(RecordFiles)
    path = _path(spark, "records")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    head = F.to_json(F.struct("doc_id", F.octet_length("text").alias("n")))
    docs.select(F.concat(head, F.lit("\n"), "text").cast("binary").alias("record")).write.format("record_files").mode("append").save(path)
    text = F.col("record").cast("string")
    got = spark.read.format("record_files").load(path).select(F.from_json(F.substring_index(text, "\n", 1), "doc_id long, n long").alias("h"), "record")
    right = F.octet_length("record") == F.col("h.n") + F.octet_length(F.substring_index(text, "\n", 1)) + 1
    return got.where(right).agg(F.count("*").alias("examples"), F.countDistinct("h.doc_id").alias("ids"), F.sum("h.n").alias("n_bytes"))


@register(
    """WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents WHERE text <> '')
SELECT md5(regexp_replace(line, '\\r$', '')) AS line, count(*) AS times FROM l GROUP BY 1"""
)
def byte_ranges(spark, sf_dir):
    """All documents' lines from text files cut in thirteen by byte offset."""
    spark.dataSource.register(ByteRanges)
    path = _path(spark, "lines")
    table(spark, sf_dir, "documents").where("text <> ''").select("text").write.text(path)
    lines = spark.read.format("byte_ranges").option("parts", 13).load(path)
    return lines.groupBy(F.md5("line").alias("line")).agg(F.count("*").alias("times"))


# ---------------------------------------------------------------- fetching


def _slow_fetcher():
    """A fetcher that hangs, fails, redirects and answers, by the address's number."""
    import time

    def get(url: str, connect: float, total: float) -> dict:
        n = int(url.rsplit("/", 1)[1])
        if n % 50 == 0:
            time.sleep(4 * total)
        if n % 7 == 0:
            raise OSError("refused")
        moved = {"url": url + "?moved"} if n % 5 == 0 else {}
        return {**moved, "n_bytes": 4000 + n % 2000, "width": 60000 if n % 11 == 0 else 300, "height": 60000 if n % 11 == 0 else 200, "format": "GIF" if n % 13 == 0 else "WEBP"}

    return get


@register(
    """WITH f AS (SELECT doc_id AS n, 'http://' || source || '.example.org/' || doc_id AS url, CASE WHEN doc_id % 50 = 0 OR doc_id % 7 = 0 THEN 0 WHEN 4000 + doc_id % 2000 < 5000 THEN 8 ELSE 0 END AS small FROM documents)
SELECT n AS sample_id, CASE WHEN n % 50 <> 0 AND n % 7 <> 0 AND n % 5 = 0 THEN url || '?moved' ELSE url END AS url, CASE WHEN n % 50 = 0 THEN 'timeout' WHEN n % 7 = 0 THEN 'error' END AS fault,
    CASE WHEN n % 50 = 0 OR n % 7 = 0 THEN 9 WHEN n % 11 = 0 THEN 12 + small WHEN n % 13 = 0 THEN 10 + small WHEN small = 8 THEN 16 ELSE 2 END AS status FROM f"""
)
def fetch_statuses(spark, sf_dir):
    """An address for each document, fetched by a fetcher that may hang: each ends, with its status."""
    docs = table(spark, sf_dir, "documents")
    url = F.concat(F.lit("http://"), "source", F.lit(".example.org/"), F.col("doc_id").cast("string"))
    asked = docs.select(F.col("doc_id").alias("sample_id"), url.alias("url"), F.lit("").alias("text"), F.lit("?").alias("license"), F.col("lang").alias("language"))
    got = fetch.fetched(asked, _slow_fetcher, connect=1.0, total=2.0, rate=4000.0)
    return got.select("sample_id", "url", "fault", "status")


# ---------------------------------------------------------------- claims


@register("SELECT o_orderkey AS id, 1::BIGINT AS times, o_orderkey * 2 AS result FROM orders")
def claims_once(spark, sf_dir):
    """Two writers claim lots of all orders in turn; one leaves a lot unfinished, which the other takes over and the first then finishes in vain."""
    path = _path(spark, "claims")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    jobs = Claims.create(spark, path, orders, "id", 5)
    work = lambda c: jobs.rows([c]).select("id", (F.col("id") * 2).alias("result"))
    left, now = [], 0.0
    while True:
        got = jobs.claim(("a", "b")[int(now) % 2], now, 3.0)
        if not got and len(jobs.state()[1]) == len(jobs.lots()):
            break
        for c in got:
            if not left:
                left.append(c)
            else:
                jobs.complete(c, work(c))
        now += 1
    jobs.complete(left[0], work(left[0]))
    return jobs.results().groupBy("id").agg(F.count("*").alias("times"), F.max("result").alias("result"))
