"""The registered queries of the engine's own operators, with their oracle SQL.

Fixture tables stand in for the operators' inputs: anchors of ``pages`` for links,
``documents`` for candidates, ``orders`` for records with a status, ``lineitem`` and
``part`` for image sizes, ``embeddings`` for vectors, ``events`` for logs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import control as C
from .functions import image as I  # noqa: E741
from .functions import text as X
from .functions import url as U
from .functions import vector as V
from .operators import dedup as D
from .operators import links as L
from .operators import metrics as M
from .operators import series as R
from .operators import state as S

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with SQL that gives the same rows."""

    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    from . import catalog_io, catalog_more  # noqa: F401  they register their own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_io, catalog_more  # noqa: F401

    return dict(_SQL)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- links of pages

_ANCHORS = r"""
anchors AS (
    SELECT page_id, url, i - 1 AS pos, h[i] AS href, l[i] AS label
    FROM (SELECT page_id, url, h, l, unnest(range(1, len(h) + 1)) AS i
          FROM (SELECT page_id, url, regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 1) AS h, regexp_extract_all(html, '(?s)<a href="([^"]*)">([^<]*)</a>', 2) AS l FROM pages))
)"""
_RESOLVED = (
    _ANCHORS
    + r""", resolved AS (
    SELECT page_id, pos, label, CASE WHEN href LIKE '/%' THEN regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) || href ELSE href END AS url FROM anchors
), hosts AS (
    SELECT *, lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/@?#]*@)?([^/:?#]*)', 1)) AS host FROM resolved
)"""
)


def _anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.anchors(table(spark, sf_dir, "pages"))


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = L.once(_anchors(spark, sf_dir), "url", U.resolved(U.dirname("url"), "href"))
    return found.withColumn("host", U.host("url"))


@register(f"WITH {_ANCHORS} SELECT page_id, pos::BIGINT AS pos, href, label FROM anchors")
def link_extract(spark, sf_dir):
    """S12."""
    return _anchors(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "href", "label")


@register(f"WITH {_RESOLVED} SELECT page_id, pos::BIGINT AS pos, url, host FROM hosts")
def link_resolve(spark, sf_dir):
    """F4, F5, F6."""
    return _resolved(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "url", "host")


#: Links as the web has them, made of each anchor: schemes, ports, user names, paths with
#: characters that strict parsers refuse, hosts of other scripts and too long ones,
#: relative forms, scripted images, junk.  With each: whether it is absolute, and its host.
_WEB = [
    ("http://Example.com{h}", True, "example.com"),
    ("https://user:pw@img.example.org:8080{h}?q=a|b#top", True, "img.example.org"),
    ("http://example.com/a|b{p}.png", True, "example.com"),
    ("http://example.com/img[{p}].jpg", True, "example.com"),
    ("http://example.com/a%zz{p}.jpg", True, "example.com"),
    ("http://example.com/a{{{p}}}.png", True, "example.com"),
    ("http://example.com/a^b{p}.png", True, "example.com"),
    ("http://example.com/a" + chr(92) + "b{p}.png", True, "example.com"),
    ('http://example.com/a"b{p}.png', True, "example.com"),
    ("http://example.com/a`b{p}.png", True, "example.com"),
    ("http://exämple.com/x{p}.png", True, "exämple.com"),
    ("ftp://files.example.net/{p}.webp", True, "files.example.net"),
    ("http://127.0.0.1:80/{p}", True, "127.0.0.1"),
    ("http://[2001:db8::1]:80/{p}", True, "2001:db8::1"),
    ("http://" + "a" * 50 + "." + "b" * 5 + ".com/{p}", True, "a" * 50 + "." + "b" * 5 + ".com"),
    ("http://" + "a" * 50 + "." + "b" * 6 + ".com/{p}", True, "a" * 50 + "." + "b" * 6 + ".com"),
    ("http://example.com/logo{p}.svg", True, "example.com"),
    ("http://gifts.example.com/x.giftwrap{p}", True, "gifts.example.com"),
    ("data:image/png;base64,{p}", False, None),
    ("javascript:void({p})", False, None),
    ("../up/{p}.png?x=1#y", False, None),
    ("{p}.png", False, None),
    ("//cdn.example.com/{p}.png", False, None),
    ("?only={p}", False, None),
    ("http:///nohost{p}", False, None),
    ("http://-bad.example/{p}", False, "-bad.example"),
    ("mailto:a{p}@example.com", False, None),
]


def _web_parts(i: int) -> list[tuple[str, str | None]]:
    """The text before, between and behind the anchor's address ({h}) and number ({p})."""
    import string

    return [(text, field) for text, field, _, _ in string.Formatter().parse(_WEB[i][0])]


def _web_sql() -> str:
    def one(i: int) -> str:
        pieces = []
        for text, field in _web_parts(i):
            pieces += ["'" + text.replace("'", "''") + "'", {"h": "href", "p": "page_id::VARCHAR", None: "''"}[field]]
        host = "NULL" if _WEB[i][2] is None else f"'{_WEB[i][2]}'"
        return f"SELECT page_id, pos, {i} AS form, {' || '.join(pieces)} AS link, {str(_WEB[i][1]).lower()} AS absolute, {host} AS host FROM anchors"

    return "web AS (" + " UNION ALL ".join(map(one, range(len(_WEB)))) + ")"


def _web(spark: SparkSession, sf_dir: str) -> DataFrame:
    def link(i: int):
        pieces = []
        for text, field in _web_parts(i):
            pieces += [F.lit(text), {"h": F.col("href"), "p": F.col("page_id").cast("string"), None: F.lit("")}[field]]
        return F.struct(F.lit(i).alias("form"), F.concat(*pieces).alias("link"))

    forms = F.array(*map(link, range(len(_WEB))))
    return _anchors(spark, sf_dir).select("page_id", F.col("pos").cast("long").alias("pos"), "label", F.col("url").alias("page"), F.explode(forms).alias("w")).select("page_id", "pos", "label", "page", "w.*")


@register(f"WITH {_ANCHORS}, {_web_sql()} SELECT page_id, pos, form, link, absolute, host FROM web")
def link_web(spark, sf_dir):
    """Which links are absolute, and their hosts."""
    return _web(spark, sf_dir).select("page_id", "pos", "form", "link", U.is_absolute("link").alias("absolute"), U.host("link").alias("host"))


_REJECTS = "contains(link, '.svg') OR contains(link, '.gif') OR contains(link, 'data:image') OR contains(link, 'javascript:')"


@register(f"WITH {_ANCHORS}, {_web_sql()} SELECT form, count(*) AS links, count(*) FILTER ({_REJECTS}) AS rejected, count(*) FILTER (coalesce(length(host) BETWEEN 1 AND 60, false)) AS good_host FROM web GROUP BY form")
def link_reject(spark, sf_dir):
    """P3, P4, by the link's form."""
    df = _web(spark, sf_dir).groupBy("form")
    return df.agg(F.count("*").alias("links"), F.count_if(U.is_media_or_script("link")).alias("rejected"), F.count_if(U.good_host(U.host("link"))).alias("good_host"))


@register(
    f"""WITH {_ANCHORS}, {_web_sql()} SELECT page_id, pos, form, replace(link, chr(92), chr(92) || chr(92)) AS url, host AS domain FROM web JOIN anchors USING (page_id, pos)
WHERE absolute AND NOT ({_REJECTS}) AND length(host) BETWEEN 1 AND 60 AND length(trim(label)) >= 5"""
)
def link_strict(spark, sf_dir):
    """Candidates of links as the web has them, in strict mode."""
    links = _web(spark, sf_dir).select("page_id", "pos", "form", F.col("link").alias("url"), F.col("label").alias("alt"), U.dirname("page").alias("base"))
    return L.candidates(links, "strict").select("page_id", "pos", "form", "url", "domain")


_RELATIVE = """CASE form WHEN 20 THEN origin || regexp_replace(parent, '[^/]+/$', '') || 'up/' || page_id || '.png?x=1#y' WHEN 21 THEN origin || parent || page_id || '.png'
    WHEN 22 THEN scheme || '://cdn.example.com/' || page_id || '.png' WHEN 23 THEN dir || link ELSE link END"""


@register(
    f"""WITH {_ANCHORS}, {_web_sql()}, d AS (SELECT page_id, pos, regexp_replace(regexp_extract(url, '^(.*)/', 1), '/+$', '') AS dir, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) AS origin, regexp_extract(url, '^([A-Za-z]+):', 1) AS scheme FROM anchors),
p AS (SELECT *, CASE WHEN dir = origin THEN '/' ELSE regexp_extract(substr(dir, length(origin) + 1), '^(.*/)', 1) END AS parent FROM d)
SELECT page_id, pos, form, {_RELATIVE} AS resolved FROM web JOIN p USING (page_id, pos) WHERE form <> 24"""
)
def link_relative(spark, sf_dir):
    """relative links against the pages' folders."""
    df = _web(spark, sf_dir).where("form <> 24")
    return L.once(df, "resolved", U.resolved(U.dirname("page"), "link")).select("page_id", "pos", "form", "resolved")


@register(
    f"""WITH {_RESOLVED}, kept AS (
    SELECT page_id, pos, host, url, replace(label, chr(92), chr(92) || chr(92)) AS text FROM hosts
    WHERE NOT (contains(url, '.svg') OR contains(url, '.gif') OR contains(url, 'data:image') OR contains(url, 'javascript:')) AND length(host) BETWEEN 1 AND 60 AND length(trim(label)) >= 5
), firsts AS (
    SELECT *, row_number() OVER (PARTITION BY page_id, url ORDER BY pos) AS n FROM kept
) SELECT host, count(*) AS links, count(DISTINCT md5(url || text)) AS pairs FROM firsts WHERE n = 1 GROUP BY host"""
)
def host_count(spark, sf_dir):
    """The flagship: pages to candidates (S12, F4-F8, P3-P5), first of each page's addresses
    (U1), counted by host."""
    found = _anchors(spark, sf_dir).withColumnsRenamed({"href": "link", "url": "page"})
    found = found.select("page_id", "pos", U.dirname("page").alias("base"), F.col("link").alias("url"), F.col("label").alias("alt"))
    first = D.first_by(L.candidates(found, "resolve"), ["page_id", "url"], ["pos"])
    # One row a (host, pair) first, so that the distinct count is two partial aggregations.
    pairs = first.groupBy(F.col("domain").alias("host"), "hash").agg(F.count("*").alias("n"))
    return pairs.groupBy("host").agg(F.sum("n").alias("links"), F.count("*").alias("pairs"))


# ---------------------------------------------------------------- texts of documents


@register("SELECT doc_id, md5(regexp_replace(regexp_replace(replace(text, chr(10), ' '), '^\\s+|\\s+$', '', 'g'), '[\\x00-\\x1f\\x7f]', '', 'g')) AS cleaned FROM documents")
def text_clean(spark, sf_dir):
    """F1, F2."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(X.clean("text")).alias("cleaned"))


@register("SELECT doc_id, replace(translate(substr(text, 1, 2000), chr(9) || chr(10) || '|', '   '), chr(92), chr(92) || chr(92)) AS escaped FROM documents")
def text_escape_truncate(spark, sf_dir):
    """F7."""
    return table(spark, sf_dir, "documents").select("doc_id", X.escaped("text").alias("escaped"))


@register("SELECT count(*) AS kept FROM documents WHERE length(text) >= 500")
def text_min_len(spark, sf_dir):
    """P5 with a limit that the fixture's texts straddle."""
    return table(spark, sf_dir, "documents").where(X.long_enough("text", 500)).agg(F.count("*").alias("kept"))


_URL = "'http://' || source || '/' || doc_id"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").withColumn("url", F.concat(F.lit("http://"), "source", F.lit("/"), "doc_id"))


@register(f"SELECT doc_id, md5({_URL} || text) AS hash FROM documents")
def pair_hash(spark, sf_dir):
    """F8."""
    return _documents(spark, sf_dir).select("doc_id", X.pair_hash("url", "text").alias("hash"))


@register("SELECT doc_id, regexp_matches(text, 'teen|kid|child|baby') AS minor, contains(text, chr(0)) AS nul FROM documents")
def text_flags(spark, sf_dir):
    """F16, P14."""
    return table(spark, sf_dir, "documents").select("doc_id", X.mentions_minor("text").alias("minor"), X.has_nul("text").alias("nul"))


_LANG = "CASE WHEN n_chars < 400 THEN '' ELSE lang END"
_ROUTE = f"CASE WHEN {_LANG} = '' THEN 'nolang' WHEN {_LANG} = 'en' THEN 'en' ELSE 'intl' END"


def _with_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _documents(spark, sf_dir)
    return df.withColumn("language", F.when(F.col("n_chars") < 400, "").otherwise(F.col("lang")))


@register(f"SELECT source, count(*) FILTER ({_ROUTE} = 'en') AS en, count(*) FILTER ({_ROUTE} = 'intl') AS intl, count(*) FILTER ({_ROUTE} = 'nolang') AS nolang FROM documents GROUP BY source")
def lang_route_counts(spark, sf_dir):
    """P7, D1, A2."""
    return M.language_counts(_with_language(spark, sf_dir), ["source"])


@register(f"SELECT doc_id FROM documents WHERE {_ROUTE} = 'en'")
def lang_split_en(spark, sf_dir):
    """P6, P7."""
    return _with_language(spark, sf_dir).where(S.route("language") == "en").select("doc_id")


@register(f"SELECT doc_id, {_LANG} AS language FROM documents WHERE {_ROUTE} = 'intl'")
def lang_split_intl(spark, sf_dir):
    """P7."""
    return _with_language(spark, sf_dir).where(S.route("language") == "intl").select("doc_id", "language")


@register(f"SELECT doc_id, coalesce(nullif(trim({_LANG}), ''), 'en') AS language FROM documents")
def lang_default(spark, sf_dir):
    """F15."""
    return _with_language(spark, sf_dir).select("doc_id", X.language_or_english("language").alias("language"))


# ---------------------------------------------------------------- dedup and membership


@register("SELECT min(doc_id) AS doc_id, md5(text) AS h FROM documents GROUP BY text")
def dedup_first(spark, sf_dir):
    """U1, U2, U5."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return D.first_by(df, ["h"], ["doc_id"])


@register("SELECT max(doc_id) AS doc_id, md5(text) AS h FROM documents GROUP BY text")
def dedup_last(spark, sf_dir):
    """U3."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return D.last_by(df, ["h"], ["doc_id"])


@register("SELECT DISTINCT md5(text) AS h FROM documents")
def distinct_text(spark, sf_dir):
    """U4."""
    return table(spark, sf_dir, "documents").select(F.md5("text").alias("h")).distinct()


@register("SELECT doc_id, source, 1000 + row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS sampleid FROM documents")
def assign_ids(spark, sf_dir):
    """Within a source, as within a crawl file."""
    df = table(spark, sf_dir, "documents").select("doc_id", "source")
    return D.with_ids(df, ["source"], ["doc_id"], F.lit(1000))


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The fixture's new batch and seen set: odd and even documents, by the digest of their text."""
    df = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"))
    return df.where("doc_id % 2 = 1"), df.where("doc_id % 2 = 0")


_HALVES = "b AS (SELECT doc_id, md5(text) AS h FROM documents WHERE doc_id % 2 = 1), s AS (SELECT DISTINCT md5(text) AS h FROM documents WHERE doc_id % 2 = 0)"


@register(f"WITH {_HALVES} SELECT doc_id FROM b WHERE h NOT IN (SELECT h FROM s)")
def anti_seen(spark, sf_dir):
    """J1-J5."""
    batch, seen = _halves(spark, sf_dir)
    return D.unseen(batch, seen, "h").select("doc_id")


@register(f"WITH {_HALVES} SELECT doc_id FROM b WHERE h IN (SELECT h FROM s)")
def semi_seen(spark, sf_dir):
    """J6, J7."""
    batch, seen = _halves(spark, sf_dir)
    return D.already_seen(batch, seen, "h").select("doc_id")


@register(f"WITH {_HALVES} SELECT count(DISTINCT h) AS new_keys FROM b WHERE h NOT IN (SELECT h FROM s)")
def seen_add_count(spark, sf_dir):
    """U9."""
    batch, seen = _halves(spark, sf_dir)
    return D.new_keys(batch, seen, "h").agg(F.count("*").alias("new_keys"))


@register(f"WITH {_HALVES} SELECT count(*) FILTER (h NOT IN (SELECT h FROM s)) AS kept, count(*) FILTER (h IN (SELECT h FROM s)) AS seen FROM b")
def kept_seen_counts(spark, sf_dir):
    """A3."""
    batch, seen = _halves(spark, sf_dir)
    marked = batch.join(seen.select(F.col("h").alias("s")).distinct(), F.col("h") == F.col("s"), "left")
    return M.kept_and_seen(marked, F.col("s").isNotNull())


@register("SELECT DISTINCT md5(text) AS h FROM documents UNION SELECT DISTINCT md5(text) FROM benchmark")
def seed_keys(spark, sf_dir):
    """The distinct keys of two tables."""
    from .operators.bloom import seeded

    return seeded([table(spark, sf_dir, t).select(F.md5("text").alias("h")) for t in ("documents", "benchmark")], "h")


@register("SELECT source, round((count(*) - count(DISTINCT text)) * 100.0 / count(*), 2)::DOUBLE AS dup_pct, round(count(DISTINCT text)::DOUBLE / count(*), 2) AS kept_ratio FROM documents GROUP BY source")
def dup_pct(spark, sf_dir):
    """A7, A12."""
    df = table(spark, sf_dir, "documents").groupBy("source", F.md5("text").alias("h")).agg(F.count("*").alias("n"))
    both = df.groupBy("source").agg(F.sum("n").alias("total"), F.count("*").alias("unique"))
    return both.select("source", C.duplication_percent("total", "unique").alias("dup_pct"), C.ratio("unique", "total").alias("kept_ratio"))


@register("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'purchase' THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM events")
def carry_forward(spark, sf_dir):
    """W1, F11."""
    df = table(spark, sf_dir, "events").select("event_id", "user_id", F.when(F.col("event_type") == "purchase", F.col("value")).alias("marker"))
    return L.carried(df, ["user_id"], "event_id", "marker", "carried").drop("marker")


# ---------------------------------------------------------------- images (arithmetic only)

_IMAGES = """
images AS (
    SELECT l_orderkey, l_linenumber, (l_quantity * 200)::BIGINT AS n_bytes, (l_partkey * 7 % 12000 + 1)::INT AS width, (l_suppkey * 97 % 9000 + 1)::INT AS height,
        CASE l_linenumber % 4 WHEN 0 THEN 'GIF' WHEN 1 THEN 'jpeg' WHEN 2 THEN 'PNG' ELSE 'WEBP' END AS format, l_returnflag = 'A' AND l_linenumber = 3 AS failed FROM lineitem
)"""


def _images(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("l_linenumber") % 4
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_quantity") * 200).cast("long").alias("n_bytes"),
        (F.col("l_partkey") * 7 % 12000 + 1).cast("int").alias("width"),
        (F.col("l_suppkey") * 97 % 9000 + 1).cast("int").alias("height"),
        F.when(n == 0, "GIF").when(n == 1, "jpeg").when(n == 2, "PNG").otherwise("WEBP").alias("format"),
        ((F.col("l_returnflag") == "A") & (F.col("l_linenumber") == 3)).alias("failed"),
    )


_STATUS = """CASE WHEN n_bytes >= 5000 AND NOT failed AND width::BIGINT * height <= 89478484 AND upper(format) IN ('JPEG', 'JPG', 'PNG', 'WEBP') THEN 2
    ELSE 8 + CASE WHEN n_bytes < 5000 THEN 8 ELSE 0 END + CASE WHEN failed THEN 1 WHEN width::BIGINT * height > 89478484 THEN 4 WHEN upper(format) NOT IN ('JPEG', 'JPG', 'PNG', 'WEBP') THEN 2 ELSE 0 END END"""


@register(f"WITH {_IMAGES} SELECT l_orderkey, l_linenumber, ({_STATUS})::INT AS status FROM images")
def status_code(spark, sf_dir):
    """F9, P8."""
    return _images(spark, sf_dir).select("l_orderkey", "l_linenumber", I.status("n_bytes", "width", "height", "format", "failed").alias("status"))


@register(
    f"""WITH {_IMAGES}, s AS (SELECT ({_STATUS})::INT AS status FROM images)
SELECT status, count(*) AS cnt, status > 8 AND ((status - 8) & 1) > 0 AS error, status > 8 AND ((status - 8) & 2) > 0 AS bad_format, status > 8 AND ((status - 8) & 4) > 0 AS too_big, status > 8 AND ((status - 8) & 8) > 0 AS too_small FROM s GROUP BY status"""
)
def status_decode(spark, sf_dir):
    """the bits."""
    df = _images(spark, sf_dir).groupBy(I.status("n_bytes", "width", "height", "format", "failed").alias("status")).agg(F.count("*").alias("cnt"))
    return df.select("status", "cnt", I.error_bits("status").alias("b")).select("status", "cnt", "b.*")


@register(
    f"""WITH {_IMAGES}, r AS (
    SELECT l_orderkey, l_linenumber, width, height, width > 224 AND height > 224 AS shrink, least(width, height) AS short FROM images
), n AS (
    SELECT l_orderkey, l_linenumber, CASE WHEN shrink THEN round_even(width * 224 / short, 0)::INT ELSE width END AS w, CASE WHEN shrink THEN round_even(height * 224 / short, 0)::INT ELSE height END AS h FROM r
) SELECT l_orderkey, l_linenumber, w AS width, h AS height, greatest(floor((w - 224) / 2), 0)::INT AS "left", greatest(floor((h - 224) / 2), 0)::INT AS top FROM n"""
)
def crop_geometry(spark, sf_dir):
    """F10."""
    return _images(spark, sf_dir).select("l_orderkey", "l_linenumber", I.crop("width", "height").alias("c")).select("l_orderkey", "l_linenumber", "c.*")


# ---------------------------------------------------------------- records with a status

_JOBS = "t AS (SELECT o_orderkey AS id, (CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 2 WHEN 3 THEN 9 ELSE 12 END)::INT AS status, o_custkey AS owner FROM orders)"


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("o_orderkey") % 5
    status = F.when(m == 0, 0).when(m == 1, 1).when(m == 2, 2).when(m == 3, 9).otherwise(12)
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), status.cast("int").alias("status"), F.col("o_custkey").alias("owner"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result for the records whose owner's number ends even: status 2 and a width."""
    df = _records(spark, sf_dir).where("status = 1 and owner % 2 = 0")
    return df.select("id", F.lit(2).alias("status"))


@register(f"WITH {_JOBS} SELECT id, 1 AS status, owner FROM t WHERE status = 0 ORDER BY id LIMIT 100")
def claim_batch(spark, sf_dir):
    """Q1, Q2, O2: a claim takes a bounded batch."""
    return S.claim(_records(spark, sf_dir), "id", 100)


@register(f"WITH {_JOBS}, c AS (SELECT id FROM t WHERE status = 0 ORDER BY id LIMIT 100) SELECT id, CASE WHEN id IN (SELECT id FROM c) THEN 1 ELSE status END AS status, owner FROM t")
def claim_apply(spark, sf_dir):
    """The snapshot after the claim."""
    df = _records(spark, sf_dir)
    return S.apply_claim(df, S.claim(df, "id", 100), "id")


@register(f"WITH {_JOBS} SELECT id, CASE WHEN status = 1 AND owner % 2 = 0 THEN 2 ELSE status END AS status, owner FROM t")
def complete_writeback(spark, sf_dir):
    """D3, J8, Q3."""
    return S.complete(_records(spark, sf_dir), _results(spark, sf_dir), "id", ["status"])


@register(f"WITH {_JOBS} SELECT id, CASE WHEN status = 1 AND owner % 2 <> 0 THEN 9 ELSE status END AS status, owner FROM t")
def orphan_sweep(spark, sf_dir):
    """D4."""
    df = _records(spark, sf_dir)
    return S.sweep(df, df.where("status = 1"), _results(spark, sf_dir), "id")


@register(f"WITH {_JOBS} SELECT 'clipped' AS half, count(*) AS cnt, sum(id)::BIGINT AS ids FROM t WHERE status = 2 UNION ALL SELECT 'rejected', count(*), sum(id)::BIGINT FROM t WHERE status > 8 UNION ALL SELECT 'left', count(*), sum(id)::BIGINT FROM t WHERE status < 2")
def export_split(spark, sf_dir):
    """D5, K3, P9, P16."""
    clipped, rest = S.split(_records(spark, sf_dir), F.col("status") == 2)
    rejected, left = S.split(rest, F.col("status") > 8)
    named = [df.select(F.lit(n).alias("half"), "id") for n, df in (("clipped", clipped), ("rejected", rejected), ("left", left))]
    return D.union_all(*named).groupBy("half").agg(F.count("*").alias("cnt"), F.sum("id").alias("ids"))


@register(f"WITH {_JOBS} SELECT l_orderkey, l_linenumber, status FROM lineitem JOIN t ON id = l_orderkey WHERE status > 1")
def job_archive_join(spark, sf_dir):
    """J9."""
    jobs = _records(spark, sf_dir).select(F.col("id").alias("jobid"), "status")
    files = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("stem"), "l_linenumber")
    return S.job_archives(jobs, files).select(F.col("stem").alias("l_orderkey"), "l_linenumber", "status")


@register(f"WITH {_JOBS} SELECT count(*) FILTER (status = 0) AS pending FROM t")
def pending_count(spark, sf_dir):
    """A1, Q10."""
    return M.pending(_records(spark, sf_dir))


@register(f"WITH {_JOBS} SELECT id, status, owner FROM t WHERE status = 2 ORDER BY id LIMIT 500")
def topk_export(spark, sf_dir):
    """O1: an export batch is a limit in the order of ids."""
    return D.first_rows(_records(spark, sf_dir).where("status = 2"), 500, ["id"])


@register(f"WITH {_JOBS} SELECT id, status, owner FROM t WHERE ('0x' || substr(md5(id::VARCHAR), 1, 12))::BIGINT % 1000000 < 50000")
def hash_sample(spark, sf_dir):
    """O3: a sample of five percent, by hash."""
    return D.hash_sample(_records(spark, sf_dir), "id", 5.0)


@register(
    """SELECT p_partkey, greatest(least(3 * 75 - 5, p_size + 50 - trunc((p_partkey * 613 % 140000 - 60000) / 6000)) - trunc((p_partkey * 613 % 140000 - 60000) / 6000), 3)::INT AS size,
    p_size + 50 + CASE WHEN p_partkey * 613 % 140000 < 7500 THEN 2 WHEN p_partkey * 613 % 140000 > 8500 THEN -2 ELSE 0 END AS legacy FROM part"""
)
def controller_size(spark, sf_dir):
    """Q5, both controllers."""
    df = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_size") + 50).alias("now"), (F.col("p_partkey") * 613 % 140000).alias("results"))
    return df.select("p_partkey", C.group_size("now", "results", F.lit(75)).alias("size"), C.group_size_legacy("now", "results").alias("legacy"))


@register(
    """WITH t AS (SELECT o_orderkey AS id FROM orders WHERE o_orderkey % 3 = 0),
l AS (SELECT l_orderkey AS id, l_linenumber AS line, CASE WHEN l_returnflag = 'N' THEN 'en' WHEN l_returnflag = 'R' THEN '' ELSE 'fr' END AS language FROM lineitem),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY line, language) AS n FROM l)
SELECT id, line, language, CASE language WHEN 'en' THEN 'en' WHEN '' THEN 'nolang' ELSE 'intl' END AS route FROM b WHERE n = 1 AND id NOT IN (SELECT id FROM t)"""
)
def ingest_ignore(spark, sf_dir):
    """An insert that ignores what the table has."""
    there = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("id"))
    flag = F.col("l_returnflag")
    batch = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"), F.col("l_linenumber").alias("line"), F.when(flag == "N", "en").when(flag == "R", "").otherwise("fr").alias("language"))
    good, _ = S.ingest(there, batch, ["language"], "id", ["line"])
    return good.select("id", "line", "language", "route")


# ---------------------------------------------------------------- vectors

_PAIRS = "p AS (SELECT a.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"
_CENTRES = """
centres AS (
    SELECT label AS idx, list(m ORDER BY i) AS vec FROM (SELECT label, i, avg(v) AS m FROM (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY label, i) GROUP BY label
), scores AS (
    SELECT vec_id, idx, round(list_cosine_similarity(embedding::DOUBLE[], vec), 9) AS score FROM embeddings, centres
), ranked AS (
    SELECT vec_id, idx, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, idx) AS n FROM scores
), top AS (
    SELECT vec_id, max(CASE WHEN n = 1 THEN idx END) AS a, max(CASE WHEN n = 2 THEN idx END) AS b FROM ranked WHERE n <= 2 GROUP BY vec_id
)"""


def _neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings")
    after = df.select((F.col("vec_id") - 1).alias("before"), F.col("embedding").alias("next"))
    return df.join(after, F.col("vec_id") == F.col("before")).select("vec_id", "label", V.cosine("embedding", "next").alias("sim"))


def _centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = df.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return means.groupBy(F.col("label").alias("idx")).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda x: x["m"]).alias("vec"))


@register(f"WITH {_PAIRS} SELECT vec_id, round(sim, 6) AS sim FROM p")
def cosine_pairs(spark, sf_dir):
    """M2."""
    return _neighbours(spark, sf_dir).select("vec_id", F.round("sim", 6).alias("sim"))


@register(f"WITH {_PAIRS} SELECT vec_id FROM p WHERE sim >= CASE WHEN vec_id % 2 = 0 THEN 0.28 ELSE 0.26 END")
def sim_threshold(spark, sf_dir):
    """P10."""
    route = F.when(F.col("vec_id") % 2 == 0, "en").otherwise("intl")
    return _neighbours(spark, sf_dir).where(V.similar_enough("sim", route)).select("vec_id")


@register(f"WITH {_CENTRES} SELECT vec_id, a, b FROM top")
def zero_shot_top2(spark, sf_dir):
    """M3, J12, O4."""
    df = V.top_categories(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", _centres(spark, sf_dir))
    return df.select("vec_id", F.col("top")[0]["idx"].alias("a"), F.col("top")[1]["idx"].alias("b"))


@register(
    f"""WITH {_CENTRES}, {_PAIRS}, x AS (SELECT vec_id, sim, a * 4 AS a, b * 4 AS b, a AS age, b AS age2, a * 4 AS thing FROM top JOIN p USING (vec_id))
SELECT vec_id, CASE WHEN sim < 0.26 THEN NULL WHEN a < 19 AND b < 19 THEN 'UNLIKELY' WHEN a >= 19 AND b >= 19 THEN 'NSFW' ELSE 'UNSURE' END AS nsfw,
    sim < 0.26 OR (a >= 19 AND b >= 19 AND (age < 4 OR age2 < 4 OR thing > 20)) AS dropped FROM x"""
)
def safety_tag(spark, sf_dir):
    """M4, with indices spread over the boundaries."""
    top = V.top_categories(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", _centres(spark, sf_dir)).select("vec_id", F.transform("top", lambda t: t["idx"]).alias("i"))
    df = top.join(_neighbours(spark, sf_dir).select("vec_id", "sim"), "vec_id")
    times = lambda k: F.transform("i", lambda x: x * k)
    return df.select("vec_id", V.safety("sim", F.lit(0.26), times(4), F.col("i"), times(4), F.lit("")).alias("s")).select("vec_id", "s.*")


# ---------------------------------------------------------------- reports


@register("SELECT source AS shard, count(*) AS cnt FROM documents GROUP BY source")
def shard_counts(spark, sf_dir):
    """A4, F12."""
    return M.shard_counts(_documents(spark, sf_dir).select(F.concat(F.lit("save/"), "source", F.lit("/"), "doc_id").alias("path")))


@register("SELECT c_custkey, count(o_orderkey) AS cnt FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def count_lookup_zero(spark, sf_dir):
    """J11."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return S.counts_or_zero(table(spark, sf_dir, "customer").select("c_custkey"), orders, "c_custkey")


@register("SELECT count(*) AS total, count(CASE WHEN quality = 1 THEN toxic END) AS with_value FROM labels")
def value_totals(spark, sf_dir):
    """A5, P11."""
    return M.totals(table(spark, sf_dir, "labels").withColumn("similarity", F.when(F.col("quality") == 1, F.col("toxic"))))


_SERIES = ("click", "view", "purchase")
_TYPES = ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in _SERIES)


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("ts", *(F.when(F.col("event_type") == t, 1).otherwise(0).cast("long").alias(t) for t in _SERIES))


def _resample_sql(hours: int) -> str:
    sums = ", ".join(f"coalesce({t}, 0)::BIGINT AS {t}" for t in _SERIES)
    return f"""WITH g AS (SELECT time_bucket(INTERVAL {hours} HOURS, ts, TIMESTAMP '1970-01-01') AS bucket, {_TYPES} FROM events GROUP BY 1),
e AS (SELECT min(bucket) AS lo, max(bucket) AS hi FROM g), every AS (SELECT unnest(generate_series(lo, hi, INTERVAL {hours} HOURS)) AS bucket FROM e)
SELECT strftime(bucket, '%Y-%m-%d %H:%M') AS bucket, {sums} FROM every LEFT JOIN g USING (bucket), e WHERE bucket > lo AND bucket < hi"""


def _resampled(spark: SparkSession, sf_dir: str, hours: int) -> DataFrame:
    df = R.resample(_counts(spark, sf_dir), "ts", list(_SERIES), hours)
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@register(_resample_sql(3))
def resample_3h(spark, sf_dir):
    """A9, O8, S5."""
    return _resampled(spark, sf_dir, 3)


@register(_resample_sql(12))
def resample_12h_dense(spark, sf_dir):
    """A9."""
    return _resampled(spark, sf_dir, 12)


@register(
    "SELECT "
    + ", ".join(
        f"round(count(*) FILTER (event_type = '{t}') * 1e-6, 9) AS {t}_total, round(count(*) FILTER (event_type = '{t}' AND ts > TIMESTAMP '2024-01-30' - INTERVAL 1 DAY) * 1e-6, 9) AS {t}_day, round(count(*) FILTER (event_type = '{t}' AND ts > TIMESTAMP '2024-01-30' - INTERVAL 7 DAYS) * 1e-6, 9) AS {t}_week"
        for t in _SERIES
    )
    + " FROM events"
)
def trailing_sums(spark, sf_dir):
    """A6, W5, P15."""
    df = M.trailing_sums(_counts(spark, sf_dir), "ts", list(_SERIES), F.lit("2024-01-30").cast("timestamp_ntz"))
    return df.select(*(F.round(c, 9).alias(c) for c in df.columns))


@register("SELECT event_id, user_id, event_id - coalesce(lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS delta FROM events")
def lag_delta(spark, sf_dir):
    """A8, W4."""
    return M.deltas(table(spark, sf_dir, "events").select("event_id", "user_id"), ["user_id"], "event_id", "event_id")


@register("SELECT event_type, count(*) AS requests, count(*) FILTER (value > 90) AS exceptions, round(count(*) FILTER (value > 90)::DOUBLE / count(*), 2) * 100 AS rate_percent, round(avg(value), 6) AS mean_s FROM events GROUP BY event_type")
def error_rate(spark, sf_dir):
    """A10."""
    df = M.error_rate(table(spark, sf_dir, "events"), F.col("value") > 90, "value", ["event_type"])
    return df.withColumn("mean_s", F.round("mean_s", 6))


@register("SELECT round(sum(l_quantity) / sum(l_linenumber), 6) AS per_s FROM lineitem")
def throughput(spark, sf_dir):
    """A11."""
    df = M.throughput(table(spark, sf_dir, "lineitem"), "l_quantity", "l_linenumber")
    return df.select(F.round("per_s", 6).alias("per_s"))


@register("SELECT event_type, cnt FROM (SELECT event_type, count(*) AS cnt FROM events GROUP BY event_type) ORDER BY cnt DESC, event_type LIMIT 1")
def upload_mode(spark, sf_dir):
    """A14."""
    return M.most_common(table(spark, sf_dir, "events"), "event_type")


def _unpivoted(hours: int) -> str:
    return f"s AS (UNPIVOT ({_resample_sql(hours)}) ON {', '.join(_SERIES)} INTO NAME series VALUE n)"


def _poly_sql(degree: int) -> str:
    """Least squares by polynomials that are orthogonal over the points, made one by one."""
    steps = []
    for k in range(degree):
        last = f"p{k - 1}" if k else "0.0"
        less = f"- sum(p{k} * p{k}) OVER w / sum({last} * {last}) OVER w * {last}" if k else ""
        steps.append(f"o{k + 1} AS (SELECT *, (x - sum(x * p{k} * p{k}) OVER w / sum(p{k} * p{k}) OVER w) * p{k} {less} AS p{k + 1} FROM o{k} WINDOW w AS (PARTITION BY series))")
    fitted = " + ".join(f"sum(n * p{k}) OVER w / sum(p{k} * p{k}) OVER w * p{k}" for k in range(degree + 1))
    return f"""WITH {_unpivoted(3)}, o0 AS (SELECT series, bucket, n::DOUBLE AS n, 1.0::DOUBLE AS p0,
    (row_number() OVER (PARTITION BY series ORDER BY bucket) - 1)::DOUBLE / (count(*) OVER (PARTITION BY series) - 1) AS x FROM s), {', '.join(steps)}
SELECT series, bucket, round({fitted}, 6) AS fitted FROM o{degree} WINDOW w AS (PARTITION BY series)"""


@register(_poly_sql(5))
def poly_trend(spark, sf_dir):
    """M6: the fitted trend of each series of 3-hour counts."""
    df = R.resample(_counts(spark, sf_dir), "ts", list(_SERIES), 3).unpivot("bucket", list(_SERIES), "series", "n")
    df = R.polynomial(df, ["series"], "bucket", "n").withColumn("fitted", F.round("fitted", 6))
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm"))


@register(
    f"""WITH RECURSIVE {_unpivoted(12)}, y AS (SELECT series, n::DOUBLE AS n, row_number() OVER (PARTITION BY series ORDER BY bucket) AS i, count(*) OVER (PARTITION BY series) AS total FROM s),
h AS (
    SELECT a.series, 1::BIGINT AS i, a.n AS lev, b.n / a.n AS tr, a.total FROM y a JOIN y b ON b.series = a.series AND b.i = 2 WHERE a.i = 1
    UNION ALL
    SELECT h.series, y.i, 0.6::DOUBLE * y.n + 0.4::DOUBLE * h.lev * h.tr, (0.6::DOUBLE * y.n + 0.4::DOUBLE * h.lev * h.tr) / h.lev, h.total FROM h JOIN y ON y.series = h.series AND y.i = h.i + 1
)
SELECT series, step::INT AS step, round(lev * power(tr, step) * 1.1, 6) AS forecast FROM h, (SELECT unnest(range(1, 11)) AS step) WHERE i = total"""
)
def holt_forecast(spark, sf_dir):
    """M7: ten buckets ahead of each 12-hour series."""
    df = R.resample(_counts(spark, sf_dir), "ts", list(_SERIES), 12).unpivot("bucket", list(_SERIES), "series", "n")
    return R.holt(df, ["series"], "bucket", "n", 0.6, 1.0, 10).withColumn("forecast", F.round("forecast", 6))


@register(
    """WITH a AS (SELECT o_orderdate AS d, sum(o_totalprice) AS x FROM orders GROUP BY 1), b AS (SELECT l_shipdate AS d, sum(l_extendedprice) AS y FROM lineitem GROUP BY 1)
SELECT round(sqrt(avg((x - y) * (x - y))), 2) AS rmse FROM a JOIN b USING (d)"""
)
def rmse(spark, sf_dir):
    """A13, J13."""
    a = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("d")).agg(F.sum("o_totalprice").alias("x"))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_shipdate").alias("d")).agg(F.sum("l_extendedprice").alias("y"))
    return R.rmse(a, b, "d", "x", "y")


@register("SELECT o_orderpriority, round(floor(sum(o_totalprice) * 80) / 1e9, 2) AS candidates_billion, round(floor(sum(o_totalprice) * 80) / 1e10, 2) AS kept_billion FROM orders GROUP BY o_orderpriority")
def extrapolate(spark, sf_dir):
    """A15."""
    df = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("x"))
    return df.select("o_orderpriority", R.extrapolated(F.col("x"), F.col("x")).alias("e")).select("o_orderpriority", "e.*")


@register("SELECT event_id, strftime(ts, '%Y-%m-%d') AS padded, year(ts) || '-' || month(ts) || '-' || day(ts) AS plain FROM events")
def date_folders(spark, sf_dir):
    """F13, K12."""
    from .sinks import dated

    return table(spark, sf_dir, "events").select("event_id", dated(F.col("ts"), True).alias("padded"), dated(F.col("ts"), False).alias("plain"))


@register(
    """WITH j AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events) SELECT event_id, k::BIGINT AS k, CASE WHEN k::BIGINT < 50 THEN CASE WHEN regexp_matches(k, '^-?[0-9]') THEN true ELSE false END ELSE true END AS numeric FROM j"""
)
def json_fields(spark, sf_dir):
    """S10, F21, P13, F19."""
    df = table(spark, sf_dir, "events").select("event_id", F.from_json("props", "k string").alias("j")).select("event_id", F.col("j.k").alias("k"))
    return df.select("event_id", X.to_long("k").alias("k"), X.is_number("k").alias("numeric"))
