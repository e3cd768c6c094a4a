"""From crawl lines and pages to candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.language import native_language
from ..functions import url as U
from ..schemas import CRAWL
from . import ranges

LICENSE_MARK = "creativecommons.org/licenses/"
UNKNOWN_LICENSE = "?"
#: Attribute values and texts of plain anchors.
ANCHOR = r'(?s)<a href="([^"]*)">([^<]*)</a>'


def crawl_links(lines: DataFrame) -> DataFrame:
    """(wat, line, pos, base, url, alt) of the links of crawl lines (wat, line, value).

    The cheap substring test comes before the JSON parse; only the link array and the
    target address are read of each document.
    """
    parsed = lines.where(F.col("value").contains("IMG@")).select("wat", "line", F.from_json(F.trim("value"), CRAWL).alias("j")).where("j is not null")
    links = F.col("j.Envelope.Payload-Metadata.HTTP-Response-Metadata.HTML-Metadata.Links")
    base = U.dirname(F.col("j.Envelope.WARC-Header-Metadata.WARC-Target-URI"))
    return parsed.select("wat", "line", base.alias("base"), F.posexplode(links).alias("pos", "link")).select("wat", "line", "pos", "base", F.col("link.url").alias("url"), F.col("link.alt").alias("alt"))


def line_shard(lines: DataFrame, shards: int = 2) -> DataFrame:
    """The shard of each line: its file's lines cut in ``shards`` equal runs.  The line
    count of each file is aggregated and joined; no file is sorted."""
    counts = lines.groupBy("wat").agg(F.count("*").alias("__n"))
    return lines.join(counts, "wat").withColumn("shard", F.least(F.floor(F.col("line") * shards / F.col("__n")), F.lit(shards - 1)).cast("int")).drop("__n")


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns but html, pos, href, label) of plain anchors, in order."""
    both = F.arrays_zip(F.regexp_extract_all(html, F.lit(ANCHOR), 1).alias("href"), F.regexp_extract_all(html, F.lit(ANCHOR), 2).alias("label"))
    rest = [c for c in pages.columns if c != html]
    return pages.select(*rest, F.posexplode(both).alias("pos", "x")).select(*rest, "pos", F.col("x.href").alias("href"), F.col("x.label").alias("label"))


def media_links(pages: DataFrame, html: str = "html") -> DataFrame:
    """(page columns but html, pos, url, label) of mp3 addresses in any src or
    href; the label is the text of the smallest enclosing anchor, else empty."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)<a\b[^>]*?\shref\s*=\s*["'][^"']*\.mp3["'][^>]*>(?:(?!</a>).)*</a>|<(?:audio|source)\b[^>]*?\ssrc\s*=\s*["'][^"']*\.mp3["'][^>]*>"""), 0)
    rest = [c for c in pages.columns if c != html]
    link = F.regexp_extract("x", r"""(?is)\s(?:href|src)\s*=\s*["']([^"']*\.mp3)["']""", 1)
    out = pages.select(*rest, F.posexplode(found).alias("pos", "x")).withColumn("label", X.without_tags("x")).withColumn("link", link)
    if "url" in rest:
        base = F.regexp_extract("url", r"^([A-Za-z]+://[^/?#]+)", 1)
        return out.select(*rest, "pos", U.media_url(base, "url", "link").alias("media_url"), "label")
    return out.select(*rest, "pos", F.col("link").alias("media_url"), "label")


def with_license(links: DataFrame, record: list[str], pos: str = "pos", url: str = "url") -> DataFrame:
    """``license``, the last license address at or before each link of its record.

    A record is one page's links, so its window is small.
    """
    cc = F.when(F.col(url).contains(LICENSE_MARK), X.escaped_url(url, 80))
    w = Window.partitionBy(*record).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return links.withColumn("license", F.coalesce(F.last(cc, ignorenulls=True).over(w), F.lit(UNKNOWN_LICENSE)))


def carried(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """W1 in general: the last value that isn't null at or before each row."""
    return ranges.last_before(df, keys, order, value, out, True)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a dear column that later filters read: exploding a one-element array keeps
    them above it, where pushed down each would compute the value again."""
    return df.select(*(c for c in df.columns if c != name), F.explode(F.array(value)).alias(name))


def candidates(links: DataFrame, mode: str = "strict", detector=None, fix=None) -> DataFrame:
    """Links with (base, url, alt, license) to candidates with url, text,
    license, domain, language and hash; other columns stay.

    ``strict`` drops what isn't an absolute address; ``resolve`` first resolves against the
    base, as the older client did.  Filters run from cheap to dear, the detector last.
    ``detector`` and ``fix`` are functions of the caller's; by default the JVM-side ones serve.
    """
    if mode not in ("strict", "resolve"):
        raise ValueError(f"mode is strict or resolve, not {mode!r}")
    df = links.where(F.col("url").isNotNull() & F.col("alt").isNotNull()).withColumn("url", X.escaped_url("url"))
    if mode == "resolve":
        df = once(df, "url", U.resolved("base", "url"))
    df = df.where(~U.is_media_or_script("url")).where(U.is_absolute("url"))
    df = df.withColumn("domain", U.host("url")).where(U.good_host("domain"))
    cleaned = X.printable(X.repaired("alt", fix)) if fix else X.clean(X.mended("alt"))
    df = once(df, "text", cleaned).where(X.long_enough("text"))
    found = native_language("text") if detector is None else X.detected("text", detector)
    df = df.withColumn("__d", found).withColumn("language", X.gated_language("__d.language", "__d.reliable")).drop("__d")
    df = df.withColumn("text", X.escaped("text")).withColumn("hash", X.pair_hash("url", "text"))
    return df.drop("alt", "base")


def only_language(df: DataFrame, language: str = "en", column: str | Column = "language") -> DataFrame:
    """P6."""
    return df.where(X.col(column) == language)
