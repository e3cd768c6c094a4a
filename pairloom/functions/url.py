"""Address functions (P2-P4, F4-F6, F12, F17, P17, P18), all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: An absolute http, https, ftp or ftps address.
ABSOLUTE = (
    r"(?i)^(?:https?|ftps?)://(?:[^\s:@/]+(?::[^\s:@/]*)?@)?"
    rf"(?:localhost|(?:{_OCTET}\.){{3}}{_OCTET}|\[[0-9a-f:.]+\]"
    r"|(?:[\p{L}\p{N}](?:[\p{L}\p{N}-]{0,61}[\p{L}\p{N}])?\.)+(?:\p{L}{2,63}|xn--[a-z0-9-]{1,59})\.?)"
    r"(?::\d{1,5})?(?:[/?#]\S*)?$"
)
#: Substrings that reject an address, case-sensitive, anywhere.
REJECTED = (".svg", ".gif", "data:image", "javascript:")
MAX_HOST = 60


def is_absolute(c: str | Column) -> Column:
    """P2."""
    return F.coalesce(col(c).rlike(ABSOLUTE) & (F.length(c) <= 2048), F.lit(False))


def is_media_or_script(c: str | Column) -> Column:
    """Svg, gif and scripted images."""
    out = F.lit(False)
    for s in REJECTED:
        out = out | col(c).contains(s)
    return out


def host(c: str | Column) -> Column:
    """lower case, without port, userinfo and an IPv6 address's brackets; null without one.

    Only the authority is looked at: paths on the web hold characters that no strict parser
    takes.
    """
    found = F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.nullif(F.lower(F.btrim(found, F.lit("[]"))), F.lit(""))


def netloc(c: str | Column) -> Column:
    """F6, older form: port and userinfo stay."""
    return F.nullif(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


def good_host(h: str | Column, most: int = MAX_HOST) -> Column:
    """P4."""
    return F.coalesce((F.length(h) > 0) & (F.length(h) <= most), F.lit(False))


def dirname(c: str | Column) -> Column:
    """up to the last slash, without trailing slashes."""
    return F.rtrim(F.regexp_extract(c, "(?s)^(.*)/", 1), F.lit("/"))


def resolved(base: str | Column, c: str | Column) -> Column:
    """``c`` against ``base``; dot segments are removed.

    ``base`` is a dirname without a trailing slash, so for a path-relative address its
    last segment goes as well; a base without a host gives an empty one.
    """
    b, u = col(base), col(c)
    scheme = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    origin = F.when(origin == "", F.concat(scheme, F.lit("://"))).otherwise(origin)
    path = F.regexp_extract(b, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    own = F.regexp_extract(u, r"^([^?#]*)", 1)
    rest = F.substr(u, F.length(own) + 1)
    joined = F.when(u.startswith("/"), own).otherwise(F.concat(F.when(path == "", "/").otherwise(F.regexp_extract(path, "^(.*/)", 1)), own))
    segments = F.split(joined, "/", -1)
    last = F.element_at(segments, -1)
    empty = F.array().cast("array<string>")
    stack = F.aggregate(
        segments,
        empty,
        lambda a, s: F.when(s == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(1)))).when(s == ".", a).otherwise(F.concat(a, F.array(s))),
    )
    plain = F.concat(F.array_join(stack, "/"), F.when(last.isin(".", ".."), "/").otherwise(""))
    plain = F.when(plain.startswith("/"), plain).otherwise(F.concat(F.lit("/"), plain))
    return (
        F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), u)
        .when(u == "", b)
        .when(u.startswith("//"), F.concat(scheme, F.lit(":"), u))
        .when(u.startswith("?") | u.startswith("#"), F.concat(b, u))
        .otherwise(F.concat(origin, plain, rest))
    )


def stem(path: str | Column) -> Column:
    """file name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def component(path: str | Column, i: int) -> Column:
    """the i-th part of a path, from 0; null past its end."""
    return F.get(F.split(path, "/"), F.lit(i))


def without_prefix(path: str | Column, prefix: str) -> Column:
    """a prefix (not a set of characters) taken off."""
    p = col(path)
    return F.when(p.startswith(prefix), F.substr(p, F.lit(len(prefix) + 1))).otherwise(p)


def media_url(base: str | Column, page: str | Column, c: str | Column) -> Column:
    """``/x`` is under the base, other relative addresses under the page."""
    u = col(c)
    return F.when(u.startswith(col(base)), u).when(u.startswith("/"), F.concat(col(base), u)).otherwise(F.concat(col(page), F.lit("/"), u))


def is_audio(c: str | Column) -> Column:
    """P17."""
    return F.coalesce(col(c).endswith(".mp3"), F.lit(False))


def is_work_folder(name: str | Column) -> Column:
    """Four groups of one to three digits, a prefix of 32 hex digits, or an archive."""
    return F.coalesce(col(name).rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$|^[0-9a-f]{32}|tar\.gz"), F.lit(False))
