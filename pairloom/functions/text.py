"""Text functions (F1-F3, F7, F8, F14-F20, P5, P13, P14): JVM-side expressions; only the optional
repair and language models run in Python, as vectorized functions that the caller gives."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that aren't printable: other (control, format, unassigned), line and
#: paragraph separators, and all spaces but the ASCII one.
UNPRINTABLE = r"[\p{C}\p{Zl}\p{Zp}[\p{Zs}&&[^ ]]]"
#: White space characters.
WHITE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
MAX_TEXT = 2000
MIN_TEXT = 5


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def printable(c: str | Column) -> Column:
    """without the characters that aren't printable."""
    return F.regexp_replace(c, UNPRINTABLE, "")


def stripped(c: str | Column) -> Column:
    """Ends trimmed of white space, as Python's strip does."""
    return F.trim(col(c), F.lit(WHITE))


def one_line(c: str | Column) -> Column:
    """The native part of F2: newlines to spaces, ends trimmed of white space."""
    return stripped(F.translate(c, "\n", " "))


def repaired(c: str | Column, fix: Callable[[str], str]) -> Column:
    """F2 with an injected repair of broken encodings, run on Arrow batches; then ``one_line``."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else fix(t))

    return one_line(run(F.translate(c, "\n", " ")))


#: The characters that Windows-1252 has for the bytes 128 to 159.
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
_CP1252_BYTES = "".join(map(chr, (0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F)))


def _bytes(first: int, last: int) -> str:
    """The characters, in a regular expression's set, that wrongly read bytes become: Latin-1's or Windows-1252's."""
    return f"\\x{{{first:x}}}-\\x{{{last:x}}}" + "".join(c for c, b in zip(CP1252, _CP1252_BYTES, strict=True) if first <= ord(b) <= last)


_REST = f"[{_bytes(0x80, 0xBF)}]"
#: Wrongly read characters beyond ASCII: their first byte's character and those of the others.  What
#: would become a control character (128 to 159) must be one already, as text read twice has them.
_FORMS = (
    ("\u00c2", "[\u0080-\u00bf]"),
    ("[\u00c3-\u00df]", _REST),
    ("\u00e0", f"[{_bytes(0xA0, 0xBF)}]{_REST}"),
    ("[\u00e1-\u00ec\u00ee\u00ef]", f"{_REST}{{2}}"),
    ("\u00ed", f"[{_bytes(0x80, 0x9F)}]{_REST}"),
    ("\u00f0", f"[{_bytes(0x90, 0xBF)}]{_REST}{{2}}"),
    ("[\u00f1-\u00f3]", f"{_REST}{{3}}"),
    ("\u00f4", f"[{_bytes(0x80, 0x8F)}]{_REST}{{2}}"),
)
_SEQUENCE = "|".join(first + others for first, others in _FORMS)
_FIRST = "[\u00c2-\u00f4]"
#: A sequence where a search begins: one test of a character, which most fail, before the forms are tried.
_BEGUN = f"{_FIRST}(?:" + "|".join(f"(?<={first}){others}" for first, others in _FORMS) + ")"
_MORE = f"(?={_FIRST})(?:{_SEQUENCE})++"
#: The byte that those first characters, and few others, begin with in UTF-8.
_FIRST_BYTE = b"\xc3"
#: Marks that a sound text has behind a letter, too.
_MARKS = "[»«”“’‘›‹…–—·•]"
#: Of these, what closes or breaks off: marks that open, and the dash between numbers, don't end a word.
_CLOSING = "[»”’›…—·•]"
#: One such character alone whose further bytes are all marks may be a sound letter and its marks.  After Â and
#: Ã, which hardly end a word, it is so only behind a capital, with a mark that closes and before no letter, and in a
#: text where nothing else is broken: so Ñ, Ó, Ö and Ë that end a word in capitals come back.
_SOUND = f"[\u00c4-\u00df]{_MARKS}|[\u00e0-\u00ef]{_MARKS}{{2}}"
_CAPITALS = f"(?<=[A-Z\u00c0-\u00de][\u00c2\u00c3]{_CLOSING})(?!\\p{{L}})"
#: Runs are possessive: a regular expression that may go back into a run takes stack for each character of it.
BROKEN = f"{_BEGUN}(?:{_MORE}|(?<!{_SOUND})(?!{_CAPITALS}))"
_ALL_BROKEN = f"{_BEGUN}(?:{_MORE}|(?<!{_SOUND}))"
#: Times that a text can have been broken over and over.
ROUNDS = 6
#: A code point that is no character; and another that, like it, keeps a text from being mended.
_MARK, _OTHER = "\ufdd0", "\ufdd1"


def _let(x: Column, f: Callable[[Column], Column]) -> Column:
    """``f(x)`` with ``x`` worked out once, also within a lambda, where common expressions are not shared."""
    return F.get(F.transform(F.array(x), f), F.lit(0))


def _mended_once(c: Column) -> Column:
    # Sound parts and runs in turn.  The runs, which have no newline, are read again in one piece.
    def put_back(parts: Column) -> Column:
        runs = F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "\n")
        again = F.encode(F.translate(runs, CP1252, _CP1252_BYTES), "ISO-8859-1").cast("string")
        chosen = lambda read: F.transform(parts, lambda x, i: F.when(i % 2 == 0, x).otherwise(F.get(read, F.shiftright(i, 1))))
        return _let(F.split(again, "\n", -1), lambda read: F.array_join(chosen(read), ""))

    return _let(F.split(F.regexp_replace(c, _ALL_BROKEN, f"{_MARK}$0{_MARK}"), _MARK, -1), put_back)


def mended(c: str | Column) -> Column:
    """F2's repair without an injected function: UTF-8 that was read as Windows-1252 or Latin-1,
    anywhere in a text and ``ROUNDS`` times over, is read again as UTF-8; the rest stays.

    Runs of wrongly read characters are found by the form of UTF-8, so whatever is
    read again is valid.  A text that has one of the two code points U+FDD0 and U+FDD1, or comes to have
    one, stays as it is then.  Rounds end with the first that finds nothing; a text without the
    first byte of all broken characters is not searched.
    """
    text = col(c)
    # Bytes are searched several times as fast as characters.
    has = lambda x, found: F.contains(x.cast("binary"), F.lit(found))
    due = lambda x: has(x, _FIRST_BYTE) & ~has(x, _MARK.encode()) & ~has(x, _OTHER.encode())
    state = lambda x, more: F.struct(x.alias("text"), F.lit(more).alias("more"))

    def step(acc: Column, _: Column) -> Column:
        x = acc["text"]
        return F.when(acc["more"] & due(x) & x.rlike(BROKEN), state(_mended_once(x), True)).otherwise(state(x, False))

    rounds = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), state(text, True), step, lambda acc: acc["text"])
    return F.when(due(text), rounds).otherwise(text)


def clean(c: str | Column) -> Column:
    """What an alt text goes through before its length is tested."""
    return printable(one_line(c))


def long_enough(c: str | Column, least: int = MIN_TEXT) -> Column:
    """P5: on the cleaned text, before escaping; null and empty are not."""
    return F.coalesce(F.length(c) >= least, F.lit(False))


def escaped(c: str | Column, cut: int = MAX_TEXT) -> Column:
    """cut first, then tab, newline and bar to spaces and backslashes doubled, so the
    result may be longer than the cut."""
    return F.replace(F.translate(F.substring(c, 1, cut), "\t\n|", "   "), F.lit("\\"), F.lit("\\\\"))


def escaped_url(c: str | Column, cut: int = MAX_TEXT) -> Column:
    """F7 for addresses (2000) and licenses (80): cut, newlines out, backslashes doubled."""
    return F.replace(F.replace(F.substring(c, 1, cut), F.lit("\n"), F.lit("")), F.lit("\\"), F.lit("\\\\"))


def pair_hash(url: str | Column, text: str | Column, compat: bool = False) -> Column:
    """F8: md5 of address and text, UTF-8.  ``compat`` hashes a null as 'nan'; else a null gives null."""
    u, t = col(url), col(text)
    if compat:
        u, t = F.coalesce(u, F.lit("nan")), F.coalesce(t, F.lit("nan"))
    return F.md5(F.concat(u, t))


def short_language(c: str | Column) -> Column:
    """without script or region: 'zh-Latn' to 'zh'."""
    return F.substring_index(c, "-", 1)


def gated_language(language: str | Column, reliable: str | Column) -> Column:
    """empty unless the detector calls its answer reliable."""
    return F.when(F.coalesce(col(reliable), F.lit(False)), short_language(language)).otherwise("")


def detected(c: str | Column, detector: Callable[[str], tuple[str, bool]]) -> Column:
    """struct of language and reliable by an injected detector, on Arrow batches."""

    @F.pandas_udf("language string, reliable boolean")
    def run(s: pd.Series) -> pd.DataFrame:
        got = [("", False) if t is None else detector(t) for t in s]
        return pd.DataFrame(got, columns=["language", "reliable"])

    return run(c)


def language_or_english(c: str | Column) -> Column:
    """F15."""
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("en"))


#: Words that tell of minors.
MINORS = ("teen", "kid", "child", "baby")


def mentions_minor(c: str | Column) -> Column:
    """F16: case-sensitive, anywhere."""
    return F.coalesce(col(c).rlike("|".join(MINORS)), F.lit(False))


def is_number(c: str | Column) -> Column:
    """int(float(x)) would succeed."""
    x = col(c).try_cast("double")
    return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))


def to_long(c: str | Column) -> Column:
    """the value that P13 tests, cut to a whole number."""
    return F.when(is_number(c), col(c).try_cast("double").cast("long"))


def has_nul(c: str | Column) -> Column:
    """A line with a NUL byte."""
    return col(c).contains("\0")


def without_newlines(c: str | Column) -> Column:
    """F19."""
    return F.replace(c, F.lit("\n"), F.lit(""))


def records(c: str | Column, fields: int = 8) -> Column:
    """the records of a whole text whose tab-separated fields may hold newlines: array
    of arrays of ``fields`` strings.  A record ends at the last newline before the next
    record's first tab, so its last field may hold newlines, too."""
    pattern = rf"((?:[^\t]*\t){{{fields - 1}}}[^\t]*)(?:\n|\z)"
    return F.transform(F.regexp_extract_all(c, F.lit(pattern), 1), lambda r: F.split(F.rtrim(r, F.lit("\n")), "\t"))


def message(c: str | Column) -> Column:
    """struct of kind and payload; null where there is not exactly one colon."""
    parts = F.split(c, ":", -1)
    return F.when(F.size(parts) == 2, F.struct(parts[0].alias("kind"), parts[1].alias("payload")))


def shard_text_repair(c: str | Column) -> Column:
    """A newline before a bar is part of the field."""
    return F.replace(c, F.lit("\n|"), F.lit("|"))


def without_tags(c: str | Column) -> Column:
    """tags out, ends trimmed."""
    return stripped(F.regexp_replace(c, "<.*?>", ""))
