"""Personal data replaced by keyed surrogates of the same kind and form.

Found: e-mail addresses, phone numbers, payment cards (with a valid check digit), IBANs
(likewise), US social security numbers, IP addresses, secrets (labelled, or with an issuer's
prefix), and names of
persons: after a title, a listed given name before a capitalised word (both in capitals,
too), after words that introduce one ("my name is", "dear", "contact", "signed by", ...), and
before an address in angle brackets.  A name so found in a text is found wherever the text
has it again, as a word with a capital or in capitals.  Numbers that fail their check,
version numbers and bare digits are left alone.

An entity's normal form (digits without separators, lower case, ...) is mapped by a keyed
permutation of all normal forms of its shape, a Feistel network over mixed radices, and
laid out in the surface form found: separators, letter case and length stay, check digits
are made valid again, a given name becomes one of its gender and script, other names keep
script and the pattern of vowels.  So equal entities get equal surrogates in every
document, and different ones different surrogates, without a table.

The collision check covers the corpus: each distinct entity's surrogate is joined with
the entities found and with the other surrogates; where it is a real entity of the corpus
(itself included) or is taken, the entity gets a later attempt's permutation, until none
collides; only where a shape has no form left does an entity keep a colliding one.  Only these exceptions need a table: it is broadcast when it is small, and else
joined to the documents that hold them.

Edge cases: a null text stays null, an empty one empty; repeated rows are replaced alike;
a null doc_id is no obstacle; no rows give no rows; other columns are ignored by
``surrogates`` and kept by the stage; entities of any length are permuted, in blocks of
``WIDE`` characters, each by what came before it.

The key is the caller's: an argument, or the session's ``spark.pairloom.pii.key``.  Who has it can
turn surrogates back.  Only the registered query and the pipeline, which show the
operator, use a key known to all where the session has none.
"""

from __future__ import annotations

import hashlib
import ipaddress
import math
import re
from bisect import bisect
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, maybe_broadcast, slices, small, written

KEY_CONF = "spark.pairloom.pii.key"
ROUNDS = 8
#: Characters of an entity that are permuted as one number.
WIDE = 64
#: Single attempts; what still collides then tries many at once, until none collides or its
#: shape has no form free.
ATTEMPTS = 6
#: Attempts that are tried at once in all, and for one entity at first.
TRIALS = 1 << 20
TRIED = 64

_JUNK = r"[^\w\s]{0,4}"
_LABEL = r"token|secret|(?:api|access|secret|private)[_ -]?key|client[_ -]?secret|(?:auth|access|bearer)[_ -]?token|bearer|password|passwd|pwd"
#: Beginnings that tell issued keys; they stay.
_PREFIX = r"AKIA|ASIA|AIza|gh[pousr]_|github_pat_|glpat-|sk-|[sprk]{2}_(?:live|test)_|xox[abprs]-"
#: In order of precedence.
PATTERNS = [
    ("secret", re.compile(rf"(?<![A-Za-z0-9])(?i:{_LABEL})\b[^\w]{{1,14}}(?:{_PREFIX})?([A-Za-z0-9+/_~-]{{16,256}}={{0,2}})(?![0-9A-Za-z])|(?<![A-Za-z0-9_-])(?:{_PREFIX})([A-Za-z0-9_-]{{16,256}})(?![0-9A-Za-z])")),
    ("email", re.compile(r"(?<![\w.%+-])\w[\w.%+-]*@(?:[^\W_](?:[\w-]*[^\W_])?\.)+[A-Za-z]{2,24}(?![\w@])")),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")),
    ("card", re.compile(r"(?<![\w.-])\d(?:[ -]?\d){12,18}(?![\w-])")),
    ("phone", re.compile("|".join([
        rf"(?<![\w+])(?:\+\d{{1,3}}{_JUNK}[ .-]?)?\(\d{{3}}\){_JUNK} ?\d{{3}}{_JUNK}[ .-]\d{{4}}(?!\w)",
        r"(?<![\w+])\+[1-9](?:[ ./-]?\(?\d|\)[ ./-]?\d){6,14}(?!\w)",  # E.164, in any groups
        r"(?<![\w.+-])(?:1[ .-])?\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
        r"(?<![\w.+-])0\d(?:[ .-]\d{2}){4}(?![\w-])",  # 06 12 34 56 78
        r"(?<![\w.+-])(?<!\d )(?:0\d{1,4}|\(0\d{1,4}\))[ /-] ?(?:\d{5,9}|\d{3,4} \d{3,5})(?![\w-])(?! \d)",  # 030 12345678, 020 7946 0958
    ]))),
    ("ssn", re.compile(r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])")),
    ("ip", re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\.?\w)")),
    ("ipv6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}(?![\w:])")),
]

#: Titles that come before a name, by the gender that they tell.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Mister", "господин", "Господин"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "Госпожа"],
    "": ["Dr", "Prof", "Professor"],
}
#: Given names by gender and script, from which surrogates are chosen.
GIVEN = {
    ("m", "latin"): "James John Robert Michael William David Thomas Charles Daniel Matthew Anthony Mark Steven Andrew Joshua Kevin Brian George Edward Peter Hans Klaus Jürgen Pierre Jacques Luis Carlos Miguel Pablo Javier".split(),
    ("f", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Margaret Sandra Emily Laura Helen Anna Ruth Alice Julia Ursula Monika Sabine Marie Camille Sophie Lucía Carmen Isabel Elena".split(),
    ("m", "cyrillic"): "Иван Пётр Алексей Дмитрий Сергей Николай Михаил Андрей".split(),
    ("f", "cyrillic"): "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана".split(),
}
_GENDER = {n.lower(): k for k, names in GIVEN.items() for n in names}
_TITLED = r"(?:[A-ZÀ-ÖØ-Þ][a-zß-öø-ÿ]+|[А-ЯЁ][а-яё]+)"
_UPPER = r"(?:[A-ZÀ-ÖØ-Þ]{2,}|[А-ЯЁ]{2,})"
_NAME = rf"{_TITLED}(?:[-'’]{_TITLED})?"
_LOUD = rf"{_UPPER}(?:[-'’]{_UPPER})?"
_TITLE = {t: g for g, ts in TITLES.items() for t in ts}
_LISTED = [n for ns in GIVEN.values() for n in ns]
PERSON = re.compile(
    rf"(?=[A-ZÀ-ÖØ-ÞА-ЯЁ{''.join(sorted({t[0] for t in _TITLE if t[0].islower()}))}])(?<!\w)(?:(?:{'|'.join(_TITLE)}|MR|MRS)\.? +(?:({_NAME})(?: +({_NAME}))?|({_LOUD})(?: +({_LOUD}))?)"
    rf"|({'|'.join(_LISTED)}) +({_NAME})|({'|'.join(n.upper() for n in _LISTED)}) +({_LOUD}))(?!\w)"
)
#: Words that introduce a name, of one word or two, and of two only.
ONE_OR_TWO, TWO = ("my name is", "signed by", "yours sincerely,", "kind regards,", "dear"), ("contact", "contact person:", "ask for", "attn", "attn:", "attn.", "author:", "written by")
INTRODUCED = re.compile(rf"(?<!\w)(?:(?i:{'|'.join(map(re.escape, ONE_OR_TWO))})\s+({_NAME})(?: +({_NAME}))?|(?i:{'|'.join(map(re.escape, TWO))})\s+({_NAME}) +({_NAME}))(?!\w)")
#: Words that stand where a name would.
ADDRESSEES = frozenset("sir sirs madam all customer customers friend friends colleague colleagues reader readers team editor everyone god lord diary".split())
#: Before an address in angle brackets.
ADDRESSED = re.compile(rf"(?<!\w)({_NAME}) +({_NAME}) +<(?=[\w.%+-]+@)")
_CAPITALS = re.compile(rf"(?<!\w)(?:{_NAME}|{_LOUD})(?!\w)")

#: Alphabets within which letters are exchanged: vowels apart for names.
_ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ", "абвгдежзийклмнопрстуфхцчшщъыьэюяё", "αβγδεζηθικλμνξοπρστυφχψω"]
_SOUNDS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "àáâãäåæèéêëìíîïòóôõöøùúûüýÿ", "ßçðñþ", "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь"]
_OF = {c: a for a in _ALPHABETS for c in a}
_SOUND_OF = {c: a for a in _SOUNDS for c in a}
_HEX = {c: "0123456789abcdef" for c in "0123456789abcdef"}
#: Secrets beyond hexadecimal ones: their letter case counts.
_CASED = {c: a for a in ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in a}


def permute(key: bytes, tweak: str, values: list[int], radices: list[int]) -> list[int]:
    """A keyed permutation of the mixed-radix numbers with these radices."""
    half = len(values) // 2
    parts, sizes = [], []
    for lo, hi in ((0, half), (half, len(values))):
        v = n = 0
        for x, r in zip(values[lo:hi], radices[lo:hi], strict=True):
            v = v * r + x
            n = (n or 1) * r
        parts.append(v)
        sizes.append(n or 1)
    for i in range(ROUNDS):
        side = 1 - i % 2
        seed = f"{tweak}|{radices}|{i}|{parts[1 - side]:x}".encode()
        parts[side] = (parts[side] + int.from_bytes(hashlib.shake_256(key + b"|" + seed).digest(32 + sizes[side].bit_length() // 8), "big")) % sizes[side]
    out: list[int] = []
    for v, lo, hi in ((parts[0], 0, half), (parts[1], half, len(values))):
        part = []
        for r in reversed(radices[lo:hi]):
            v, x = divmod(v, r)
            part.append(x)
        out += reversed(part)
    return out


def exchange(key: bytes, tweak: str, text: str, of: dict[str, str]) -> str:
    """``text`` with the characters that have an alphabet exchanged within it; the others,
    and the alphabets' order, are the shape."""
    at = [i for i, c in enumerate(text) if c in of]
    if not at:
        return text
    shape = "".join(c if c not in of else of[c][0] for c in text)
    if len(shape) > WIDE:
        shape = hashlib.sha256(shape.encode()).hexdigest()
    out = list(text)
    # Each block by those before it: equal beginnings stay equal, and the whole is a permutation.
    chain = ""
    for b in range(0, len(at), WIDE):
        block = at[b : b + WIDE]
        for i, v in zip(block, permute(key, f"{tweak}|{shape}{chain}", [of[text[i]].index(text[i]) for i in block], [len(of[text[i]]) for i in block]), strict=True):
            out[i] = of[text[i]][v]
        chain = "|" + hashlib.sha256((chain + "".join(out[i] for i in block)).encode()).hexdigest()
    return "".join(out)


_ALL_HEX = re.compile(r"(?i)[0-9a-f]{32,128}")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _is_ipv6(raw: str) -> bool:
    try:
        return any(c in "0123456789" for c in raw) and not ipaddress.IPv6Address(raw).is_loopback
    except ValueError:
        return False


def _matches(kind: str, pattern: re.Pattern, text: str):
    """(start, end) of what may be of this kind.

    A run of digits that is no card is tried at its shorter groups (an expiry date or a
    code may follow the number), then from its second group on.
    """
    if kind != "card":
        for m in pattern.finditer(text):
            yield m.span(m.lastindex if kind == "secret" else 0)
        return
    at = 0
    while m := pattern.search(text, at):
        start, end = m.span()
        gaps = [i for i in range(start, end) if text[i] in " -"]
        found = next((e for e in (end, *reversed(gaps)) if 13 <= len(d := re.sub(r"[ -]", "", text[start:e])) and luhn(d)), None)
        if found:
            yield start, found
        at = found or (gaps[0] if gaps else end)


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, normal form) of each entity, in order, none overlapping."""
    got: list[tuple[int, int, str, str]] = []
    digits = any(d in text for d in "0123456789")
    for kind, pattern in PATTERNS:
        if kind == "email" and "@" not in text or kind != "email" and not digits:
            continue
        for start, end in _matches(kind, pattern, text):
            raw = text[start:end]
            if kind == "email":
                norm = raw.lower()
                if len(norm) != len(raw):
                    continue
            elif kind == "secret":
                norm = raw.lower() if _ALL_HEX.fullmatch(raw) else raw
                # A word or a path is no secret: letters and digits must be mixed.
                if not (any(c.isdigit() for c in raw) and any(c.isalpha() for c in raw)) and not _ALL_HEX.fullmatch(raw):
                    continue
            elif kind == "ipv6":
                norm = raw.lower()
                if not _is_ipv6(raw):
                    continue
            elif kind == "ip":
                norm = raw
            elif kind == "iban":
                norm = raw.replace(" ", "")
                if not 15 <= len(norm) <= 34 or _mod97(norm) != 1:
                    continue
            else:
                norm = re.sub(r"[^0-9]", "", raw)
                if kind == "card" and not (13 <= len(norm) <= 19 and luhn(norm)) or kind == "phone" and not 7 <= len(norm) <= 15:
                    continue
                # The trunk digit stays.
                if kind == "phone" and (len(norm) == 11 and norm[0] == "1" or norm[0] == "0"):
                    norm = norm[1:]
            got.append((start, end, kind, norm))
    low = text.lower()
    patterns = [PERSON, *([INTRODUCED] if any(w in low for w in (*ONE_OR_TWO, *TWO)) else []), *([ADDRESSED] if " <" in text else [])]
    names = {m[i].lower() for pattern in patterns for m in pattern.finditer(text) for i in range(1, pattern.groups + 1) if m[i] and len(m[i].lower()) == len(m[i])} - ADDRESSEES
    for m in _CAPITALS.finditer(text) if names else ():
        word, start = m[0].lower(), m.start()
        # A compound is no name that was found, but its parts may be.
        for part in [word] if word in names else re.split("[-'’]", word):
            if part in names:
                got.append((start, start + len(part), "-".join(("given", *_GENDER[part])) if part in _GENDER else "name", part))
            start += len(part) + 1
    rank = {k: i for i, (k, _) in enumerate(PATTERNS)}
    got.sort(key=lambda e: (rank.get(e[2], 99), e[0]))
    out: list[tuple[int, int, str, str]] = []
    for e in got:
        k = bisect(out, e)
        if (k == 0 or out[k - 1][1] <= e[0]) and (k == len(out) or out[k][0] >= e[1]):
            out.insert(k, e)
    return out


def surrogate(key: bytes, kind: str, norm: str, attempt: int = 0) -> str:
    """The surrogate's normal form."""
    return (_surrogate if len(norm) <= WIDE else _surrogate.__wrapped__)(key, kind, norm, attempt)


@lru_cache(maxsize=100_000)
def _surrogate(key: bytes, kind: str, norm: str, attempt: int) -> str:
    tweak = f"{kind}|{attempt}"
    if kind == "email":
        local, _, domain = norm.rpartition("@")
        host, _, top = domain.rpartition(".")
        return f"{exchange(key, tweak, local, _OF)}@{exchange(key, 'domain', host, _OF)}.{top}"
    if kind == "secret":
        return exchange(key, tweak, norm, _HEX if _ALL_HEX.fullmatch(norm) and norm == norm.lower() else _CASED)
    if kind == "ipv6":
        return exchange(key, tweak, norm, _HEX)
    if kind == "card":
        body = norm[0] + exchange(key, f"{tweak}|{norm[0]}", norm[1:-1], _OF)
        return body + next(d for d in "0123456789" if luhn(body + d))
    if kind == "iban":
        of = {c: a for a in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in a}
        body = exchange(key, f"{tweak}|{norm[:2]}", norm[4:], of)
        return f"{norm[:2]}{98 - _mod97(norm[:2] + '00' + body):02d}{body}"
    if kind == "ip":
        octets = [int(x) for x in norm.split(".")]
        free = [i for i, x in enumerate(octets) if 0 < x < 255]
        for i, v in zip(free, permute(key, f"{tweak}|{[x if i not in free else 1 for i, x in enumerate(octets)]}", [octets[i] - 1 for i in free], [254] * len(free)), strict=True) if free else ():
            octets[i] = v + 1
        return ".".join(map(str, octets))
    if kind == "ssn":
        area, group, serial = int(norm[:3]), int(norm[3:5]), int(norm[5:])
        a, g, s = permute(key, tweak, [area - 1 - (area > 666), group - 1, serial - 1], [898, 99, 9999])
        return f"{a + 1 + (a + 1 >= 666):03d}{g + 1:02d}{s + 1:04d}"
    if kind.startswith("given-"):
        # The next in a keyed order of its gender and script: never itself.
        names = sorted((n.lower() for n in GIVEN[tuple(kind.split("-")[1:])]), key=lambda n: hashlib.blake2b(n.encode(), key=key).digest())
        return names[(names.index(norm) + 1) % len(names)]
    if kind == "name":
        return exchange(key, tweak, norm, _SOUND_OF)
    return exchange(key, tweak, norm, _OF)


def shape_of(kind: str, norm: str) -> tuple[str, int]:
    """The shape of a normal form, whose forms ``surrogate`` permutes, and how many it has."""
    def exchanged(text: str, of: dict[str, str]) -> tuple[str, int]:
        return "".join(of[c][0] if c in of else c for c in text), math.prod(len(of[c]) for c in text if c in of)

    if kind == "email":
        local, _, domain = norm.rpartition("@")
        shape, n = exchanged(local, _OF)
        return f"{shape}@{domain}", n  # the host's permutation has no attempts
    if kind == "secret":
        return exchanged(norm, _HEX if _ALL_HEX.fullmatch(norm) and norm == norm.lower() else _CASED)
    if kind == "ipv6":
        return exchanged(norm, _HEX)
    if kind == "card":
        return f"{norm[0]}{len(norm)}", 10 ** (len(norm) - 2)
    if kind == "iban":
        shape, n = exchanged(norm[4:], {c: a for a in ("0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ") for c in a})
        return norm[:2] + shape, n
    if kind == "ip":
        octets = [x if x in ("0", "255") else "1" for x in norm.split(".")]
        return ".".join(octets), 254 ** octets.count("1")
    if kind == "ssn":
        return "", 898 * 99 * 9999
    return exchanged(norm, _SOUND_OF if kind == "name" else _OF)


def lay_out(raw: str, kind: str, norm: str) -> str:
    """A normal form in the surface form of ``raw``."""
    if kind == "ip":
        return norm
    if kind.startswith("given-"):
        return norm.title() if not raw.isupper() else norm.upper()
    if kind in ("card", "phone", "ssn", "iban"):
        fits = (lambda c: c.isascii() and c.isalnum()) if kind == "iban" else (lambda c: c in "0123456789")
        at = [i for i, c in enumerate(raw) if fits(c)]
        at = at[len(at) - len(norm) :]
        out = list(raw)
        for i, c in zip(at, norm, strict=True):
            out[i] = c
        return "".join(out)
    return "".join(n.upper() if r != r.lower() and len(n.upper()) == 1 else n for r, n in zip(raw, norm, strict=True))


def replace(text: str, key: bytes, fixes: dict[str, int]) -> tuple[str, list[str]]:
    """The text with surrogates, and the kinds replaced, in order.

    ``fixes``: attempts of the entities (kind|normal form) that collided.
    """
    out, at, kinds = [], 0, []
    for start, end, kind, norm in find(text):
        s = surrogate(key, kind, norm, fixes.get(f"{kind}|{norm}", 0) if fixes else 0)
        out += [text[at:start], lay_out(text[start:end], kind, s)]
        at = end
        kinds.append(kind.partition("-")[0])
    return "".join([*out, text[at:]]), kinds


def entities(docs: DataFrame, text: str = "text") -> DataFrame:
    """(kind, norm): the distinct entities of all texts, a written table."""

    def run(batches):
        for b in slices(batches, 1024):
            got = {(k, n) for t in b.column(0).to_pylist() if t for _, _, k, n in find(t)}
            if got:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*got, strict=True)], names=["kind", "norm"])

    return written(docs.select(text).mapInArrow(run, "kind string, norm string").distinct(), "entities")


def exceptions(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, norm, attempt) of the entities whose surrogate of attempt 0 collides with a
    real entity or another surrogate; a written table."""

    def run(batches):
        for b in batches:
            rows = zip(*(c.to_pylist() for c in b.columns), strict=True)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([surrogate(key, k, n, a) for k, n, a in rows], pa.string())], names=["kind", "norm", "attempt", "surrogate"])

    def attempt(df: DataFrame) -> DataFrame:
        return df.mapInArrow(run, "kind string, norm string, attempt int, surrogate string")

    # Given names are a permutation of a list, in which real names can't be avoided.
    found = found.where(~F.col("kind").startswith("given"))
    real = found.select("kind", F.col("norm").alias("surrogate"))
    settled = None  # surrogates that stay
    todo = found.select("kind", "norm", F.lit(0).alias("attempt"))
    for _ in range(ATTEMPTS):
        tried = written(attempt(todo), "tried")
        # Of those with one surrogate the first stays; none stays that is real or taken.
        fine = tried.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).join(real, ["kind", "surrogate"], "left_anti")
        if settled is not None:
            fine = fine.join(settled, ["kind", "surrogate"], "left_anti")
        kept = written(tried.join(fine, ["kind", "surrogate", "norm"], "left_semi"), "settled")
        todo = written(tried.join(kept, ["kind", "norm"], "left_anti").select("kind", "norm", (F.col("attempt") + 1).alias("attempt")), "collided")
        settled = kept if settled is None else settled.union(kept)
        if todo.isEmpty():
            break
    settled, full = _settle(settled, todo, real, attempt)
    # A shape with fewer free forms than entities: the last single attempt stays.
    return written(settled.where("attempt > 0").select("kind", "norm", "attempt").union(full), "exceptions")


def _settle(settled: DataFrame, todo: DataFrame, real: DataFrame, attempt) -> tuple[DataFrame, DataFrame]:
    """``settled`` with what can be settled of ``todo`` (kind, norm, attempt), and the rest:
    entities whose shape has no form left that is neither real nor taken."""

    def run(batches):
        for b in batches:
            got = [shape_of(k, n) for k, n in zip(*(c.to_pylist() for c in b.columns[:2]), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([x for x, _ in got], pa.string()), pa.array([float(n) for _, n in got], pa.float64())], names=["kind", "surrogate", "shape", "forms"])

    def shaped(df: DataFrame) -> DataFrame:
        return df.select("kind", "surrogate").mapInArrow(run, "kind string, surrogate string, shape string, forms double")

    full = todo.limit(0)
    base, tried_each = ATTEMPTS, TRIED
    left = todo.count()
    while left:
        # Entities whose target shape is full keep their last single attempt.
        target = attempt(todo.withColumn("attempt", F.lit(ATTEMPTS - 1)))
        goals = written(target.join(shaped(target).distinct(), ["kind", "surrogate"]), "goals")
        taken = shaped(real.union(settled.select("kind", "surrogate"))).join(maybe_broadcast(goals.select("kind", "shape").distinct()), ["kind", "shape"], "left_semi")
        counts = written(taken.groupBy("kind", "shape").agg(F.count("*").alias("n")), "taken")
        known = goals.join(counts, ["kind", "shape"], "left").withColumn("open", F.coalesce("n", F.lit(0)) < F.col("forms"))
        known = written(known.select("kind", "norm", "attempt", "open"), "known")
        full = full.union(known.where("not open").select("kind", "norm", "attempt"))
        some = known.where("open").select("kind", "norm")
        left = some.count()
        if not left:
            break
        each = max(1, min(tried_each, TRIALS // left))
        trials = some.select("kind", "norm", F.explode(F.sequence(F.lit(base), F.lit(base + each - 1))).alias("attempt"))
        tried = written(attempt(trials.repartition("kind", "norm")), "trials")
        free = tried.join(real, ["kind", "surrogate"], "left_anti").join(settled, ["kind", "surrogate"], "left_anti")
        # A free form goes to its first entity, of its forms an entity takes the first.
        owned = free.groupBy("kind", "surrogate").agg(F.min(F.struct("norm", "attempt")).alias("x")).select("kind", "surrogate", "x.norm", "x.attempt")
        first = owned.groupBy("kind", "norm").agg(F.min(F.struct("attempt", "surrogate")).alias("x"))
        kept = written(first.select("kind", "norm", "x.attempt", "x.surrogate"), "settled")
        settled = settled.select("kind", "norm", "attempt", "surrogate").union(kept)
        todo = written(some.join(kept, ["kind", "norm"], "left_anti"), "collided")
        left = todo.count()
        base, tried_each = base + each, 2 * tried_each
    return settled, full


def session_key(spark: SparkSession, known: bytes | None = None) -> bytes:
    """The key that the session is given, else ``known``; without either, an error."""
    found = spark.conf.get(KEY_CONF, None)
    if not found and not known:
        raise ValueError(f"pass a key or set {KEY_CONF}")
    return found.encode() if found else known


def shown_key(spark: SparkSession) -> bytes:
    """For the registered query and the pipeline: the session's key, else one known to all."""
    return session_key(spark, b"pairloom demonstration key")


def with_surrogates(docs: DataFrame, text: str = "text", key: bytes | None = None, kinds: str = "__pl_kinds", limit: int = 100_000) -> DataFrame:
    """``docs`` with the texts replaced and ``kinds``, the kinds replaced in each.

    ``key``: by default the session's.
    """
    spark = docs.sparkSession
    key = key or session_key(spark)
    fixes = exceptions(entities(docs, text), key)
    at = docs.columns.index(text)
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(kinds, T.ArrayType(T.StringType()))])

    def run(of):
        def go(batches):
            for b in slices(batches, 512):
                got = [(None, None) if t is None else replace(t, key, f) for t, f in zip(b.column(at).to_pylist(), of(b), strict=True)]
                columns = list(b.columns[: len(names)])
                columns[at] = pa.array([t for t, _ in got], pa.string())
                yield pa.RecordBatch.from_arrays([*columns, pa.array([k for _, k in got], pa.list_(pa.string()))], names=[*names, kinds])

        return go

    if small(fixes, limit):
        table = spark.sparkContext.broadcast({f"{r.kind}|{r.norm}": r.attempt for r in fixes.collect()})
        return docs.mapInArrow(run(lambda b: [table.value] * b.num_rows), schema)

    # Each text's exceptions come by a join on the text's digest.
    digest = F.sha2(F.col(text), 256)

    def occurrences(batches):
        for b in slices(batches, 1024):
            rows = {(d, k, n) for t, d in zip(*(c.to_pylist() for c in b.columns), strict=True) if t for _, _, k, n in find(t)}
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()) for x in zip(*rows, strict=True)], names=["digest", "kind", "norm"])

    seen = docs.select(text, digest.alias("digest")).mapInArrow(occurrences, "digest string, kind string, norm string").distinct()
    by_text = seen.join(fixes, ["kind", "norm"]).groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "norm"), "attempt"))).alias("__pl_fixes"))
    by_text = written(by_text.withColumnRenamed("digest", "__pl_digest"), "fixes")
    joined = docs.join(by_text, digest == F.col("__pl_digest"), "left").select(*docs.columns, "__pl_fixes")
    return joined.mapInArrow(run(lambda b: [dict(x or ()) for x in b.column(len(names)).to_pylist()]), schema)


def surrogates(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """doc_id, text with surrogates, n_replaced and kinds (those replaced, in order)."""
    got = with_surrogates(docs.select("doc_id", "text"), key=key)
    return got.select("doc_id", "text", F.coalesce(F.size("__pl_kinds"), F.lit(0)).alias("n_replaced"), F.col("__pl_kinds").alias("kinds"))


def surrogate_stage(docs: DataFrame, key: bytes | None = None) -> DataFrame:
    """``docs`` with the texts replaced; a column n_chars follows its text."""
    names = {c.lower(): c for c in docs.columns}
    got = with_surrogates(docs, names["text"], key)
    if "n_chars" in names:
        same = F.length(names["text"])
        got = got.withColumn(names["n_chars"], F.when(F.size("__pl_kinds") > 0, same).otherwise(F.col(names["n_chars"])).cast(docs.schema[names["n_chars"]].dataType))
    return got.select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates(documents(spark, sf_dir), shown_key(spark))
