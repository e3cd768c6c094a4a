import os.path
from urllib.parse import urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from pairloom.functions import control as C
from pairloom.functions import image as I  # noqa: E741
from pairloom.functions import text as X
from pairloom.functions import url as U
from pairloom.functions import vector as V


def apply(spark, values, kind, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in df.select("i", *columns).orderBy("i").collect()]


def test_printable_agrees_with_python(spark):
    values = ["a​b c\td e", "plain", "", "\x00\x1f\x7f\x85", " x﻿", "é 日本 🙂", "​", None]
    got = apply(spark, values, "string", X.printable("v"))
    assert got == [None if v is None else "".join(c for c in v if c.isprintable()) for v in values]


def test_clean_cut_and_escape_in_order(spark):
    long = "x" * 1999 + "\\" + "y"
    got = apply(spark, ["a\tb|c\nd", long, "x" * 2001, "\\", None], "string", X.escaped("v"))
    assert got == ["a b c d", "x" * 1999 + "\\\\", "x" * 2000, "\\\\", None]
    assert apply(spark, [" a\nb ", "\n"], "string", X.one_line("v")) == ["a b", ""]
    odd = ["\u00a0 x\u3000\u2003", "\x1c y \x85", "\u200bz"]
    assert apply(spark, odd, "string", X.one_line("v")) == [t.strip() for t in odd]
    assert apply(spark, ["a\nb\\c"], "string", X.escaped_url("v")) == ["ab\\\\c"]


@pytest.mark.parametrize(("text", "want"), [("abcd", False), ("abcde", True), ("", False), (None, False), ("  ab ", False)])
def test_min_length_counts_after_cleaning(spark, text, want):
    assert apply(spark, [text], "string", X.long_enough(X.clean("v"))) == [want]


def test_hash_with_nulls(spark):
    import hashlib

    df = spark.createDataFrame([("u", "té"), ("u", None)], "u string, t string")
    got = df.select(X.pair_hash("u", "t"), X.pair_hash("u", "t", compat=True)).collect()
    assert tuple(got[0]) == (hashlib.md5("uté".encode()).hexdigest(),) * 2
    assert got[1][0] is None and got[1][1] == hashlib.md5(b"unan").hexdigest()


def test_languages(spark):
    assert apply(spark, ["zh-Latn", "en", ""], "string", X.short_language("v")) == ["zh", "en", ""]
    df = spark.createDataFrame([("zh-Latn", True), ("en", False), ("en", None)], "l string, r boolean")
    assert [r[0] for r in df.select(X.gated_language("l", "r")).collect()] == ["zh", "", ""]
    assert apply(spark, ["", " ", None, "fr"], "string", X.language_or_english("v")) == ["en", "en", "en", "fr"]
    got = apply(spark, ["hola", None], "string", X.detected("v", lambda t: ("es-Latn", len(t) > 3)))
    assert [tuple(r) for r in got] == [("es-Latn", True), ("", False)]


def test_repair_is_injected(spark):
    assert apply(spark, [" Ã©a\nb", None], "string", X.repaired("v", lambda t: t.replace("Ã©", "é"))) == ["éa b", None]


def test_numbers_and_records(spark):
    values = ["1", "1.7", "-2e3", "x", "", None, "nan", "inf", " 4 "]
    assert apply(spark, values, "string", X.is_number("v")) == [True, True, True, False, False, False, False, False, True]
    assert apply(spark, values, "string", X.to_long("v"))[:3] == [1, 1, -2000]
    whole = "1\tu\ta\tb\tc\t2\te\tf\n2\tv\tx\ny\tb\tc\t3\te\tg\n"
    (got,) = apply(spark, [whole], "string", X.records("v"))
    assert got == [["1", "u", "a", "b", "c", "2", "e", "f"], ["2", "v", "x\ny", "b", "c", "3", "e", "g"]]
    assert apply(spark, ["a:b", "a:b:c", "a", ":"], "string", X.message("v")["payload"]) == ["b", None, None, ""]
    assert apply(spark, ["a\n|b", "<p>x<br/>y</p> "], "string", X.shard_text_repair("v"), X.without_tags("v"))[0][0] == "a|b"
    assert apply(spark, ["<p>x<br/>y</p> ", "no"], "string", X.without_tags("v")) == ["xy", "no"]
    assert apply(spark, ["teenage", "Teen", None], "string", X.mentions_minor("v")) == [True, False, False]


def test_absolute_addresses(spark):
    good = ["http://a.example/x", "HTTPS://a.example", "ftp://u:p@a.example:21/x?y#z", "http://127.0.0.1/", "http://localhost:8000", "http://[::1]/x", "http://пример.рф/а", "http://a.example."]
    bad = ["", "/x", "//a.example/x", "a.example", "http://", "http:///x", "http://-a.example", "http://a", "http://a b.example", "mailto:a@b.example", "javascript:x", "http://256.1.1.1", None, "http://a.example/x y"]
    assert apply(spark, good, "string", U.is_absolute("v")) == [True] * len(good)
    assert apply(spark, bad, "string", U.is_absolute("v")) == [False] * len(bad)


def test_rejected_substrings(spark):
    values = ["http://gifs.example/a.giftwrap.png", "http://x.example/a.SVG", "data:image/png;x", "http://x.example/a.png"]
    assert apply(spark, values, "string", U.is_media_or_script("v")) == [True, False, True, False]


def test_hosts(spark):
    values = ["http://User:p@A.Example:80/x", "nonsense", None, "http://" + "a" * 60 + "/", "http://" + "a" * 61 + "/"]
    assert apply(spark, values, "string", U.host("v"))[:3] == ["a.example", None, None]
    assert apply(spark, values, "string", U.good_host(U.host("v"))) == [True, False, False, True, False]
    assert apply(spark, values[:1], "string", U.netloc("v")) == ["User:p@A.Example:80"]


def test_resolution_agrees_with_python(spark):
    pages = ["http://a.example/x/y.html", "http://a.example/", "https://a.example/p/q/r/s", "http://a.example:80/p?q/r"]
    links = ["z", "./z", "../z", "../../../z", "/z/../w", "//b.example/z", "http://c.example/k", "z?q=1#f", "a/b/../c/.", "z/", "/", "a/.."]
    rows = [(os.path.dirname(p), u) for p in pages for u in links]
    df = spark.createDataFrame([(i, b, u) for i, (b, u) in enumerate(rows)], "i int, b string, u string")
    got = [r[1] for r in df.select("i", U.resolved("b", "u")).orderBy("i").collect()]
    assert got == [urljoin(b, u) for b, u in rows]
    assert apply(spark, pages, "string", U.dirname("v")) == [os.path.dirname(p) for p in pages]
    hosts = apply(spark, pages, "string", U.host("v"))
    assert hosts == [urlparse(p).hostname for p in pages]


def test_paths(spark):
    assert apply(spark, ["/a/b/c.tar.gz", "x", ""], "string", U.stem("v"), U.component("v", 1)) == [("c", "a"), ("x", None), ("", None)]
    assert apply(spark, ["save/evas/x", "evas"], "string", U.without_prefix("v", "save/")) == ["evas/x", "evas"]
    df = spark.createDataFrame([("/x.mp3",), ("x.mp3",), ("http://b.example/x.mp3",)], "v string")
    got = [r[0] for r in df.select(U.media_url(F.lit("http://b.example"), F.lit("http://b.example/p"), "v")).collect()]
    assert got == ["http://b.example/x.mp3", "http://b.example/p/x.mp3", "http://b.example/x.mp3"]
    assert apply(spark, ["1.22.333.4", "a" * 32 + "x", "y.tar.gz", "other", None], "string", U.is_work_folder("v")) == [True, True, True, False, False]
    assert apply(spark, ["a.mp3", "a.mp3?x", None], "string", U.is_audio("v")) == [True, False, False]


def test_image_status(spark):
    rows = [
        (4999, 100, 100, "JPEG", False, 16),
        (5000, 100, 100, "JPEG", False, 2),
        (9000, 89_478_484, 1, "png", False, 2),
        (9000, 89_478_485, 1, "GIF", False, 12),
        (9000, 10, 10, "GIF", False, 10),
        (9000, None, None, None, True, 9),
        (100, 10, 10, "GIF", False, 18),
        (9000, 10, 10, None, False, 10),
    ]
    df = spark.createDataFrame(rows, "n long, w int, h int, f string, e boolean, want int")
    for r in df.select("want", I.status("n", "w", "h", "f", "e").alias("got")).collect():
        assert r.got == r.want
    bits = df.select(I.error_bits(F.lit(18)).alias("b")).first().b
    assert (bits.error, bits.bad_format, bits.too_big, bits.too_small) == (False, True, False, True)
    sizes = spark.createDataFrame([(448, 225), (224, 900), (100, 50), (301, 301)], "w int, h int")
    got = [tuple(r.c) for r in sizes.select(I.crop("w", "h").alias("c")).collect()]
    assert got == [(446, 224, 111, 0), (224, 900, 0, 338), (100, 50, 0, 0), (224, 224, 0, 0)]


def test_vectors(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])], "a array<float>, b array<float>")
    got = [r[0] for r in df.select(V.cosine("a", "b")).collect()]
    assert got[0] == pytest.approx(0.5**0.5) and got[1] == 0 and got[2] is None
    df = spark.createDataFrame([(0.28, "en"), (0.2799, "en"), (0.26, "intl"), (None, "en")], "s double, r string")
    assert [r[0] for r in df.select(V.similar_enough("s", "r")).collect()] == [True, False, True, False]
    cats = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0])], "idx int, vec array<double>")
    top = V.top_categories(spark.createDataFrame([([2.0, 0.1],)], "v array<float>"), "v", cats).first().top
    assert [t.idx for t in top] == [0, 2]
    p = spark.range(1).select(V.softmax(F.array(F.lit(0.3), F.lit(0.3), F.lit(0.1)))).first()[0]
    assert sum(p) == pytest.approx(1) and p[0] == p[1] > 0.49
    enc = V.encoded(spark.range(5).toDF("sample_id"), ["sample_id"], "sample_id long, n int", lambda: lambda f: f.assign(n=len(f)), batch=2)
    assert max(r.n for r in enc.collect()) <= 2 and enc.count() == 5


@pytest.mark.parametrize(
    ("sim", "main", "ages", "animals", "text", "want"),
    [
        (0.3, [18, 3], [0, 0], [30, 0], "teen", ("UNLIKELY", False)),
        (0.3, [19, 3], [0, 0], [30, 0], "teen", ("UNSURE", False)),
        (0.3, [19, 20], [4, 5], [20, 1], "x", ("NSFW", False)),
        (0.3, [19, 20], [4, 5], [20, 1], "teenage", ("NSFW", True)),
        (0.3, [19, 20], [4, 5], [20, 1], "Teen", ("NSFW", False)),
        (0.3, [19, 20], [3, 5], [20, 1], "x", ("NSFW", True)),
        (0.3, [19, 20], [4, 3], [20, 1], "x", ("NSFW", True)),
        (0.3, [19, 20], [4, 5], [21, 1], "x", ("NSFW", True)),
        (0.27, [0, 1], [4, 5], [0, 1], "x", (None, True)),
        (0.28, [0, 1], [4, 5], [0, 1], "x", ("UNLIKELY", False)),
        (None, [0, 1], [4, 5], [0, 1], None, (None, True)),
    ],
)
def test_safety_tree(spark, sim, main, ages, animals, text, want):
    df = spark.createDataFrame([(sim, main, ages, animals, text)], "s double, m array<int>, g array<int>, a array<int>, t string")
    assert tuple(df.select(V.safety("s", F.lit(0.28), "m", "g", "a", "t").alias("x")).first().x) == want


def test_controllers(spark):
    df = spark.createDataFrame([(75, 60_000), (75, 90_000), (75, 0)], "g int, n int")
    got = df.select(C.group_size("g", "n", F.lit(75)), C.group_size_legacy("g", "n")).collect()
    assert [tuple(r) for r in got] == [(75, 73), (65, 73), (95, 77)]
    df = spark.createDataFrame([(3, 2), (0, 0)], "t long, u long")
    assert [tuple(r) for r in df.select(C.duplication_percent("t", "u"), C.ratio("u", "t"), C.utilization("u", "t")).collect()] == [(33.33, 0.67, 0.67), (0.0, None, None)]


def test_media(spark):
    import numpy as np

    from pairloom.functions import media as A

    assert A.resample(np.arange(10.0), 10, 5).tolist() == [0, 2, 4, 6, 8]
    assert A.resample(np.array([0.0, 2.0]), 1, 2).tolist() == [0, 1, 2, 2]
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0], 40_100), (None, 8000), ([], 8000)], "s array<float>, r int")
    assert [None if r.x is None else list(r.x) for r in df.select(A.resampled("s", "r").alias("x")).collect()] == [[0.0, 2.0], None, []]
    images = spark.createDataFrame([(1, bytearray(b"ab"), 448, 225), (2, bytearray(b"bad"), 300, 300)], "id int, content binary, w int, h int").withColumn("crop", I.crop("w", "h"))

    def codec():
        def work(raw, width, height, left, top):
            if bytes(raw) == b"bad":
                raise ValueError("not an image")
            return f"{width}x{height}+{left}+{top}".encode()

        return work

    got = {r.id: r.pixels and bytes(r.pixels) for r in A.cropped(images, ["id"], codec).collect()}
    assert got == {1: b"446x224+111+0", 2: None}
    assert len(V.category_labels("main")) == 35
