import random
import re

import pytest
from pyspark.sql import functions as F

from pairloom.llm import quality as Q

from .oracle import same


def plain(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    hit = {k for i, g in enumerate(grams) if grams.count(g) > 1 for k in (i, i + 1, i + 2)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines), len(lines) - len(set(lines)), len(hit)


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "x x x x x x", "é ß\n\né ß\né ß \n \n", "a\x0bb\x0cc\rd\x85e\xa0f", "#*$ %&|<> 🙂 🙂🙂 \x1c", "a b c d\na b c d\nz " * 40]


def test_counts(spark):
    rnd = random.Random(5)
    texts = TEXTS + ["".join(rnd.choice("ab \n#é") for _ in range(rnd.randrange(300))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string").withColumn("c", Q.counts("text"))
    for r in df.collect():
        c = r.c
        assert (c.n_words, c.word_chars, c.n_symbols, c.lines.n, c.lines.d, c.n_repeat_words) == plain(r.text), r.text


def test_query_equals_sql(spark, sf):
    df = Q.query(spark, sf)
    assert same(df, Q.ORACLE_SQL, sf) == 200


def clean(i):
    return " ".join(f"word{i}x{j}" for j in range(60))


def rows():
    good = [(i, clean(i), "good.example") for i in range(40)]
    minor = [(100 + i, clean(i) + " ###########", h) for i, h in enumerate(["good.example", "bad.example", "bad.example", "bad.example", None])]
    bad = [(200 + i, "too short", "bad.example") for i in range(30)] + [(300, clean(300), "bad.example"), (301, None, None), (301, None, None)]
    return good + minor + bad


@pytest.mark.parametrize("limit", [None, 0])
def test_hosts_decide_about_minor_failures(spark, limit, monkeypatch):
    if limit is not None:  # the way without a broadcast
        monkeypatch.setattr(Q, "maybe_broadcast", lambda df: df.hint("merge"))
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string").withColumn("kept", F.lit("x")).withColumn("n_words", F.lit(None).cast("int"))
    got = {r.doc_id: r for r in Q.quality_rules(df).collect()}
    assert all(got[i].kept for i in range(40)) and got[300].kept and got[300].host_bad
    assert got[100].minor_failed and got[100].kept
    assert not got[101].kept and not got[200].kept and not got[301].kept
    kept = sorted(r.doc_id for r in Q.quality_stage(df).collect())
    assert kept == sorted(i for i, r in got.items() if r.kept)
    assert Q.quality_stage(df).columns == df.columns
    assert Q.quality_rules(df).count() == len(rows())


def test_empty_and_one_sided(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    assert Q.quality_rules(df.limit(0)).count() == 0 and Q.quality_stage(df.limit(0)).count() == 0
    assert all(r.kept for r in Q.quality_rules(df.where("doc_id < 40")).collect())
    assert not any(r.kept for r in Q.quality_rules(df.where("text = 'too short'")).collect())
