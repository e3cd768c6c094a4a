import hashlib
import random

import pytest

from pairloom.llm import fim

from . import oracle


def plain(doc_id, text, seed=fim.SEED):
    """The rules, by Python's code points."""
    t = text or ""
    n = len(t)
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not n or any(s in t for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def texts():
    rng = random.Random(3)
    odd = ["", None, "a", "\x00", "\n", "é‍\U0001f469‍\U0001f4bb", "<P>", "x<S>y", "<M>", "<P", "S>", "中文" * 9, "<" * 50, "<S<S<S", ">M>M<M"]
    made = ["".join(rng.choice("<PSM>a\r\n é中\U0001f600") for _ in range(rng.randrange(40))) for _ in range(600)]
    return odd + made


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x") for i, t in enumerate(texts())] + [(None, "no id", "x"), (3, "twice", None), (3, "twice", None), (-5, "negative", "y")]
    return spark.createDataFrame(rows, "doc_id long, text string, form string")


def test_against_plain_rules(docs):
    want = sorted(((d, *plain(d, t)) for d, t, _ in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in fim.fill_in_middle(docs).collect()), key=repr) == want
    forms = [w[2] for w in want]
    assert min(forms.count(f) for f in ("plain", "psm", "spm")) > 40


def test_digests_are_those_of_output_and_text(docs):
    got = sorted((tuple(r) for r in fim.fill_in_middle(docs, digests=True).collect()), key=repr)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got == sorted(((d, *(p := plain(d, t))[:4], sha(p[4]), sha(t or "")) for d, t, _ in docs.collect()), key=repr)


def test_texts_come_back_from_the_output_alone(spark, docs):
    kept = docs.where("doc_id >= 4 or doc_id < 0")
    back = fim.restore(fim.fill_in_middle(kept))
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((d, t or "") for d, t, _ in kept.collect()), key=repr)
    assert [tuple(r) for r in fim.restore(spark.createDataFrame([(1, "psm", None)], "doc_id long, form string, output string")).collect()] == [(1, None)]


def test_parameters(docs):
    assert {r["form"] for r in fim.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r["form"] for r in fim.fill_in_middle(docs, rate=100, spm=100).collect()} == {"plain", "spm"}
    want = sorted((plain(d, t, 7) for d, t, _ in docs.collect()), key=repr)
    assert sorted((tuple(r)[1:] for r in fim.fill_in_middle(docs, seed=7).collect()), key=repr) == want


def test_a_very_long_text_and_no_rows(spark):
    long = "word é中 " * 400_000
    docs = spark.createDataFrame([(5, long), (6, "short")], "doc_id long, text string")
    assert {tuple(r) for r in fim.fill_in_middle(docs).collect()} == {(5, *plain(5, long)), (6, *plain(6, "short"))}
    assert fim.fill_in_middle(docs.limit(0), digests=True).collect() == []


def test_query(spark, sf):
    assert oracle.same(fim.query(spark, sf), fim.ORACLE_SQL, sf) == 200
