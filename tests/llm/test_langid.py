import pytest
from pyspark.sql import functions as F

from pairloom.llm import langid as L


def test_held_out_accuracy_of_the_text_alone(spark):
    docs = L.document_evidence(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    model = L.fit(docs.where(part > 0))
    rows = docs.where((part == 0) & (F.length("text") >= 100)).collect()
    right = sum(model.languages[max(range(4), key=model.score(r.text).__getitem__)] == r.declared for r in rows)
    assert len(rows) > 150 and right / len(rows) > 0.95


def test_query(spark, sf):
    truth = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r for r in L.query(spark, sf).collect()}
    assert got.keys() == truth.keys()
    assert all(0 < r.posterior <= 1 for r in got.values())
    assert sum(r.lang == truth[d].lang for d, r in got.items()) / len(got) > 0.95
    assert all(got[r.doc_id].lang == r.lang and got[r.doc_id].posterior == pytest.approx(r.posterior) for r in L.query(spark, sf).collect())


EN, FR = "the thing with this and that which there then", "la chose avec une autre qui leur est dans les"


def rows():
    out = [(i, f"{EN} {i}", "en", f"h{i % 3}.uk", "uk") for i in range(60)]
    out += [(100 + i, f"{FR} {i}", "fr", f"f{i % 3}.fr", "fr") for i in range(60)]
    out += [(200, FR, "en", "h1.uk", "uk"), (201, EN, None, "f1.fr", "fr"), (202, "1234 5678", None, "f1.fr", "fr"), (203, None, None, "h1.uk", "uk"), (204, "", "fr", None, None), (205, "9", None, "new.uk", "uk"), (206, "9", None, "new.fr", "fr"), (207, "9", "fr", "other.xx", "xx")]
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_evidence_is_fused(spark, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr(L, "maybe_broadcast", lambda df: df.hint("merge"))
    df = spark.createDataFrame(rows(), "doc_id long, text string, declared string, host string, suffix string").withColumn("lang", F.lit(3)).withColumn("prior", F.lit("x"))
    got = {r.doc_id: r for r in L.identify(df.repartition(5)).collect()}
    assert len(got) == len(rows())
    assert all(got[i].lang == "en" for i in range(60)) and all(got[100 + i].lang == "fr" for i in range(60))
    # the text alone tells 200; host and suffix decide where the text says nothing
    assert got[200].text_lang == "fr" and got[201].text_lang == "en"
    assert (got[202].lang, got[203].lang, got[204].lang) == ("fr", "en", "fr")
    assert (got[205].lang, got[206].lang, got[207].lang) == ("en", "fr", "fr")


def test_posterior_against_plain_sums(spark):
    """The whole fusion again, in plain Python."""
    import math

    data = rows()
    df = spark.createDataFrame(data, "doc_id long, text string, declared string, host string, suffix string")
    model = L.fit(df)
    n = len(model.languages)
    soft = lambda x: [math.exp(v - max(x)) / sum(math.exp(w - max(x)) for w in x) for v in x]
    text = {d: model.score(t) for d, t, *_ in data}
    p = {d: soft(x) for d, x in text.items()}
    add = lambda chosen: [sum(p[r[0]][i] for r in chosen) for i in range(n)]
    whole = add(data)
    top = [(x + 1) / (sum(whole) + n) for x in whole]
    smooth = lambda c, above: [(c[i] + L.K * above[i]) / (sum(c) + L.K) for i in range(n)]
    # of the host, without the document itself
    sums = add(data)
    said = {r[2] for r in data}
    for r in L.identify(df, model).collect():
        _, _, declared, host, suffix = next(x for x in data if x[0] == r.doc_id)
        above = smooth(add([x for x in data if x[4] == suffix]), top)
        prior = smooth(add([x for x in data if x[3] == host and x[0] != r.doc_id]), above)
        c = add([x for x in data if x[2] == declared])
        log = [text[r.doc_id][i] + math.log(prior[i]) + math.log((c[i] + 0.5) / (sums[i] + 0.5 * len(said))) for i in range(n)]
        assert r.posterior == pytest.approx(max(soft(log))) and r.lang == model.languages[log.index(max(log))]


def test_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = L.page_evidence(pages)
    rows = got.collect()
    assert len(rows) == pages.count() and sum(r.host is not None and r.suffix == r.host.split(".")[-1] for r in rows) > 40
    assert {r.declared for r in rows} & {"en", "fr", "de", "es"}
    assert not any("<p>" in r.text or "track(0)" in r.text for r in rows)
    model = L.fit(L.document_evidence(spark.read.parquet(f"{sf}/documents.parquet")))
    assert L.identify(got, model).count() == len(rows)
    odd = spark.createDataFrame([(1, None, None), (2, "http://1.2.3.4/x", '<HTML class="a" LANG=pt-BR>x'), (3, "nonsense", "<html><p lang='de'>")], "page_id long, url string, html string")
    assert [(r.declared, r.suffix) for r in L.page_evidence(odd).orderBy("doc_id").collect()] == [(None, None), ("pt", None), (None, None)]


def test_no_rows_and_none_declared(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, declared string, host string, suffix string")
    assert L.identify(df.limit(0)).count() == 0
    none = L.identify(df.withColumn("declared", F.lit(None).cast("string"))).collect()
    assert len(none) == len(rows()) and all(r.lang is None for r in none)
    assert L.identify(df.limit(0), L.fit(df)).count() == 0


def test_pages_are_a_registered_query(spark, sf):
    from pairloom.llm import registry

    pages = spark.read.parquet(f"{sf}/pages.parquet")
    evidence = {r.doc_id: r for r in L.page_evidence(pages).collect()}
    got = {r.page_id: r for r in registry.queries()["op7_page_language_id"](spark, sf).collect()}
    assert got.keys() == evidence.keys() and len(got) == pages.count()
    assert all(got[i].declared == r.declared and 0 < got[i].posterior <= 1 for i, r in evidence.items())
    assert any(r.declared for r in got.values()) and any(r.suffix for r in evidence.values())
    docs = L.document_evidence(spark.read.parquet(f"{sf}/documents.parquet"))
    model = L.fit(L.page_evidence(pages).unionByName(docs))
    bare = L.page_evidence(pages).withColumns({c: F.lit(None).cast("string") for c in ("declared", "host", "suffix")})
    without = {r.doc_id: r.posterior for r in L.identify(bare, model).collect()}
    assert any(abs(got[i].posterior - p) > 1e-6 for i, p in without.items())  # the evidence counts


def test_held_out_accuracy_with_the_label_withheld(spark):
    """A quarter of the documents declare nothing; their language is told from text and host."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    hidden = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    evidence = L.document_evidence(docs).withColumn("declared", F.when(~hidden, F.col("declared")))
    truth = {r.doc_id: r.lang for r in docs.where(hidden).collect()}
    got = {r.doc_id: r.lang for r in L.identify(evidence).collect() if r.doc_id in truth}
    assert len(got) == len(truth) > 200
    assert sum(got[d] == t for d, t in truth.items()) / len(truth) > 0.95


def test_more_languages_than_before_and_rare_ones(spark, monkeypatch):
    """Seventy languages of their own words, all fitted; those of few rows are ``other``."""
    words = ["".join(chr(97 + (i * 7 + j * 3 + j * j * (i // 26 + 1)) % 26) for j in range(6)) for i in range(70)]
    data = [(100 * i + j, f"{w} {w[::-1]} {w[1:]}{w[:2]} {w}" * 3, f"l{i:02d}", None, None) for i, w in enumerate(words) for j in range(6)]
    data += [(9000 + i, "qqq zzz qzq zqz " * 4, f"r{i}", None, None) for i in range(4)]
    df = spark.createDataFrame(data, "doc_id long, text string, declared string, host string, suffix string")
    model = L.fit(df)
    assert len(model.languages) == 71 and L.OTHER in model.languages
    got = {r.doc_id: r for r in L.identify(df, model).collect()}
    assert sum(got[d].lang == said for d, _, said, _, _ in data[:420]) / 420 > 0.98
    assert all(got[9000 + i].lang == L.OTHER for i in range(4))
    monkeypatch.setattr(L, "CELLS", 1 << 17)
    few = L.fit(df)
    assert len(few.logs) < L.BUCKETS and len(few.languages) == 71
    got = {r.doc_id: r for r in L.identify(df, few).collect()}
    assert sum(got[d].lang == said for d, _, said, _, _ in data[:420]) / 420 > 0.9


def test_a_very_long_text(spark):
    df = spark.createDataFrame([*rows(), (900, f"{EN} " * 60_000, None, None, None)], "doc_id long, text string, declared string, host string, suffix string")
    assert {r.doc_id: r.lang for r in L.identify(df).collect()}[900] == "en"


def test_evidence_decides_pages(spark):
    """Pages whose text says nothing go by markup, host and suffix."""
    page = '<html lang="{}"><body>{}</body></html>'
    data = [(i, f"http://h{i % 5}.example.uk/{i}", page.format("en", EN)) for i in range(40)] + [(100 + i, f"http://f{i % 5}.example.fr/a|b{i}", page.format("fr", FR)) for i in range(40)]
    data += [(200, "http://new.example.fr/1", "<html>1</html>"), (201, "http://new.example.uk/1", "<html>1</html>"), (202, "http://h1.example.uk/2", "<html>2</html>"), (203, None, page.format("fr", "3"))]
    got = {r.doc_id: r.lang for r in L.identify(L.page_evidence(spark.createDataFrame(data, "page_id long, url string, html string"))).collect()}
    assert [got[i] for i in (200, 201, 202, 203)] == ["fr", "en", "en", "fr"]
