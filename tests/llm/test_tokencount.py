from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from pairloom.llm import tokencount as C
from pairloom.llm.bpe import read_ranks


def totals(df):
    return {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in df.collect()}


def test_query_against_plain_counting(spark, sf):
    enc = {v: tiktoken.Encoding(v, pat_str=P.PATTERN, mergeable_ranks=read_ranks(P.path(f"{v}.tiktoken")), special_tokens={}) for v in ("byte_bpe_50k", "byte_bpe_multi_50k")}
    docs, tokens = Counter(), Counter()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        if len(r.text.split()) >= 50:
            v = "byte_bpe_50k" if r.lang == "en" else "byte_bpe_multi_50k"
            docs[r.source, r.lang, v] += 1
            tokens[r.source, r.lang, v] += len(enc[v].encode_ordinary(r.text))
    assert totals(C.query(spark, sf)) == {k: (n, tokens[k]) for k, n in docs.items()}


def rows(spark, data):
    return spark.createDataFrame(data, "source string, lang string, version string, tokens long, docs string")


def test_batches(spark, tmp_path):
    r = C.Rollup(spark, str(tmp_path / "roll"))
    assert totals(r.totals()) == {}
    a = rows(spark, [("s", "en", "1", 5, "x"), ("s", "en", "1", 7, "x"), (None, None, "1", 1, None)])
    assert r.commit("a", C.inserts(a)) and not r.commit("a", C.inserts(a)) and not C.Rollup(spark, str(tmp_path / "roll")).commit("a", C.inserts(a))
    want = {("s", "en", "1"): (2, 12), (None, None, "1"): (1, 1)}
    assert totals(r.totals()) == want
    r.compact()
    assert totals(r.totals()) == want
    old, new = rows(spark, [("s", "en", "1", 7, "")]), rows(spark, [("s", "en", "2", 6, "")])
    assert r.commit("b", C.revisions(old, new))
    assert r.commit("c", C.deletes(rows(spark, [(None, None, "1", 1, "")])))
    want = {("s", "en", "1"): (1, 5), ("s", "en", "2"): (1, 6)}
    assert totals(r.totals()) == want and r.commit("d", C.inserts(a.limit(0)))
    r.compact()
    assert totals(r.totals()) == want and not r.commit("a", C.inserts(a)) and len(r._parts()[0]) == 1
    for name in ("../x", ".", "..", "", "_x", ".x", "a/b", "-x"):
        with pytest.raises(ValueError):
            r.commit(name, C.inserts(a))


def test_failures_between_steps(spark, tmp_path, monkeypatch):
    """A batch or snapshot without its marker doesn't count, and is written anew."""
    r = C.Rollup(spark, str(tmp_path / "roll"))
    a, b = rows(spark, [("s", "en", "1", 5, "")]), rows(spark, [("s", "en", "1", 9, "")])
    mark = C.Rollup._mark
    with monkeypatch.context() as m:
        m.setattr(C.Rollup, "_mark", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            r.commit("a", C.inserts(b))
        assert totals(r.totals()) == {}
    assert r.commit("a", C.inserts(a)) and totals(r.totals()) == {("s", "en", "1"): (1, 5)}
    with monkeypatch.context() as m:
        m.setattr(C.Rollup, "_mark", lambda self, name: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            r.compact()
    assert totals(r.totals()) == {("s", "en", "1"): (1, 5)}
    assert r.commit("b", C.inserts(b))
    r.compact()
    assert totals(r.totals()) == {("s", "en", "1"): (2, 14)} and C.Rollup._mark is mark


def test_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame([(1, None, None, None, "t"), (1, None, None, None, "t"), (2, "a b", "s", "en", "t"), (None, "", "s", "fr", "t")], "doc_id long, text string, source string, lang string, tokens string")
    one = ("byte_bpe_50k", P.path("byte_bpe_50k.tiktoken"))
    got = C.history(docs, str(tmp_path / "h"), one, ("m", P.path("byte_bpe_multi_50k.tiktoken")), P.PATTERN, F.col("lang").eqNullSafe("fr"), F.lit(False))
    assert totals(got) == {(None, None, "byte_bpe_50k"): (2, 0), ("s", "en", "byte_bpe_50k"): (1, 2), ("s", "fr", "m"): (1, 0)}
    assert C.history(docs.limit(0), str(tmp_path / "e"), one, one, P.PATTERN, F.lit(True), F.lit(True)).count() == 0
