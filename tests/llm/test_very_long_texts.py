"""Operators whose own tests have no very long text: one of some two million characters."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pairloom.llm import pii, quality, simhash, tokencount

from .test_simhash import plain_fingerprint

TEXT = "".join(f"word{i % 9973} and more\n" for i in range(110_000))


@pytest.fixture(scope="module")
def docs(spark):
    short = " ".join(f"word{i}" for i in range(60))
    return spark.createDataFrame([(1, TEXT, "en", "s", len(TEXT)), (2, short, "en", "s", len(short)), (3, TEXT, "en", "t", len(TEXT))], "doc_id long, text string, lang string, source string, n_chars long")


def test_quality(docs):
    got = {r.doc_id: r for r in quality.quality_rules(docs).collect()}
    lines = TEXT.split("\n")[:-1]
    assert got[1].n_words == 330_000 and got[1].word_chars == sum(map(len, TEXT.split()))
    assert got[1].n_dup_lines == len(lines) - len(set(lines)) and got[1].n_repeat_words == 330_000
    assert got[1].base_failed and got[2].kept


def test_simhash(docs):
    got = {r.doc_id: r for r in simhash.simhash_dedup(docs).collect()}
    assert got[1].fingerprint == f"{plain_fingerprint(TEXT):016x}" and got[3].component_id == 1 and got[2].component_id == 2


def test_surrogates(spark):
    text = TEXT + "write to someone@example.com\n" + TEXT
    (r,) = pii.surrogates(spark.createDataFrame([(1, text)], "doc_id long, text string"), b"k").collect()
    assert r.n_replaced == 1 and len(r.text) == len(text) and "someone@example.com" not in r.text
    assert re.sub(r"write to \S+", "", r.text) == re.sub(r"write to \S+", "", text)


def test_token_counts(docs):
    import public_tokenizers as P
    import tiktoken

    from pairloom.llm.bpe import read_ranks

    path = P.path("byte_bpe_50k.tiktoken")
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(path), special_tokens={})
    got = tokencount.counted(docs, "v", path, P.PATTERN)
    assert {r.doc_id: r.tokens for r in got.where(F.col("doc_id") < 3).collect()}[1] == len(enc.encode_ordinary(TEXT))


def test_pipeline(spark, docs):
    out = docs
    varied = docs.withColumn("text", F.when(F.col("doc_id") != 2, F.array_join(F.transform(F.sequence(F.lit(0), F.lit(200_000)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " ")).otherwise(F.col("text")))
    for _, f in corpus_pipeline.STAGES[:4]:
        out = f(spark, varied, "")
        varied = out
    assert 1 in {r.doc_id for r in out.select("doc_id").collect()}
