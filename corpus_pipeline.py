"""A corpus pipeline over ``documents``: quality rules, near-duplicates, personal data,
mixture, token ids.

Each stage works on all that the one before kept and is written as Parquet.  The first
four return the columns of documents; the last returns a row for each row that it gets:
doc_id, source, n_tokens, token_ids, and the digests of ids and decoded bytes.

Odd rows.  Null and empty texts fail the quality rules, so they go in the first stage; a
later stage by itself gives them fingerprint zero, no entities, size 0 and no tokens.  A
null doc_id stays a row, and is kept of a group of copies only where no other is.  A null
source is a host and a source of its own.  Repeated rows count each for their host; the
second stage leaves one of them.  Texts are handled whole, of any length.  Ties go to the
smaller doc_id, then to the first row.  No rows give no rows of the same columns.  Columns
beyond those of documents stay as they are, whatever their names, until the last stage,
which leaves them out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm import bpe, common, mixture, pii, quality, simhash


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.  Null and empty texts go; other columns stay."""
    return quality.quality_stage(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id, of
    repeated rows one.  Texts without words are copies of each other."""
    return simhash.dedup_stage(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by surrogates, with the session's key, else one known to all.  A
    null text stays null, an empty one empty."""
    return pii.surrogate_stage(docs, pii.shown_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.  Texts without words are not taken unless
    all else of their source is taken whole; a null source is a source of its own."""
    return mixture.mix_stage(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the round trip through them.  A null or empty text has no ids; repeated
    rows have equal results."""
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return bpe.encode_checked(docs, ranks, pattern, ["doc_id", "source"])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("encode_tokens", encode_tokens),
]

#: The seeded mixture, SimHash and byte-pair merges have no SQL form; tests hold each
#: stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the documents of ``sf_dir``."""
    docs, since = common.documents(spark, sf_dir), common.mark()
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
        common.discard(spark, since)
    return STAGES[-1][1](spark, docs, sf_dir).select("doc_id", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "ids_sha256", "decoded_sha256")
