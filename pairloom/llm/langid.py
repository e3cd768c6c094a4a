"""Language identification by fusing evidence.

For each document and language the log posterior adds up
  - the text: a naive Bayes model of hashed letter trigrams of the whole text, tempered
    (neighbouring trigrams aren't independent);
  - the declared language (of the markup, or a metadata column): how often documents of
    each language declare it, estimated from all documents;
  - the address: a prior of the host, smoothed toward its address suffix, which is
    smoothed toward all documents (K pseudo-documents at each level).
The estimates come from grouped aggregations of the text-only posteriors over all
documents, so neither declarations nor hosts are trusted beyond what texts bear out.  A
document's own text doesn't count for its host's prior.

The trigram model is fitted on a bounded sample of declared rows: an expected ``SAMPLE``
a language, drawn by a hash of doc_id; all else covers all rows.  Every language is
fitted that has ``LEAST`` declared rows and one in ``SHARE`` of them, so there are at
most ``SHARE``; what is rarer is fitted together as ``OTHER``.  The model has at most
``CELLS`` counts: the more languages, the fewer buckets of trigrams.  Host priors are
broadcast when they are few and else joined by shuffle.

Edge cases: a text without letters leaves the decision to the other evidence; a null
host, suffix or declaration is a value of its own with what its documents bear out; ties
go to the first language in order; repeated rows get equal results; no declared row at
all, or no rows: lang null; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.url import host
from .common import documents, maybe_broadcast, slices, written

SAMPLE = 3000
LEAST = 5
SHARE = 10_000
OTHER = "other"
BUCKETS, LEAST_BUCKETS = 1 << 14, 1 << 10
CELLS = 1 << 24
TEMPER = 0.1
K = 20.0
SEED = 7
MIN_POSTERIOR = 0.5


def buckets_of(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket of each letter trigram of the text in lower case, other characters as
    one space."""
    if not text:
        return np.zeros(0, np.int64)
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (c >= 97) & (c <= 122) | (c >= 0xC0) & (c != 0xD7) & (c != 0xF7)
    c = np.where(letter, c, np.uint32(32))
    keep = np.append(True, (c[1:] != 32) | (c[:-1] != 32))
    c = c[keep].astype(np.uint64)
    if len(c) < 3 or not letter.any():
        return np.zeros(0, np.int64)
    h = c[:-2] * np.uint64(0x9E3779B1) + c[1:-1] * np.uint64(0x85EBCA77) + c[2:] * np.uint64(0xC2B2AE3D)
    return ((h ^ (h >> np.uint64(15))) & np.uint64(buckets - 1)).astype(np.int64)


def markup_language(html: str | Column) -> Column:
    """The language that a page's html element declares, lower case, without region; null
    where there is none."""
    found = F.regexp_extract(html, r"(?is)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.lower(F.nullif(found, F.lit("")))


def suffix_of(host: Column) -> Column:
    """The last label of a host; null for one without a dot or an address of digits."""
    last = F.substring_index(host, ".", -1)
    return F.when(host.contains(".") & ~last.rlike(r"^\d*$"), F.lower(last))


class TextModel:
    """Log probabilities of the buckets by language."""

    def __init__(self, languages: list[str], logs: np.ndarray):
        self.languages, self.logs = languages, logs

    def score(self, text: str | None) -> list[float]:
        b = buckets_of(text, len(self.logs))
        total = np.zeros(len(self.languages))
        for i in range(0, len(b), 1 << 16):
            total += self.logs[b[i : i + (1 << 16)]].sum(axis=0)
        return (TEMPER * (total - total.max())).tolist() if len(total) else []


def fit(rows: DataFrame) -> TextModel:
    """From ``rows`` (doc_id, text, declared), those declared."""
    by_language = written(rows.where("declared is not null").groupBy("declared").agg(F.count("*").alias("n")), "declared")
    total = by_language.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") >= max(LEAST, total / SHARE)
    counts = {r.declared: r.n for r in by_language.where(often).collect()}  # at most SHARE
    rare = by_language.where(~often).agg(F.sum("n")).first()[0] or 0
    if rare:
        counts[OTHER] = counts.get(OTHER, 0) + rare
    languages = sorted(counts)
    if not languages:
        return TextModel([], np.zeros((BUCKETS, 0)))
    n_buckets = BUCKETS
    while n_buckets > LEAST_BUCKETS and n_buckets * len(languages) > CELLS:
        n_buckets //= 2
    share = F.create_map(*(F.lit(x) for d, n in counts.items() for x in (d, min(1.0, SAMPLE / n))))
    if rare:
        named = F.create_map(*(F.lit(x) for d in languages for x in (d, d)))
        rows = rows.withColumn("declared", F.when(F.col("declared").isNotNull(), F.coalesce(F.try_element_at(named, F.col("declared")), F.lit(OTHER))))
    # Rows without an id are told apart by their texts; of one id and text repeated, all are drawn or none.
    at = F.xxhash64(F.lit(SEED), "doc_id", F.when(F.col("doc_id").isNull(), F.col("text")))
    drawn = F.pmod(at, F.lit(1 << 30)) < F.try_element_at(share, F.col("declared")) * (1 << 30)

    def packed(held: dict[str, np.ndarray]):
        for d, c in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([d], pa.string()), pa.array([c.astype("<i8").tobytes()], pa.binary())], names=["declared", "counts"])

    def count(batches):
        held: dict[str, np.ndarray] = {}
        for b in slices(batches):
            for t, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held[d] = held.get(d, 0) + np.bincount(buckets_of(t, n_buckets), minlength=n_buckets)
        yield from packed(held)

    def add(batches):
        held: dict[str, np.ndarray] = {}
        for b in batches:
            for d, c in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held[d] = held.get(d, 0) + np.frombuffer(c.as_py(), "<i8")
        yield from packed(held)

    schema = "declared string, counts binary"
    sampled = rows.where(drawn).select("text", "declared").mapInArrow(count, schema)
    table = np.full((n_buckets, len(languages)), 0.5, np.float32)
    index = {d: i for i, d in enumerate(languages)}
    # One array a language comes to the driver: all together at most CELLS counts, or LEAST_BUCKETS a language.
    for r in sampled.repartition("declared").mapInArrow(add, schema).toLocalIterator():
        table[:, index[r.declared]] += np.frombuffer(r.counts, "<i8")
    return TextModel(languages, np.log(table / table.sum(axis=0)))


def _softmax(x: Column) -> Column:
    top = F.array_max(x)
    e = F.transform(x, lambda v: F.exp(v - top))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, w: a + w))


def _sums(column: str, n: int) -> Column:
    """The sums of an array's ``n`` places."""
    return F.array(*(F.sum(F.col(column)[i]) for i in range(n)))


def _smoothed(counts: str | Column, above: Column) -> Column:
    """Shares of ``counts`` with ``K`` pseudo-counts as ``above`` has them."""
    size = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.transform(F.array(size), lambda n: F.zip_with(counts, above, lambda c, a: (c + K * a) / (n + K)))[0]


def identify(docs: DataFrame, model: TextModel | None = None) -> DataFrame:
    """doc_id, lang, posterior, text_lang (by text alone) and declared of ``docs``: doc_id,
    text, declared, host, suffix.  Without a model one is fitted on the declared rows."""
    model = fit(docs) if model is None else model
    spark, n = docs.sparkSession, len(model.languages)
    if not n:
        none = F.lit(None)
        return docs.select("doc_id", none.cast("string").alias("lang"), none.cast("double").alias("posterior"), none.cast("string").alias("text_lang"), "declared")
    shared = spark.sparkContext.broadcast(model)  # at most CELLS floats, or LEAST_BUCKETS a language

    def run(batches):
        m = shared.value
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array([m.score(t) for t in b.column(0).to_pylist()], pa.list_(pa.float64()))], names=["doc_id", "declared", "host", "suffix", "text_log"])

    scored = docs.select("text", "doc_id", "declared", "host", "suffix").mapInArrow(run, "doc_id long, declared string, host string, suffix string, text_log array<double>")
    scored = written(scored.withColumn("p", _softmax(F.col("text_log"))), "text-scores")

    # Hierarchy: all documents, suffix, host; each level smoothed toward the one above.
    hosts = written(scored.groupBy("host", "suffix").agg(_sums("p", n).alias("here")), "host-counts")
    whole = hosts.agg(_sums("here", n).alias("all")).first()["all"]
    total = sum(x or 0 for x in whole) or 1.0
    top = F.array(*(F.lit(((x or 0) + 1) / (total + n)) for x in whole))
    by_suffix = written(hosts.groupBy("suffix").agg(_sums("here", n).alias("here")), "suffix-counts").select(F.col("suffix").alias("of"), _smoothed("here", top).alias("above"))
    joined = hosts.join(maybe_broadcast(by_suffix), hosts.suffix.eqNullSafe(F.col("of")))
    priors = written(joined.select(F.col("host").alias("h"), F.col("suffix").alias("s"), "here", "above"), "priors")

    # P(declared | language), over the declarations that are as frequent as a language must
    # be; the rest count as one.
    said = written(scored.groupBy("declared").agg(F.count("*").alias("n")), "declarations")
    least = (said.agg(F.sum("n")).first()[0] or 0) / SHARE
    names = [r.declared for r in said.where(F.col("n") >= least).collect()]  # at most SHARE
    known = F.when(F.col("declared").isin([d for d in names if d is not None]), F.col("declared")).otherwise(F.when(F.col("declared").isNull(), F.lit("\0none")).otherwise(F.lit("\0other")))
    scored = scored.withColumn("said", known)
    channel = {r.said: r.n for r in scored.groupBy("said").agg(_sums("p", n).alias("n")).collect()}
    sums = [sum(c[i] for c in channel.values()) for i in range(n)]
    logs = spark.createDataFrame([(d, [float(np.log((c[i] + 0.5) / (sums[i] + 0.5 * len(channel)))) for i in range(n)]) for d, c in channel.items()], "d string, channel array<double>") if channel else spark.createDataFrame([], "d string, channel array<double>")

    fused = scored.join(maybe_broadcast(priors), F.col("host").eqNullSafe(F.col("h")) & F.col("suffix").eqNullSafe(F.col("s"))).join(F.broadcast(logs), F.col("said") == F.col("d"))
    # The host's other documents: its counts without the document's own.
    others = F.zip_with("here", "p", lambda a, b: F.greatest(a - b, F.lit(0.0)))
    fused = fused.withColumn("prior", _smoothed(others, F.col("above")))
    log = F.zip_with(F.zip_with("text_log", "prior", lambda a, b: a + F.log(b)), "channel", lambda a, b: a + b)
    languages = F.array(*(F.lit(x) for x in model.languages))
    best = lambda x: F.element_at(languages, F.array_position(x, F.array_max(x)).cast("int"))
    fused = fused.withColumn("q", _softmax(log))
    return fused.select("doc_id", best(F.col("q")).alias("lang"), F.array_max("q").alias("posterior"), best(F.col("text_log")).alias("text_lang"), "declared")


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host, suffix) of web pages (page_id, url, html)."""
    text = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " "), r"<[^>]*>", " ")
    of = host("url")
    return pages.select(F.col("page_id").alias("doc_id"), text.alias("text"), markup_language("html").alias("declared"), of.alias("host"), suffix_of(of).alias("suffix"))


def document_evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host, suffix) of documents: lang as declared, source as host."""
    declared = F.lower(F.nullif(F.trim("lang"), F.lit("")))
    return docs.select("doc_id", "text", declared.alias("declared"), F.col("source").alias("host"), suffix_of(F.col("source")).alias("suffix"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(document_evidence(documents(spark, sf_dir)))
    return found.withColumn("kept", F.coalesce(F.col("posterior") >= MIN_POSTERIOR, F.lit(False)))


def page_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages by text, markup language, host and suffix; the text model is fitted on
    declared pages and documents."""
    pages = page_evidence(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    model = fit(pages.unionByName(document_evidence(documents(spark, sf_dir))))
    found = identify(pages, model).withColumnRenamed("doc_id", "page_id")
    return found.withColumn("kept", F.coalesce(F.col("posterior") >= MIN_POSTERIOR, F.lit(False)))
