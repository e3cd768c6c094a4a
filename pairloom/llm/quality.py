"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured in one row of array functions (no exploding, no shuffle):
words, their characters, symbols, repeated lines and words in repeated 3-word windows.
Rules fail on these counts.  Failures are summed by host, the hosts' failure rates are
shrunk toward a Beta prior fitted to all hosts by the method of moments, and a host whose
shrunk rate is over ``HOST_RATE`` is marked bad.  A document is kept if it passes the base
rules and, on a bad host, passes every rule.  So a document that fails nothing is kept
wherever it lies, and the host decides about those that fail a minor rule.

Repeated windows are found by sorting (64-bit hash, place) pairs within the text, so a
text of n words takes n log n steps however often it repeats itself.

Edge cases: a null or empty text has no words and fails the base rules; a null host is a
host of its own; a host of one document stays near the prior; if all documents or none
fail the prior is as strong as ``STRONGEST``; repeated rows count each; no rows give no
rows; columns other than doc_id, text and source are ignored by ``measure`` and kept by
the stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, maybe_broadcast, written

MIN_WORDS = 50
HOST_RATE = 0.5
STRONGEST = 1e6

#: Counts of one text; $t is the text, never null.  ``w`` holds its words: bound by a
#: one-element transform so that it is made once.  h is the windows' (hash, place) pairs in
#: order of hash, p the places of windows whose hash occurs again.
_COUNTS = r"""
transform(array(filter(split($t, '[\\x20\\x09-\\x0D]+'), x -> x <> '')), w -> named_struct(
  'n_words', cast(size(w) as bigint),
  'word_chars', cast(length(array_join(w, '')) as bigint),
  'n_symbols', cast(regexp_count($t, '[#*$%&|<>]') as bigint),
  'lines', transform(array(filter(split($t, '\n'), x -> x rlike '[^\\x20\\x09-\\x0D]')), l ->
      named_struct('n', cast(size(l) as bigint), 'd', cast(size(l) - size(array_distinct(l)) as bigint)))[0],
  'n_repeat_words', case when size(w) < 4 then 0L else
    transform(array(sort_array(transform(sequence(0, size(w) - 3), i -> named_struct('h', xxhash64(w[i], w[i + 1], w[i + 2]), 'i', i)))), h ->
    transform(array(sort_array(transform(filter(h, (x, j) -> (j > 0 and h[greatest(j - 1, 0)].h = x.h) or (j + 1 < size(h) and h[least(j + 1, size(h) - 1)].h = x.h)), x -> x.i))), p ->
    aggregate(p, named_struct('n', 0L, 'end', 0L), (a, x) -> named_struct('n', a.n + x + 3 - greatest(a.end, cast(x as bigint)), 'end', cast(x + 3 as bigint)), a -> a.n))[0])[0] end
))[0]
"""


def counts(text: str) -> Column:
    """A struct of the text's counts; see ``_COUNTS``."""
    return F.expr(_COUNTS.replace("$t", f"coalesce(`{text}`, '')"))


def rules(c: str) -> dict[str, Column]:
    """The rules' failures, from the struct column ``c``."""
    n = F.col(f"{c}.n_words")
    return {
        "base_failed": (n < MIN_WORDS) | (100 * F.col(f"{c}.n_repeat_words") > 50 * n),
        "symbols_failed": 10 * F.col(f"{c}.n_symbols") > n,
        "length_failed": (F.col(f"{c}.word_chars") < 3 * n) | (F.col(f"{c}.word_chars") > 10 * n),
        "lines_failed": 10 * F.col(f"{c}.lines.d") > 3 * F.col(f"{c}.lines.n"),
    }


def measure(docs: DataFrame, text: str = "text", out: str = "__pl_c") -> DataFrame:
    """``docs`` with the struct of counts and the columns ``<out>_base`` and
    ``<out>_minor``: whether the base rules and any other rule fail."""
    # Exploding the one struct keeps filters on the counts above it: pushed down, they
    # would measure the text a second time.
    df = docs.withColumn(out, F.explode(F.array(counts(text))))
    base, *minor = rules(out).values()
    either = minor[0]
    for m in minor[1:]:
        either = either | m
    return df.withColumns({f"{out}_base": base, f"{out}_minor": either})


def host_verdicts(marked: DataFrame, host: str, failed: Column) -> DataFrame:
    """(host, host_docs, host_failed, host_rate, host_bad): a written table, a row a host.

    The prior's mean is the overall failure rate m; its strength k follows from the
    hosts' variance v (weighted by documents) less what chance gives:
    k = m (1 - m) / v - 1, between 1 and ``STRONGEST``.
    """
    hosts = written(marked.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("host_docs"), F.count_if(failed).alias("host_failed")), "hosts")
    n, f = F.col("host_docs"), F.col("host_failed")
    total = hosts.agg(F.sum(n).alias("n"), F.sum(f).alias("f"), F.count("*").alias("hosts"), F.sum(f * f / n).alias("s")).first()
    m = (total.f or 0) / (total.n or 1)
    spread = (total.s or 0) / (total.n or 1) - m * m
    spread -= m * (1 - m) * (total.hosts or 0) / (total.n or 1)
    k = STRONGEST if spread <= 0 or m in (0, 1) else min(STRONGEST, max(1.0, m * (1 - m) / spread - 1))
    rate = (f + F.lit(m * k)) / (n + F.lit(k))
    return hosts.select("host", "host_docs", "host_failed", rate.alias("host_rate"), (rate > HOST_RATE).alias("host_bad"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, minor_failed, host_rate, host_bad and kept."""
    slim = measure(docs.select("doc_id", "text", F.col("source").alias("__pl_host")))
    c = "__pl_c"
    names = ("n_words", "word_chars", "n_symbols", "n_repeat_words")
    slim = slim.select("doc_id", "__pl_host", *(F.col(f"{c}.{x}").alias(x) for x in names), F.col(f"{c}.lines.d").alias("n_dup_lines"), F.col(f"{c}_base").alias("base_failed"), F.col(f"{c}_minor").alias("minor_failed"))
    slim = written(slim, "measured")
    hosts = maybe_broadcast(host_verdicts(slim, "__pl_host", F.col("base_failed") | F.col("minor_failed")))
    found = slim.join(hosts, slim["__pl_host"].eqNullSafe(hosts.host))
    kept = ~F.col("base_failed") & ~(F.col("host_bad") & F.col("minor_failed"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "minor_failed", F.round("host_rate", 9).alias("host_rate"), "host_bad", kept.alias("kept"))


def quality_stage(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are not kept; all columns stay as they are.

    The texts are measured once and written with their flags, without those that fail
    the base rules, whose rows only count for their hosts.
    """
    names = {c.lower(): c for c in docs.columns}
    source, text = names["source"], names["text"]
    flagged = measure(docs, text).drop("__pl_c").withColumn(text, F.when(~F.col("__pl_c_base"), F.col(text)))
    flagged = written(flagged, "flagged")
    hosts = host_verdicts(flagged, source, F.col("__pl_c_base") | F.col("__pl_c_minor"))
    bad = hosts.where("host_bad").select(F.col("host").alias("__pl_bad"), F.lit(True).alias("__pl_is_bad"))
    measured = flagged.where("not __pl_c_base")
    joined = measured.join(maybe_broadcast(bad), F.col(source).eqNullSafe(F.col("__pl_bad")), "left")
    return joined.where("__pl_is_bad is null or not __pl_c_minor").select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


ORACLE_SQL = r"""
WITH words AS (
    SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
    SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT l) AS d
    FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM words) WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id
), windows AS (
    SELECT doc_id, i, w[i:i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)
), repeated AS (
    SELECT doc_id, count(DISTINCT k) AS n
    FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1) GROUP BY doc_id
), measured AS (
    SELECT w.doc_id, w.source, len(w.w)::BIGINT AS n_words, length(array_to_string(w.w, ''))::BIGINT AS word_chars,
        length(regexp_replace(w.t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(l.d, 0)::BIGINT AS n_dup_lines, coalesce(l.n, 0) AS n_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
    FROM words w LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id)
), failed AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
        10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_dup_lines > 3 * n_lines AS minor_failed FROM measured
), hosts AS (
    SELECT source, count(*) AS n, count(*) FILTER (base_failed OR minor_failed) AS f FROM failed GROUP BY source
), total AS (
    SELECT sum(f)::DOUBLE / sum(n) AS m, sum(f::DOUBLE * f / n) / sum(n) AS s, count(*)::DOUBLE / sum(n) AS h FROM hosts
), prior AS (
    SELECT m, s - m * m - m * (1 - m) * h AS v FROM total
), verdicts AS (
    SELECT source, (f + m * k) / (n + k) AS host_rate
    FROM hosts, (SELECT m, CASE WHEN v <= 0 OR m = 0 OR m = 1 THEN 1e6 ELSE least(1e6, greatest(1.0, m * (1 - m) / v - 1)) END AS k FROM prior)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, minor_failed, round(host_rate, 9) AS host_rate, host_rate > 0.5 AS host_bad,
    NOT base_failed AND NOT (host_rate > 0.5 AND minor_failed) AS kept
FROM failed f JOIN verdicts v ON v.source IS NOT DISTINCT FROM f.source
"""
