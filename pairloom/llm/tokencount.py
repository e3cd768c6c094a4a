"""Token counts kept up to date by signed deltas.

A rollup holds documents and tokens by source, language and tokenizer version.  Changes
come as signed rows: an insert adds a document's counts, a delete takes them away, and a
revision does both (the old count's row negative, the new one's positive, perhaps under
another version).  A batch's rows are summed by group and written under the batch's id;
then a marker commits it.  Totals are the sums of the committed batches, so order doesn't
matter.

Idempotence: a batch whose marker exists is not applied again; one that failed before its
marker is written anew over what it left.  ``compact`` sums committed batches into a
snapshot that lists them; its marker, too, comes last, and then what the snapshot holds is
deleted, so the folder stays small however many batches came.  Paths are Hadoop paths, so
a store's own file system serves.  One writer at a time.

Edge cases: null source, language or version is a group of its own; a null or empty text
counts a document with no tokens; groups that sum to nothing are left out; repeated rows
count each; a batch of no rows commits and changes nothing; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, new_path, slices, word_count, written

GROUP = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, docs long, tokens long"

_tokenizers: dict[tuple[str, str], object] = {}


def _tokenizer(path: str, pattern: str):
    if (path, pattern) not in _tokenizers:
        import tiktoken

        from .bpe import read_ranks

        _tokenizers[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    return _tokenizers[path, pattern]


def counted(docs: DataFrame, version: str, path: str, pattern: str) -> DataFrame:
    """(doc_id, source, lang, version, tokens, words): each text's tokens by a rank file."""

    def run(batches):
        t = _tokenizer(path, pattern)
        for b in slices(batches):
            n = [len(t.encode_ordinary(x)) if x else 0 for x in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:4], pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64()), b.column(4)], names=["doc_id", "source", "lang", "version", "tokens", "words"])

    plain = docs.select("text", "doc_id", "source", "lang", word_count("text").alias("words"))
    return plain.mapInArrow(run, "doc_id long, source string, lang string, version string, tokens long, words long")


def inserts(rows: DataFrame) -> DataFrame:
    return rows.select(*GROUP, F.lit(1).cast("long").alias("docs"), F.col("tokens").cast("long").alias("tokens"))


def deletes(rows: DataFrame) -> DataFrame:
    return rows.select(*GROUP, F.lit(-1).cast("long").alias("docs"), (-F.col("tokens")).cast("long").alias("tokens"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    return deletes(old).unionByName(inserts(new))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).where("docs <> 0 or tokens <> 0")


class Rollup:
    """Totals under one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.path}/{name}"))

    def _mark(self, name: str) -> None:
        self._fs.mkdirs(self._path(f"{self.path}/{name.rpartition('/')[0]}"))
        self._fs.create(self._path(f"{self.path}/{name}"), True).close()

    def _names(self, folder: str) -> list[str]:
        if not self._exists(folder):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.path}/{folder}")))

    def _delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)

    def _snapshot(self) -> str | None:
        """The folder of the last whole snapshot."""
        whole = [n for n in self._names("snapshots") if self._exists(f"whole/{n}")]
        return f"{self.path}/snapshots/{max(whole, key=int)}" if whole else None

    def _inside(self, batches: list[str]) -> set[str]:
        """Those of ``batches`` that the snapshot has."""
        at = self._snapshot()
        if at is None or not batches:
            return set()
        return {r.batch for r in self.spark.read.schema("batch string").parquet(f"{at}/batches").where(F.col("batch").isin(batches)).collect()}

    def committed(self, batch: str) -> bool:
        return self._exists(f"committed/{batch}") or bool(self._inside([batch]))

    def commit(self, batch: str, rows: DataFrame) -> bool:
        """Apply a batch of signed rows once; whether it was applied now."""
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", batch):  # Spark hides folders that begin with a dot or an underscore
            raise ValueError("a batch's id has letters, digits, dots, dashes and underscores, and begins with a letter or digit")
        if self.committed(batch):
            return False
        summed(rows).write.mode("overwrite").parquet(f"{self.path}/deltas/{batch}")
        self._mark(f"committed/{batch}")
        return True

    def _parts(self) -> tuple[list[str], list[str]]:
        """Folders whose rows add up to the totals, and the batches beyond the snapshot."""
        marked = self._names("committed")
        inside = self._inside(marked)
        new = [b for b in marked if b not in inside]
        at = self._snapshot()
        return ([f"{at}/totals"] if at else []) + [f"{self.path}/deltas/{b}" for b in new], new

    def totals(self) -> DataFrame:
        folders, _ = self._parts()
        rows = self.spark.read.schema(SCHEMA).parquet(*folders) if folders else self.spark.createDataFrame([], SCHEMA)
        return summed(rows)

    def compact(self) -> None:
        """Sum the committed batches into a new snapshot; then delete what it holds.

        Totals that were asked for before must have been read.
        """
        before, (_, new) = self._snapshot(), self._parts()
        names = self._names("snapshots")
        n = max([int(x) for x in names], default=0) + 1
        at = f"{self.path}/snapshots/{n}"
        self.totals().write.mode("overwrite").parquet(f"{at}/totals")
        batches = self.spark.createDataFrame([(b,) for b in new], "batch string")
        if before:
            batches = batches.union(self.spark.read.schema("batch string").parquet(f"{before}/batches"))
        batches.write.mode("overwrite").parquet(f"{at}/batches")
        self._mark(f"whole/{n}")
        for b in self._names("committed"):
            self._delete(f"committed/{b}")
            self._delete(f"deltas/{b}")
        for x in names:
            self._delete(f"whole/{x}")
            self._delete(f"snapshots/{x}")


def history(docs: DataFrame, path: str, first: tuple[str, str], second: tuple[str, str], pattern: str, revise: Column, delete: Column) -> DataFrame:
    """Totals after three batches, the first sent twice: all documents under the first
    version (name, rank file); those of ``revise`` counted anew under the second; those of
    ``delete`` gone."""
    rollup = Rollup(docs.sparkSession, path)
    old = written(counted(docs, *first, pattern), "counted")
    new = written(counted(docs.where(revise), *second, pattern), "recounted")
    rollup.commit("1-load", inserts(old))
    rollup.commit("1-load", inserts(old))
    rollup.commit("2-revise", revisions(old.where(revise), new))
    current = old.where(~revise).unionByName(new)
    rollup.commit("3-delete", deletes(current.where(delete)))
    return rollup.totals()


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents counted; those not in English revised to the vocabulary for many
    languages; those of under 50 words deleted."""
    import public_tokenizers as P

    one, many = "byte_bpe_50k", "byte_bpe_multi_50k"
    return history(
        documents(spark, sf_dir),
        new_path(spark, "rollup"),
        (one, P.path(f"{one}.tiktoken")),
        (many, P.path(f"{many}.tiktoken")),
        P.PATTERN,
        revise=~F.col("lang").eqNullSafe("en"),
        delete=F.col("words") < 50,
    )
