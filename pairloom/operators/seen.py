"""Seen sets that stay on the cluster (J1, J2, U8-U12): exact keys behind a sharded Bloom filter.

A set is a folder of two Parquet tables, bucketed so that a join never moves them:

    filter  block, w0 .. w7: 512 bits for some forty keys; bucketed by block
    keys    the normalised keys themselves; a folder a shard, bucketed by key, so that a
            shard is a bucket and one file a batch

A key sets one bit in each of the eight words of its block, so filling a filter is a
``bit_or`` by block with map-side combine, and merging two filters is the same.  Filling, probing and merging are
built-in functions; no key passes through the driver.

A test shuffles the batch's keys (64-bit numbers) to the filter, which is a fiftieth of the
keys' rows.  What the filter does not claim was never added.  Claims are settled by the exact keys: the
shards that hold claims (numbers, at most ``SHARDS``) are read and no others, and the claims are
shuffled to them.

A batch is added under a name.  Its filter is written before its keys, and both overwrite the
batch's own folders, so an addition that was cut off is repeated under its name and leaves
nothing behind; until the keys are there, the filter only claims too much.  Writers of
different batches don't wait for each other; they may add one key twice, which is harmless.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Keys that the filter is laid out for; more make it claim more, never miss.
EXPECTED = 10_000_000
#: Keys a block: at 40 in 512 bits, eight a key, some 0.4% of other keys are claimed.
PER_BLOCK = 40
WORDS = [f"w{i}" for i in range(8)]
SHARDS = 64

_LAYOUT = "blocks long, shards int"


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """A bit for each word: six bits each of a second hash."""
    h = F.xxhash64(F.lit(1), key)
    place = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(len(WORDS))]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p).alias(w) for p, w in zip(place, WORDS, strict=True)]


class SeenSet:
    """A seen set at ``path`` (a folder that driver and executors share); made if it isn't there.

    ``expected`` and ``shards`` are those of the first who opens it.
    """

    def __init__(self, spark: SparkSession, path: str, expected: int = EXPECTED, shards: int = SHARDS):
        self.spark, self.path = spark, path.rstrip("/")
        if not self._there("layout/_SUCCESS"):
            layout = spark.createDataFrame([(max(1, math.ceil(expected / PER_BLOCK)), shards)], _LAYOUT)
            layout.coalesce(1).write.mode("ignore").json(f"{self.path}/layout")
        self.blocks, self.shards = spark.read.schema(_LAYOUT).json(f"{self.path}/layout").first()
        name = f"pairloom_seen_{hashlib.md5(self.path.encode()).hexdigest()}"
        self._filter, self._keys = f"{name}_filter", f"{name}_keys"
        words = ", ".join(f"{w} BIGINT" for w in WORDS)
        for table, columns, by, part, folder in (
            (self._filter, f"block BIGINT, {words}, batch STRING", "block", "batch", "filter"),
            (self._keys, "key STRING, batch STRING, shard INT", "key", "batch, shard", "keys"),
        ):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet PARTITIONED BY ({part}) CLUSTERED BY ({by}) INTO {self.shards} BUCKETS LOCATION '{self.path}/{folder}'")

    def _there(self, name: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def close(self) -> None:
        """Forget the tables' names; the files stay."""
        for t in (self._filter, self._keys):
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")

    def _table(self, name: str, without: str | None) -> DataFrame:
        """A table as its files are now, without the rows of the batch ``without``."""
        self.spark.catalog.refreshTable(name)
        found = self.spark.table(name)
        return found if without is None else found.where(F.col("batch") != without)

    def filter(self, without: str | None = None) -> DataFrame:
        return self._table(self._filter, without)

    def keys(self, without: str | None = None) -> DataFrame:
        return self._table(self._keys, without)

    # ------------------------------------------------------------ tests

    def claims(self, keys: DataFrame, without: str | None = None) -> DataFrame:
        """The distinct ``key``s that the filter claims, with their shard.

        A block of several batches is several rows; a key's bits all came with one batch, so
        one row must hold them all.
        """
        probes = keys.withColumns({"block": _block(F.col("key"), self.blocks), **{f"p{i}": b for i, b in enumerate(_bits(F.col("key")))}})
        hit = reduce(lambda a, b: a & b, (F.col(w).bitwiseAND(F.col(f"p{i}")) != 0 for i, w in enumerate(WORDS)))
        blocks = self.filter(without).select(F.col("block").alias("__block"), *WORDS)
        return probes.join(blocks, (F.col("block") == F.col("__block")) & hit, "left_semi").select("key", self._shard("key").alias("shard"))

    def _shard(self, key: str) -> Column:
        return F.pmod(F.hash(key), F.lit(self.shards))  # as Spark numbers the buckets of a key

    def _staged(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` computed once, into a folder that no other reader knows."""
        df.write.mode("overwrite").parquet(f"{self.path}/staged/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/staged/{name}")

    def vacuum(self) -> None:
        """Delete what tests and additions staged; results of tests must be consumed first."""
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/staged")
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)

    def found(self, keys: DataFrame, without: str | None = None, claims: DataFrame | None = None) -> DataFrame:
        """The distinct ``key``s that are in the set."""
        claims = self._staged(self.claims(keys, without), f"claims-{uuid.uuid4().hex}") if claims is None else claims
        shards = [r["shard"] for r in claims.select("shard").distinct().collect()]  # at most self.shards numbers
        if not shards:
            return claims.select("key")
        there = self.keys(without)
        if len(shards) < self.shards:
            there = there.where(F.col("shard").isin(shards))
        return claims.select("key").join(there.select(F.col("key").alias("__key")), F.col("key") == F.col("__key"), "left_semi")

    def _marked(self, batch: DataFrame, key: str, how: str, normalize, without: str | None) -> DataFrame:
        k = normalize(F.col(key))
        keys = batch.select(k.alias("key")).where(F.col("key").isNotNull()).distinct()
        found = self.found(keys, without).select(F.col("key").alias("__found"))
        return batch.join(found, k == F.col("__found"), how)

    def unseen(self, batch: DataFrame, key: str, normalize=F.trim, without: str | None = None) -> DataFrame:
        """The batch's rows whose key is not in the set; exact.  A null key was never seen."""
        return self._marked(batch, key, "left_anti", normalize, without)

    def already_seen(self, batch: DataFrame, key: str, normalize=F.trim, without: str | None = None) -> DataFrame:
        """The batch's rows whose key is in the set."""
        return self._marked(batch, key, "left_semi", normalize, without)

    def share_read(self, batch: DataFrame, key: str, normalize=F.trim) -> DataFrame:
        """What a test of ``batch`` reads, in keys: those asked (distinct), claimed and found, those held
        by the set, and those read, which are in shards that hold claims."""
        keys = batch.select(normalize(F.col(key)).alias("key")).where(F.col("key").isNotNull()).distinct()
        claims = self._staged(self.claims(keys), f"claims-{uuid.uuid4().hex}")
        held = self.keys()
        read = held.join(F.broadcast(claims.select("shard").distinct()), "shard", "left_semi")
        parts = {"asked": keys, "claimed": claims, "found": self.found(keys, claims=claims), "held": held, "read": read}
        return reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("what"), F.count("*").alias("keys")) for name, df in parts.items()))

    # ------------------------------------------------------------ additions

    def add(self, batch: DataFrame, key: str, name: str, normalize=F.trim) -> DataFrame:
        """Add the keys of ``batch`` that are new, as the batch ``name``; the new keys.

        Repeated under the same name, it tests against the rest of the set and overwrites what it left.
        """
        if not name or not all(c.isalnum() or c in "-" for c in name):
            raise ValueError("a batch's name has letters, digits and hyphens")
        keys = batch.select(normalize(F.col(key)).alias("key")).where(F.col("key").isNotNull()).distinct()
        found = self.found(keys, without=name).select(F.col("key").alias("__found"))
        fresh = keys.join(found, F.col("key") == F.col("__found"), "left_anti")
        fresh = self._staged(fresh, name)
        self._write(self._filter, filled(fresh, self.blocks), "block", name)
        self._write(self._keys, fresh.select("key", self._shard("key").alias("shard")), "key", name)
        return fresh

    def _write(self, table: str, rows: DataFrame, by: str, name: str) -> None:
        """Overwrite the batch ``name`` of a table, and nothing else."""
        view = f"pairloom_rows_{uuid.uuid4().hex}"
        rows.repartition(self.shards, by).sortWithinPartitions(by).createOrReplaceTempView(view)
        part = f"batch = '{name}'" + (", shard" if "shard" in rows.columns else "")
        self.spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({part}) SELECT {', '.join(rows.columns)} FROM {view}")
        self.spark.catalog.dropTempView(view)

    def merge(self, other: SeenSet, name: str) -> DataFrame:
        """Add another set's keys, as one batch."""
        return self.add(other.keys().select("key"), "key", name, normalize=lambda c: c)

    def compact(self, name: str, path: str, expected: int | None = None) -> SeenSet:
        """All batches as one, ``name``, in a new set at ``path``, whose filter may be laid out for
        more keys: a block's rows become one by ``bit_or``, unless its size changes."""
        out = SeenSet(self.spark, path, expected or self.blocks * PER_BLOCK, self.shards)
        keys = self.keys().select("key").distinct()
        bits = merged(self.filter()) if out.blocks == self.blocks else filled(keys, out.blocks)
        out._write(out._filter, bits, "block", name)
        out._write(out._keys, keys.select("key", out._shard("key").alias("shard")), "key", name)
        return out


def filled(keys: DataFrame, blocks: int) -> DataFrame:
    """U8: the filter of ``key``s: a row a block that has any."""
    return keys.select(_block(F.col("key"), blocks).alias("block"), *_bits(F.col("key"))).groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))


def merged(bits: DataFrame) -> DataFrame:
    """The filter of what was added to any of the filters whose rows these are."""
    return bits.groupBy("block").agg(*(F.bit_or(w).alias(w) for w in WORDS))
