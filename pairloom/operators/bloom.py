"""Sketches of seen keys (U9-U12): a Bloom filter built in the JVM, as an optional first
test before the exact one; its bytes are dumped and restored."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import unseen

EXPECTED, ERROR = 10_000_000, 0.01
MAX_BYTES = 256 << 20


class Sketch:
    """A Bloom filter over strings.  It never misses a key that was added; it may claim one
    that wasn't, so ``unseen_exact`` checks its claims."""

    def __init__(self, handle):
        self._handle = handle

    @classmethod
    def build(cls, df: DataFrame, key: str, expected: int = EXPECTED, error: float = ERROR) -> Sketch:
        import math

        if -expected * math.log(error) / math.log(2) ** 2 / 8 > MAX_BYTES:
            raise ValueError("the sketch would be larger than a broadcast may be: use the exact join")
        return cls(df.select(F.trim(key).alias(key)).where(F.col(key).isNotNull())._jdf.stat().bloomFilter(key, expected, error))

    def contains(self, key: str) -> bool:
        return self._handle.mightContainString(key)

    def merged(self, other: Sketch) -> Sketch:
        self._handle.mergeInPlace(other._handle)
        return self

    def dump(self, spark) -> bytes:
        out = spark.sparkContext._jvm.java.io.ByteArrayOutputStream()
        self._handle.writeTo(out)
        return bytes(out.toByteArray())

    @classmethod
    def restore(cls, spark, data: bytes) -> Sketch:
        jvm = spark.sparkContext._jvm
        return cls(jvm.org.apache.spark.util.sketch.BloomFilter.readFrom(jvm.java.io.ByteArrayInputStream(bytearray(data))))


def seeded(frames: list[DataFrame], key: str) -> DataFrame:
    """The distinct keys of several tables."""
    out = frames[0].select(key)
    for f in frames[1:]:
        out = out.unionByName(f.select(key))
    return out.where(F.col(key).isNotNull()).distinct()


def unseen_exact(batch: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """What isn't in ``seen``, by the exact test that a sketch's claims need."""
    return unseen(batch, seen, key)
