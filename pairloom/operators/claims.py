"""Claims by several writers (Q1-Q3, D2, D3): no two hold one row at once, and each row is done once.

Jobs are dealt to lots by a hash of their key, a folder each.  A writer claims a lot by creating
a file that must not be there yet (put if absent); only one of several can.  The file says whose it is and until
when; who finds that time past may claim the lot's next epoch in the same way.  Results go to a folder of the
lot's epoch and count once the lot's ``done`` file, put if absent as well, names that epoch: a
writer that was thought dead and wakes finds it there, and its results never count.

    jobs/lot=N              the rows
    claims/N.K              epoch K of lot N: owner and end
    results/lot=N/epoch=K   what its holder wrote
    claims/N.done           the epoch whose results count

Times are the caller's (epoch seconds); writers' clocks should agree to well under a claim's duration.
The driver handles lots, never rows.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOTS = 64


@dataclass(frozen=True)
class Claim:
    lot: int
    epoch: int
    owner: str
    until: float


class Claims:
    """Claims at ``path``, a folder that all writers share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, spark: SparkSession, path: str, jobs: DataFrame, key: str, lots: int = LOTS) -> Claims:
        """Deal ``jobs`` to lots; once, by one writer."""
        lot = F.pmod(F.xxhash64(key), F.lit(lots)).cast("int")
        jobs.withColumn("lot", lot).repartition("lot").write.partitionBy("lot").parquet(f"{path}/jobs")
        out = cls(spark, path)
        out._fs(f"{path}/claims").mkdirs(out._at(f"{path}/claims"))
        return out

    def _at(self, path: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._at(path).getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _put_if_absent(self, name: str, text: str) -> bool:
        """Create a file with this text; False if it is there.  The file has its text as soon as it is seen."""
        path = f"{self.path}/{name}"
        if self._fs(path).getScheme() == "file":
            at = self._fs(path).makeQualified(self._at(path)).toUri().getPath()
            own = f"{at}.{os.urandom(8).hex()}.tmp"
            with open(own, "w") as f:
                f.write(text)
            try:
                os.link(own, at)  # Hadoop's local file system would look first and then write
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
            return True
        try:
            out = self._fs(path).create(self._at(path), False)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def _text(self, name: str) -> str:
        stream = self._fs(self.path).open(self._at(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _names(self, folder: str) -> list[str]:
        return [f.getPath().getName() for f in self._fs(self.path).listStatus(self._at(f"{self.path}/{folder}"))]

    def lots(self) -> list[int]:
        return sorted(int(n[4:]) for n in self._names("jobs") if n.startswith("lot="))

    def state(self) -> tuple[dict[int, Claim], set[int]]:
        """The last claim of each lot that has one, and the lots that are done."""
        last: dict[int, int] = {}
        done = set()
        for name in self._names("claims"):
            lot, _, what = name.partition(".")
            if what == "done":
                done.add(int(lot))
            elif what.isdigit():
                last[int(lot)] = max(last.get(int(lot), 0), int(what))
        held = {}
        for lot, epoch in last.items():
            if lot not in done:
                until, _, owner = self._text(f"claims/{lot}.{epoch}").partition(" ")
                # An empty file is a claim that is being written: nobody may take it yet.
                held[lot] = Claim(lot, epoch, owner, float(until) if until else float("inf"))
        return held, done

    def claim(self, owner: str, now: float, seconds: float, n: int = 1) -> list[Claim]:
        """Up to ``n`` lots that nobody holds, or whose holder's time is past, by number."""
        held, done = self.state()
        out: list[Claim] = []
        for lot in self.lots():
            if len(out) == n:
                break
            before = held.get(lot)
            if lot in done or (before is not None and before.until > now):
                continue
            mine = Claim(lot, before.epoch + 1 if before else 1, owner, now + seconds)
            if self._put_if_absent(f"claims/{lot}.{mine.epoch}", f"{mine.until!r} {owner}"):
                out.append(mine)
        return out

    def rows(self, claims: list[Claim]) -> DataFrame:
        """The jobs of these lots; only their folders are read."""
        return self.spark.read.parquet(f"{self.path}/jobs").where(F.col("lot").isin([c.lot for c in claims]))

    def complete(self, claim: Claim, results: DataFrame) -> bool:
        """Write a lot's results; whether they count."""
        results.write.mode("overwrite").parquet(f"{self.path}/results/lot={claim.lot}/epoch={claim.epoch}")
        return self._put_if_absent(f"claims/{claim.lot}.done", str(claim.epoch))

    def results(self) -> DataFrame | None:
        """The results that count; None before the first."""
        done = [(lot, int(self._text(f"claims/{lot}.done"))) for lot in sorted(self.state()[1])]
        if not done:
            return None
        paths = [f"{self.path}/results/lot={lot}/epoch={epoch}" for lot, epoch in done]
        return self.spark.read.option("basePath", f"{self.path}/results").parquet(*paths)
