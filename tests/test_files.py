import io
import os
import random
import struct

import pytest
from pyspark.sql import functions as F

from pairloom.sources import byteranges as B
from pairloom.sources import recordfiles as R


def crc(data):
    """Bit by bit."""
    c = 0xFFFFFFFF
    for b in data:
        c ^= b
        for _ in range(8):
            c = c >> 1 ^ (0x82F63B78 if c & 1 else 0)
    return c ^ 0xFFFFFFFF


def test_checksums():
    assert R.crc32c(b"123456789") == 0xE3069283 and R.crc32c(b"") == 0 and R.crc32c(bytes(32)) == 0x8A9136AA
    rng = random.Random(1)
    for n in (1, 3, 4, 5, 255, 256, 257, 1023, 1024, 1025, 5000, 70_001):
        data = rng.randbytes(n)
        assert R.crc32c(data) == crc(data), n


def read_back(path):
    """An independent reader."""
    out = []
    for name in sorted(os.listdir(path)):
        if name.startswith((".", "_")):
            continue
        data, at = (path / name).read_bytes(), 0
        while at < len(data):
            (n,) = struct.unpack_from("<Q", data, at)
            mask = lambda c: ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF
            assert struct.unpack_from("<I", data, at + 8)[0] == mask(crc(data[at : at + 8]))
            body = data[at + 12 : at + 12 + n]
            assert struct.unpack_from("<I", data, at + 12 + n)[0] == mask(crc(body))
            out.append(body)
            at += n + 16
    return sorted(out)


def test_record_files_are_read_by_others_and_by_us(spark, tmp_path):
    spark.dataSource.register(R.RecordFiles)
    rng = random.Random(2)
    data = [b"", b"x", *(rng.randbytes(rng.choice([3, 1000, 1024, 4000])) for _ in range(60))]
    df = spark.createDataFrame([(bytearray(d),) for d in data] + [(None,)], "record binary").repartition(5)
    path = tmp_path / "records"
    df.write.format("record_files").mode("append").save(str(path))
    assert read_back(path) == sorted(data)
    got = spark.read.format("record_files").load(str(path))
    assert sorted(bytes(r["record"]) for r in got.collect()) == sorted(data)
    df.write.format("record_files").mode("append").save(str(path))
    assert read_back(path) == sorted(data * 2)
    df.limit(3).write.format("record_files").mode("overwrite").save(str(path))
    assert len(read_back(path)) <= 3
    assert not [n for n in os.listdir(path) if n.startswith(".")]
    df.limit(0).write.format("record_files").mode("overwrite").save(str(path))
    assert read_back(path) == [] and spark.read.format("record_files").load(str(path)).count() == 0


def test_a_failed_write_leaves_nothing(spark, tmp_path):
    spark.dataSource.register(R.RecordFiles)
    path = tmp_path / "records"
    spark.createDataFrame([("kept",)], "record string").write.format("record_files").mode("append").save(str(path))
    df = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id").cast("string")).alias("record"))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost"):
            df.write.format("record_files").mode(mode).save(str(path))
        assert read_back(path) == [b"kept"] and len([n for n in os.listdir(path) if n.startswith(".")]) == 0


def test_damaged_files_are_errors(spark, tmp_path):
    good = R.framed(b"hello") + R.framed(b"world" * 500)
    assert [d for _, d in R.records(io.BytesIO(good), len(good))] == [b"hello", b"world" * 500]
    for bad in (good[:-1], good[:5], b"\xff" * 30, good[:14] + b"J" + good[15:], b"\x00" + good[1:]):
        with pytest.raises(ValueError, match="record"):
            list(R.records(io.BytesIO(bad), len(bad)))


LINES = [b"", b"a", b"\r", b"two words", "é中".encode() * 9, b"x" * 300, b"mid\rcarriage"]


def split(data):
    """(offset, line) by plain splitting."""
    out, at = [], 0
    for part in data.split(b"\n"):
        last = at + len(part) == len(data)
        if part or not last:
            out.append((at, part if last else part[:-1] if part.endswith(b"\r") else part))
        at += len(part) + 1
    return out


@pytest.mark.parametrize("end", [b"\n", b"\r\n", b""])
def test_any_number_of_parts_gives_each_line_once(end):
    rng = random.Random(3)
    for _ in range(60):
        data = b"".join(rng.choice(LINES) + rng.choice([b"\n", b"\r\n"]) for _ in range(rng.randrange(30))) + rng.choice(LINES) + end
        for parts in (1, 2, 3, 7, 50, len(data) + 1):
            cuts = [len(data) * i // parts for i in range(parts + 1)]
            for chunk in (1 << 20, 5):
                got = [x for a, b in zip(cuts, cuts[1:], strict=False) if a < b for x in B.lines_from(io.BytesIO(data), a, b, chunk)]
                assert got == split(data), (data, parts, chunk)


def test_byte_ranges_of_files(spark, tmp_path):
    spark.dataSource.register(B.ByteRanges)
    rng = random.Random(4)
    want = []
    (tmp_path / "in").mkdir()
    for i in range(3):
        data = b"\n".join(rng.choice(LINES) + str(j).encode() for j in range(rng.randrange(2000)))
        (tmp_path / "in" / f"f{i}").write_bytes(data)
        want += [(f"f{i}", o, line.decode()) for o, line in split(data)]
    (tmp_path / "in" / "_hidden").write_bytes(b"x\n")
    (tmp_path / "in" / "empty").write_bytes(b"")
    for options in ({"parts": 2}, {"parts": 9}, {"bytes": 1000}, {}):
        df = spark.read.format("byte_ranges").options(**options).load(str(tmp_path / "in"))
        assert sorted((os.path.basename(r["file"]), r["offset"], r["line"]) for r in df.collect()) == sorted(want)
    halves = spark.read.format("byte_ranges").option("parts", 2).load(str(tmp_path / "in")).groupBy("part").count().collect()
    assert sorted(r["part"] for r in halves) == [0, 1]
