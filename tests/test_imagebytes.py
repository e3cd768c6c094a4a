import random
import struct
import tracemalloc
import zlib

import pytest

from pairloom.functions import imagebytes as I  # noqa: E741


def chunk(kind, body, crc=None):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body) if crc is None else crc)


def png(w=7, h=5, depth=8, colour=2, interlaced=0, rows=None, parts=1):
    if rows is None:
        rows = bytes(I._png_bytes(w, h, depth * I._PNG_KINDS[colour][0], bool(interlaced)))
    z = zlib.compress(rows)
    cut = max(1, -(-len(z) // parts))
    idat = b"".join(chunk(b"IDAT", z[i : i + cut]) for i in range(0, len(z), cut))
    return I._PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, interlaced)) + chunk(b"tEXt", b"k\0v") + idat + chunk(b"IEND", b"")


def segment(marker, body):
    return b"\xff" + bytes([marker]) + struct.pack(">H", len(body) + 2) + body


def jpeg(w=9, h=4, frame=0xC0, scan=b"abc\xff\x00d\xff\xd0e", end=b"\xff\xd9", dnl=b""):
    sof = segment(frame, struct.pack(">BHHB", 8, h, w, 3) + bytes(9))
    return b"\xff\xd8" + segment(0xE0, b"JFIF\0" + bytes(9)) + segment(0xDB, bytes(65)) + b"\xff\xff" + sof[1:] + segment(0xC4, bytes(20)) + segment(0xDA, bytes(10)) + scan + dnl + end


def gif(w=3, h=2, frames=1, table=True, end=b";"):
    image = b"," + struct.pack("<HHHHB", 0, 0, w, h, 0x80) + bytes(6) + b"\x02" + b"\x03abc" + b"\x00"
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0x81 if table else 0, 0, 0) + (bytes(12) if table else b"") + b"!\xf9\x04\0\0\0\0\0" + image * frames + end


def riff(*chunks, lie=0):
    body = b"WEBP" + b"".join(k + struct.pack("<I", len(b)) + b + b"\0" * (len(b) & 1) for k, b in chunks)
    return b"RIFF" + struct.pack("<I", len(body) + lie) + body


def vp8(w, h):
    return b"VP8 ", b"\x10\0\0\x9d\x01\x2a" + struct.pack("<HH", w, h) + b"data"


def vp8l(w, h):
    return b"VP8L", b"\x2f" + struct.pack("<I", (w - 1) | (h - 1) << 14) + b"data!"


def vp8x(w, h):
    return b"VP8X", bytes(4) + (w - 1).to_bytes(3, "little") + (h - 1).to_bytes(3, "little")


GOOD = [
    (png(), ("PNG", 7, 5, 1, None)),
    (png(33, 17, 4, 3), ("PNG", 33, 17, 1, None)),
    (png(33, 17, 16, 6, 1, parts=9), ("PNG", 33, 17, 1, None)),
    (png(1, 1, 1, 0, 1), ("PNG", 1, 1, 1, None)),
    (png(3000, 2000), ("PNG", 3000, 2000, 1, None)),
    (jpeg(), ("JPEG", 9, 4, 1, None)),
    (jpeg(65535, 65535, 0xC2, b"x" * 5000), ("JPEG", 65535, 65535, 1, None)),
    (jpeg(9, 0, dnl=b"\xff\xdc\x00\x04\x01\x02"), ("JPEG", 9, 258, 1, None)),
    (jpeg(end=b"\xff\xd9trailing"), ("JPEG", 9, 4, 1, None)),
    (gif(), ("GIF", 3, 2, 1, None)),
    (gif(500, 400, 7, False), ("GIF", 500, 400, 7, None)),
    (riff(vp8(550, 368)), ("WEBP", 550, 368, 1, None)),
    (riff(vp8l(1, 16384)), ("WEBP", 1, 16384, 1, None)),
    (riff(vp8x(70000, 3), (b"ALPH", b"abc"), vp8(300, 3)), ("WEBP", 70000, 3, 1, None)),
    (riff(vp8x(10, 20), (b"ANIM", bytes(6)), (b"ANMF", bytes(24)), (b"ANMF", bytes(24))), ("WEBP", 10, 20, 2, None)),
]


@pytest.mark.parametrize("i", range(len(GOOD)))
def test_good_and_cut_files(i):
    data, want = GOOD[i]
    assert I.facts(data) == want
    ends = len(data) - (8 if data.endswith(b"trailing") else 0)
    for n in {1, 5, 11, 12, ends - 1, *range(20, min(ends, 3000), 7), ends // 2}:
        fmt, w, h, frames, problem = I.facts(data[:n])
        assert problem is not None or n >= ends, n
        assert (w, h) in ((None, None), want[1:3]) or want[0] == "WEBP"


def test_lying_files():
    assert I.facts(png(rows=bytes(5)))[4] == I.TRUNCATED  # fewer rows than it says
    assert I.facts(png(rows=bytes(50_000)))[4] == I.CORRUPT  # more
    bad = bytearray(png())
    bad[40] ^= 1
    assert I.facts(bytes(bad))[4] == I.CORRUPT  # a wrong checksum
    assert I.facts(I._PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", 0, 5, 8, 2, 0, 0, 0)))[1:] == (None, None, None, I.CORRUPT)
    assert I.facts(png(2**31 - 1, 2**31 - 1, rows=b"x"))[:3] == ("PNG", 2**31 - 1, 2**31 - 1)  # too big: its rows aren't counted
    assert I.facts(jpeg(0, 4))[4] == I.CORRUPT
    assert I.facts(jpeg(9, 0))[4] == I.CORRUPT
    assert I.facts(b"\xff\xd8" + segment(0xDA, bytes(10)) + b"x\xff\xd9")[4] == I.CORRUPT  # a scan without a frame
    assert I.facts(b"\xff\xd8\xff\xd9")[4] == I.CORRUPT
    assert I.facts(gif(0, 2))[4] == I.CORRUPT
    assert I.facts(gif(frames=0))[4] == I.CORRUPT
    assert I.facts(riff(vp8(5, 5), lie=100))[4] == I.TRUNCATED
    assert I.facts(riff(vp8x(5, 5)))[4] == I.CORRUPT  # a canvas without a picture
    assert I.facts(riff())[4] == I.CORRUPT
    assert [I.facts(x)[4] for x in (None, b"", b"<?xml", b"\x89PN", b"hello")] == [I.EMPTY, I.EMPTY, I.UNKNOWN, I.TRUNCATED, I.UNKNOWN]


def test_a_bomb_is_counted_in_steps():
    """A small file that inflates to 400 MB, and says that it is small."""
    z = zlib.compressobj(9)
    rows = b"".join(z.compress(bytes(1 << 20)) for _ in range(400)) + z.flush()
    for w, h in ((10, 10), (20_000, 4_000)):
        data = I._PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", rows) + chunk(b"IEND", b"")
        tracemalloc.start()
        assert I.facts(data)[4] == I.CORRUPT
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
        tracemalloc.stop()


def test_no_bytes_make_an_exception():
    rng = random.Random(7)
    for data, _ in GOOD:
        if len(data) > 5000:
            continue
        for _ in range(300):
            x = bytearray(data)
            for _ in range(rng.randint(1, 6)):
                x[rng.randrange(len(x))] = rng.choice([0, 255, rng.randrange(256)])
            fmt, w, h, frames, problem = I.facts(bytes(x))
            assert problem or (fmt and w > 0 and h > 0)


def test_status_by_bytes(spark):
    big = lambda data: data + bytes(5000)  # noqa: E731  behind its end
    rows = [(0, big(png())), (1, big(jpeg())), (2, big(riff(vp8(300, 300)))), (3, big(gif())), (4, png()), (5, big(png(65535, 65535, rows=b"x"))), (6, big(b"<html>")), (7, None), (8, b""), (9, gif()), (10, b"\xff\xd8" + bytes(6000))]
    df = spark.createDataFrame([(i, None if d is None else bytearray(d), "x") for i, d in rows], "id int, content binary, extra string").repartition(3)
    got = {r["id"]: r for r in I.with_status(df).collect()}
    assert {i: r["status"] for i, r in got.items()} == {0: 2, 1: 2, 2: 2, 3: 10, 4: 16, 5: 12, 6: 9, 7: 17, 8: 17, 9: 18, 10: 9}
    assert got[3]["format"] == "GIF" and got[5]["width"] == 65535 and got[6]["problem"] == "unknown" and got[0]["extra"] == "x"
    assert I.with_status(df.limit(0)).collect() == []
