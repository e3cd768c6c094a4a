import hashlib
import struct
import tracemalloc
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairloom.llm import isomedia as M


@pytest.mark.parametrize("frames", [1, 2, 15, 16, 17, 255, 256, 257, 512, 1000])
def test_round_trip(frames):
    data = bytes(i * 7 % 251 for i in range(frames * M.FRAME))
    media = M.container(data)
    (t,) = M.tracks(media)
    assert M.payload(media, t) == data
    assert (t["codec"], t["handler"], t["timescale"], t["duration"]) == ("raw ", "soun", 8000, len(data))
    keys = M.key_ranges(t)
    assert len(keys) == -(-frames // M.KEY)
    assert all(media[a:b] == data[i * M.KEY * M.FRAME :][: M.FRAME] for i, (a, b) in enumerate(keys))


def box(kind, body, long=False):
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body if long else struct.pack(">I4s", len(body) + 8, kind) + body


def foreign(sizes=(5, 3, 4), long=False, tail_open=False, stz2=False):
    """A file by another writer: mdat first, two chunks apart, explicit sizes, version 0, all frames sync."""
    mdat_body = b"AAAAABBB--CCCC"
    head = box(b"ftyp", b"mp42")
    mdat = box(b"mdat", mdat_body, long)
    at = len(head) + len(mdat) - len(mdat_body)
    stsd = box(b"stsd", bytes(4) + struct.pack(">I", 1) + box(b"mp4a", bytes(28)))
    stsz = box(b"stz2", bytes(7) + b"\x08" + struct.pack(">I", len(sizes)) + bytes(sizes)) if stz2 else box(b"stsz", bytes(4) + struct.pack(">II", 0, len(sizes)) + struct.pack(f">{len(sizes)}I", *sizes))
    stbl = box(b"stbl", stsd + box(b"stsc", bytes(4) + struct.pack(">I6I", 2, 1, 2, 1, 2, 1, 1)) + stsz + box(b"stco", bytes(4) + struct.pack(">I2I", 2, at, at + 10)))
    mdia = box(b"mdia", box(b"mdhd", bytes(12) + struct.pack(">II", 1000, 2500) + bytes(4)) + box(b"hdlr", bytes(8) + b"soun" + bytes(13)) + box(b"minf", stbl))
    moov = box(b"moov", box(b"trak", mdia))
    out = head + mdat + moov
    return out + struct.pack(">I4s", 0, b"free") + b"zzz" if tail_open else out


@pytest.mark.parametrize("options", [{}, {"long": True}, {"tail_open": True}, {"stz2": True}])
def test_foreign_files(options):
    data = foreign(**options)
    (t,) = M.tracks(data)
    assert (t["codec"], t["timescale"], t["duration"]) == ("mp4a", 1000, 2500)
    assert M.payload(data, t) == b"AAAAABBBCCCC"
    assert [data[a:b] for a, b in M.key_ranges(t)] == [b"AAAAA", b"BBB", b"CCCC"]


@given(st.binary(max_size=200), st.integers(0, 700))
@settings(max_examples=200, deadline=None)
def test_broken_files_give_an_error_only(noise, at):
    good = M.container(bytes(128))
    for data in (noise, good[:at], good[:at] + noise + good[at + len(noise) :]):
        try:
            M.tracks(data)
        except M.Malformed:
            pass


def test_query_over_documents(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = M.query(spark, sf).collect()
    assert len(got) == len(texts)
    seen = {}
    for r in got:
        n, p = M.padded(texts[r.doc_id])
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (n, len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-64:]))
        assert len(p) % 64 == 0 and r.media_bytes > len(p)
        assert seen.setdefault(texts[r.doc_id], tuple(r)[1:]) == tuple(r)[1:]


def test_columns_and_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "", "y"), (None, "é" * 40, None)], "doc_id long, text string, media string")
    stored = M.from_texts(docs)
    assert sorted(r.n_bytes for r in M.digests(stored).collect()) == [0, 0, 80]
    media = stored.select("doc_id", "media").union(spark.createDataFrame([(7, None), (8, bytearray(b"junk")), (9, bytearray(foreign()))], "doc_id long, media binary"))
    got = {str(r.doc_id): r for r in M.media_columns(media).collect()}
    assert got["7"].codec is None and got["7"].error is None
    assert got["8"].codec is None and got["8"].error
    assert (got["9"].codec, got["9"].duration_s, got["9"].n_samples, len(got["9"].keyframes)) == ("mp4a", 2.5, 3, 3)
    assert M.digests(stored.limit(0)).count() == 0


def test_deep_boxes():
    data = box(b"free", b"")
    for i in range(10_000):
        data = struct.pack(">I4s", len(data) + 8, b"moov") + data
    with pytest.raises(M.Malformed):
        M.tracks(data)


@pytest.mark.parametrize("kind", [b"stsz", b"stts", b"stsc", b"stco", b"stz2", b"stss"])
@pytest.mark.parametrize("value", [0xFFFFFFFF, 0x7FFFFFFF, 0x10000])
def test_huge_counts_are_an_error_or_harmless(kind, value):
    """Each number behind a table's box replaced by a huge one: no big allocation, no other error."""
    good = M.container(bytes(64 * 40)) if kind != b"stz2" else foreign(stz2=True)
    at = good.index(kind) + 4
    for i in range(0, 20, 4):
        data = good[: at + i] + struct.pack(">I", value) + good[at + i + 4 :]
        try:
            (t,) = M.tracks(data)
            assert len(t["sizes"]) <= 40
        except M.Malformed:
            pass


def track(number, handler, codec, stbl_rest, duration=0):
    stsd = box(b"stsd", bytes(4) + struct.pack(">I", 1) + box(codec, bytes(28)))
    mdia = box(b"mdia", box(b"mdhd", bytes(12) + struct.pack(">II", 10, duration) + bytes(4)) + box(b"hdlr", bytes(8) + handler + bytes(13)) + box(b"minf", box(b"stbl", stsd + stbl_rest)))
    return box(b"trak", box(b"tkhd", bytes(12) + struct.pack(">I", number) + bytes(64)) + mdia)


def empty_tables():
    return box(b"stts", bytes(8)) + box(b"stsc", bytes(8)) + box(b"stsz", bytes(12)) + box(b"stco", bytes(8))


def film():
    """Sound first, then pictures, both in two fragments; the pictures' sizes by sample, their
    first one of each fragment a key frame."""
    trex = b"".join(box(b"trex", bytes(4) + struct.pack(">5I", n, 1, 5, size, flags)) for n, size, flags in ((1, 3, 0), (2, 0, 0x10000)))
    out = box(b"ftyp", b"iso5") + box(b"moov", track(1, b"soun", b"mp4a", empty_tables()) + track(2, b"vide", b"avc1", empty_tables()) + box(b"mvex", trex))
    for letter in b"xy":

        def moof(offset):
            sound = box(b"traf", box(b"tfhd", struct.pack(">II", 0x20000, 1)) + box(b"trun", struct.pack(">IIi", 1, 2, offset)))
            pictures = box(b"traf", box(b"tfhd", struct.pack(">II", 0x20000, 2)) + box(b"trun", struct.pack(">IIiI", 0x205, 3, offset + 6, 0) + struct.pack(">3I", 4, 2, 1)))
            return box(b"moof", sound + pictures)

        head = moof(0)
        out += moof(len(head) + 8) + box(b"mdat", b"sss" * 2 + bytes([letter]) * 4 + b"pp" + b"q")
    return out


def test_fragments_and_all_tracks(spark):
    data = film()
    sound, pictures = M.tracks(data)
    assert M.payload(data, sound) == b"s" * 12 and len(M.key_ranges(sound)) == 4
    assert M.payload(data, pictures) == b"xxxxppqyyyyppq"
    assert [data[a:b] for a, b in M.key_ranges(pictures)] == [b"xxxx", b"yyyy"]
    assert (sound["duration"], pictures["duration"]) == (20, 30)
    rows = [(1, bytearray(data)), (2, bytearray(data.replace(b"trun", b"free"))), (3, bytearray(data.replace(struct.pack(">3I", 4, 2, 1), struct.pack(">3I", 4, 2, 2**31))))]
    got = {r.doc_id: r for r in M.media_columns(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert (got[1].codec, got[1].duration_s, got[1].n_samples, len(got[1].keyframes)) == ("avc1", 3.0, 6, 2)
    assert [(t.handler, t.codec, t.n_samples, len(t.keyframes)) for t in got[1].tracks] == [("soun", "mp4a", 4, 4), ("vide", "avc1", 6, 2)]
    assert got[2].error is None and got[2].n_samples == 0 and got[3].error and got[3].tracks is None


def test_samples_of_all_runs_and_tracks_are_bounded_by_the_file(spark):
    """Small files whose runs, or tracks, each claim nearly all that one may."""
    trex = box(b"trex", bytes(4) + struct.pack(">5I", 1, 1, 5, 0, 0))
    runs = b"".join(box(b"trun", struct.pack(">II", 0, 98_000)) for _ in range(1000))
    moov = box(b"moov", track(1, b"soun", b"mp4a", empty_tables()) + box(b"mvex", trex))
    many_runs = box(b"ftyp", b"iso5") + moov + box(b"moof", box(b"traf", box(b"tfhd", struct.pack(">II", 0x20000, 1)) + runs)) + bytes(80_000)
    uniform = box(b"stts", bytes(8)) + box(b"stsc", bytes(4) + struct.pack(">4I", 1, 1, 99_000, 1)) + box(b"stsz", bytes(4) + struct.pack(">II", 1, 99_000)) + box(b"stco", bytes(4) + struct.pack(">II", 1, 0))
    many_tracks = box(b"ftyp", b"iso5") + box(b"moov", b"".join(track(i, b"soun", b"mp4a", uniform) for i in range(300)))
    many_tracks += bytes(max(0, 100_000 - len(many_tracks)))
    for data in (many_runs, many_tracks):
        tracemalloc.start()
        with pytest.raises(M.Malformed):
            M.tracks(data)
        assert tracemalloc.get_traced_memory()[1] < 50 << 20
        tracemalloc.stop()
    rows = [(1, bytearray(many_runs)), (2, bytearray(many_tracks)), (3, bytearray(film()))]
    got = {r.doc_id: r for r in M.media_columns(spark.createDataFrame(rows, "doc_id long, media binary")).collect()}
    assert got[1].error and got[2].error and got[3].error is None


def test_a_very_long_text(spark):
    text = "é and words " * 400_000
    (r,) = M.digests(M.from_texts(spark.createDataFrame([(1, text)], "doc_id long, text string"))).collect()
    n, p = M.padded(text)
    assert (r.n_bytes, r.payload_sha256) == (n, hashlib.sha256(p).hexdigest())
