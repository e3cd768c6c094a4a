import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from pairloom.llm import tokenbin as B

WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_words_apart_equal_whole_texts(monkeypatch):
    rnd = random.Random(4)
    texts = ["", " ", "It's  A\tTEST\r\n of <|endoftext|> things", "a\x1cb c\x85d e\xa0f g h", "é ́x Å\nİ ΣΑΣ ΟΔΟΣ. ½ 12345 日本 語！", "x" * 5000 + " y", "'s 's'S ' 're", "a‡ ‡ b", "‡", "※ ◊ ¶x †"]
    chars = "abZ éß'1 \n\t\x0b\x0ć　Σ!?＃🙂\x1d "
    texts += ["".join(rnd.choice(chars) for _ in range(rnd.randrange(60))) for _ in range(300)]
    texts += [" ".join("".join(chr(rnd.randrange(33, 127)) for _ in range(rnd.randrange(1, 9))) for _ in range(6)) for _ in range(300)]
    texts += [" ".join("".join(chr(rnd.randrange(33, 300)) for _ in range(rnd.randrange(1, 7))) for _ in range(6)) for _ in range(300)]
    enc = B.WordEncoder(WORDS)
    assert enc.plain
    texts += ["a <|endoftext|> b", "x<|endoftext|>y <|STARTOFTEXT|> <|startoftext|><|endoftext|>", "<|endof text|> <| |>"]
    plain = Tokenizer.from_file(WORDS)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[-3] == [320, 49407, 321]
    few = B.WordEncoder(WORDS)
    for t, ids in zip(texts, want, strict=True):
        assert np.frombuffer(enc.encode(t), enc.kind).tolist() == ids, t
    monkeypatch.setattr(B, "KNOWN", 40)
    for t, ids in zip(texts, want, strict=True):
        assert np.frombuffer(few.encode(t), enc.kind).tolist() == ids, t
    assert len(few.known) <= 20 and len(few.known.old) <= 20


@pytest.mark.parametrize("top", [1, 2, 300, 49_408, 70_000, 2**32])
@pytest.mark.parametrize("n", [1, 7, 1024])
def test_blocks_round_trip(top, n):
    rng = np.random.default_rng(1)
    ids = rng.integers(0, top, (5, n), dtype=np.uint64).astype(np.uint32)
    ids[0, 0] = top - 1
    ids[1] = np.minimum(ids[1], 3)
    ids[1, n // 2] = top - 1
    blocks = B.pack_blocks(ids)
    starts = np.cumsum([0, *map(len, blocks)])[:-1]
    assert B.unpack_blocks(b"".join(blocks), starts).tolist() == ids.reshape(-1).tolist()
    if top == 70_000 and n == 1024:
        assert len(blocks[1]) < 400  # one outlier is an exception and doesn't widen its block


def test_query_over_documents(spark, sf):
    t = Tokenizer.from_file(WORDS)
    start, want = 0, {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect():
        ids = [*t.encode(r.text, add_special_tokens=False).ids, 1]
        want[r.doc_id] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in B.query(spark, sf).collect()} == want


def test_odd_rows_and_stretches(spark, tmp_path):
    rows = [(2, "b c", 1), (None, "z", 2), (1, None, 3), (1, "", 4), (2, "a", 5), (2, "b c", 6), (9, "w " * 9000, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    manifest = B.write_files(df, WORDS, f"file://{tmp_path}/t")
    got = sorted((tuple(r) for r in B.read_files(spark, manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, 1, 1, 2, 2, 2, 9]
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]]).tolist()[:-1]
    assert B.read_files(spark, B.write_files(df.limit(0), WORDS, f"file://{tmp_path}/u")).count() == 0
    for r in manifest.collect():
        reader = B.Reader(r.path)
        whole = reader.ids(0, reader.n_ids)
        assert len(whole) == r.n_ids == reader.counts.sum()
        for a, b in ((0, 1), (3, r.n_ids), (min(1023, r.n_ids), min(1025, r.n_ids)), (5, 5)):
            assert reader.ids(a, b).tolist() == whole[a:b].tolist()


def test_a_file_that_is_none(tmp_path):
    (tmp_path / "x").write_bytes(bytes(100))
    with pytest.raises(ValueError):
        B.Reader(f"file://{tmp_path}/x")


def test_a_doc_id_of_a_third_of_the_rows(spark, tmp_path):
    """Many rows of one doc_id, and of none, go to several files; order and starts hold."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, f"word {i % 5} " * (i % 7)) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    manifest = B.write_files(df, WORDS, f"file://{tmp_path}/t")
    files = manifest.collect()
    assert len(files) == 4 and sum(r.first_id == 7 for r in files) + sum(r.first_id is None for r in files) >= 3
    got = sorted((tuple(r) for r in B.read_files(spark, manifest).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    assert [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got]]).tolist()[:-1]
    t = Tokenizer.from_file(WORDS)
    crcs = sorted((str(d), zlib.crc32(np.array([*t.encode(x, add_special_tokens=False).ids, 1], "<u4").tobytes())) for d, x in rows)
    assert sorted((str(r[0]), r[3]) for r in got) == crcs


def test_a_very_long_text(spark, tmp_path):
    text = "Some words, again and AGAIN 12 é " * 60_000
    df = spark.createDataFrame([(1, text), (2, "x" * 300_000)], "doc_id long, text string")
    got = {r.doc_id: r for r in B.read_files(spark, B.write_files(df, WORDS, f"file://{tmp_path}/t")).collect()}
    t = Tokenizer.from_file(WORDS)
    for d, x in ((1, text), (2, "x" * 300_000)):
        ids = [*t.encode(x, add_special_tokens=False).ids, 1]
        assert (got[d].n_tokens, got[d].ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
