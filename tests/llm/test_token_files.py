import io
import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tidemark.llm import token_files as tf

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "a", " a", "a ", "  a", "a  b", "a   b", "a \n b", "a\n b", "a \nb", "a\n\n b", "a\n \n", "it's  's x", "one <|endoftext|> two",
    "a\n <|endoftext|> b", "tab\t tab", "  x  y", "é è\x1c z", "123 4 5.6 +7 -8", "word " * 3000, "\n", " ", "   ", "日本 語 🙂 x",
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("start", T.StringType()),
])


def plain_ids(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_units_encode_like_whole_texts():
    rng = np.random.default_rng(0)
    parts = [" ", " ", "  ", "\n", "word", "Straße", "naïve", ",", "!?", "ǅ", "ŉ", "ⅷ", "ª", "\t", "a", "B", "'s", "9", ".", "é", "\x1c", " ", "the", "<|endoftext|>"]
    texts = TEXTS + ["".join(rng.choice(parts, int(rng.integers(1, 12)))) for _ in range(3000)]
    got = [np.frombuffer(b, "<u4").tolist() for b in tf.ByteBpe(PATH)(texts)]
    assert got == plain_ids(texts)


def test_file_round_trip_and_partial_reads(tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "FRAME_BYTES", 400)
    rng = np.random.default_rng(1)
    documents = [(None if i == 0 else i // 2, rng.integers(0, 50000, n).astype("<u4")) for i, n in enumerate([0, 5, 900, 1, 0, 40, 60, 350, 2])]
    path = f"file://{tmp_path}/x.zst"
    count, ids = tf.write_file(path, [(i, a.tobytes()) for i, a in documents])
    assert (count, ids) == (len(documents), sum(len(a) for _, a in documents))
    with tf.TokenFile(path) as file:
        assert [(e[0], e[2]) for e in map(file.entry, range(count))] == [(i, a.tobytes()) for i, a in documents]
    with tf.TokenFile(path) as file:
        assert [a.tolist() for a in file.ids(4)] == [documents[8][1].tolist()]
        assert file.frames_read == 1
    plain = b"".join(a.tobytes() for _, a in documents)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO((tmp_path / "x.zst").read_bytes()), read_across_frames=True).read()
    assert whole == plain


def test_a_damaged_frame_is_noticed(tmp_path):
    path = f"file://{tmp_path}/x.zst"
    tf.write_file(path, [(1, np.arange(500, dtype="<u4").tobytes())])
    raw = bytearray((tmp_path / "x.zst").read_bytes())
    raw[len(raw) - 9 - 4] ^= 1
    (tmp_path / "x.zst").write_bytes(raw)
    with tf.TokenFile(path) as file, pytest.raises(ValueError, match="checksum"):
        file.ids(1)


def test_write_and_read_back(spark, tmp_path):
    rows = [(100 - i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "no id", "x"), (77, None, "x"), (100, "again", "y"), (100, "again", "y")]
    manifest = tf.write_tokens(spark.createDataFrame(rows, SCHEMA), f"{tmp_path}/out", PATH)
    got = tf.digests(tf.read_tokens(manifest)).orderBy("start").collect()
    assert len(got) == len(rows)
    assert [r.doc_id for r in got] == sorted((i for i, _, _ in rows), key=lambda i: (i is not None, i))
    at = 0
    for row in got:
        assert row.start == at
        at += row.n_tokens
    want = sorted(zlib.crc32(np.array([*ids, 0], "<u4").tobytes()) for ids in plain_ids([t or "" for _, t, _ in rows]))
    assert sorted(r.ids_crc32 for r in got) == want


def test_empty_table(spark, tmp_path):
    manifest = tf.write_tokens(spark.createDataFrame([], SCHEMA), f"{tmp_path}/out", PATH)
    assert tf.read_tokens(manifest).count() == 0
