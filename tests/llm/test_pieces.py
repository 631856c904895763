import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer, models

from tidemark.llm import pieces, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  b", "a     b   ", "one two\nthree\t four", "éàü ñandú", "日本語 テスト", "🙂 x 🙃🙃", "▁marked▁ x",
    "<s> not a mark </s> <unk> <0x41>", "x" * 300, "0123456789 +1 (234)", "\x00\x01", "word " * 2000, " " * 70 + "end",
]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("ids", T.StringType()),
])


def random_texts(n, seed=0):
    rng = np.random.default_rng(seed)
    parts = [" ", "  ", "the", "ing", "Z", "é", "\n", "9", "一", "🙂", "ation", "q", ".", "▁"]
    return ["".join(rng.choice(parts, int(rng.integers(1, 15)))) for _ in range(n)]


@pytest.fixture(scope="module")
def unigram_path(tmp_path_factory):
    """The same vocabulary marked as a unigram model, for its own library to read."""
    model = proto.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.trainer_spec.model_type = proto.TrainerSpec.UNIGRAM
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(model.SerializeToString())
    return str(path)


def test_ids_and_texts_equal_the_library():
    codec = pieces.Codec(PATH)
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = TEXTS + random_texts(2000)
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert ids.tolist() == own.encode(text)
        assert codec.decode(ids) == own.decode(ids.tolist()) == text.replace("▁", " ")


def test_blank_runs_and_parity_by_the_backend():
    codec = pieces.Codec(PATH)
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [" " * n + end for n in (1, 2, 3, 5, 8, 15, 16, 17, 31, 33, 100, 1000) for end in ("", "a", "ing", "é", "日本", " the  end")]
    found = codec.verified(texts)
    assert all(alike for _, alike in found) and codec.differing == 0
    assert [ids.tolist() for ids, _ in found] == [own.encode(t) for t in texts]


def test_a_difference_is_reported_and_the_backend_counts(monkeypatch):
    codec = pieces.Codec(PATH)
    own = codec._own

    class Other:
        def encode(self, units, num_threads):
            return [[1] if u == "odd" else ids for u, ids in zip(units, own.encode(units), strict=True)]

    codec._own = Other()
    found = codec.verified(["an odd one", "an even one"])
    assert [alike for _, alike in found] == [False, True] and codec.differing == 1
    assert found[0][0].tolist() == own.encode("an odd one")


def test_rebuilt_backend_has_parity_on_ordinary_text():
    backend = pieces.PieceModel.read(PATH).backend()
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    texts = [t for t in TEXTS + random_texts(500) if "  " not in t.replace("▁", " ") and t.strip()]
    assert [e.ids for e in backend.encode_batch(texts)] == [own.encode(t) for t in texts]


def test_unigram_files_report_parity_too(unigram_path):
    codec = pieces.Codec(unigram_path)
    own = sentencepiece.SentencePieceProcessor(model_file=unigram_path)
    texts = [t for t in TEXTS if len(t) < 400] + random_texts(500)
    found = codec.verified(texts)
    # Ranks read as scores make many ties, which the library's single precision decides otherwise.
    assert [alike for _, alike in found] == [ids.tolist() == own.encode(t) for (ids, _), t in zip(found, texts, strict=True)]
    assert sum(alike for _, alike in found) > 0.85 * len(texts)
    assert [codec.decode(ids) for ids, _ in found] == [t.replace("▁", " ") for t in texts]


def test_frames(spark):
    rows = [(i, t, "clash") for i, t in enumerate(TEXTS)] + [(None, "x", ""), (5, None, ""), (5, TEXTS[5], "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pieces.encode(docs, PATH).collect()
    own = sentencepiece.SentencePieceProcessor(model_file=PATH)
    want = sorted((str(i), zlib.crc32(np.array(own.encode(t or ""), "<u4").tobytes()), len(own.encode(t or ""))) for i, t, _ in rows)
    assert sorted((str(r.doc_id), r.ids_crc32, r.n_tokens) for r in got) == want
    assert all(r.round_trip and len(r.ids) == r.n_tokens for r in got)
    back = pieces.decode(pieces.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(i), (t or "").replace("▁", " ")) for i, t, _ in rows)
    assert pieces.encode(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_counts_equal_the_tokenizer_with_ties():
    counter = token_counts.Counter(PATH)
    model = pieces.PieceModel.read(PATH)
    vocabulary = [(p, s if kind == 1 else -1e12) for p, s, kind in model.pieces]
    tokenizer = Tokenizer(models.Unigram(vocabulary, model.unknown_id, True))
    rng = np.random.default_rng(3)
    texts = TEXTS + random_texts(150, 1) + ["".join(rng.choice(list("abcdehinorst "), 60)) for _ in range(80)]
    texts = [t for t in texts if not any(p in t for p in ("<s>", "<unk>"))]
    normal_pieces = {p for p, _, kind in model.pieces if kind == 1}
    for text in texts:
        normal = ("▁" + text.replace(" ", "▁")) if text else ""
        if set(normal) <= normal_pieces:
            assert counter.counts([text])[0] == len(tokenizer.encode(normal).ids), text
        assert counter.counts([text])[0] == (counter.pieces(normal) if normal else 0)


def test_count_frames(spark):
    rows = [(1, "the one", "clash"), (None, "the", ""), (2, None, ""), (2, "", ""), (1, "the one", "")]
    got = token_counts.token_counts(spark.createDataFrame(rows, SCHEMA), PATH).collect()
    counter = token_counts.Counter(PATH)
    assert sorted(map(str, got)) == sorted(f"Row(doc_id={i}, n_tokens={counter.counts([t or ''])[0]})" for i, t, _ in rows)
    assert token_counts.token_counts(spark.createDataFrame([], SCHEMA), PATH).count() == 0
