"""Byte-level BPE against the tiktoken library on whole texts."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tests.llm.helpers import DOC_SCHEMA, docs_of, save_docs
from tradewind.llm import bpe
from tradewind.llm.queries import op9_byte_bpe

ODD = [None, "", " ", "\n\n", "a", "  two  blanks\n\n  then ", "tab\there \r\n and\x0b\x1c\x85 more", "it's we'll 'S 'sx",
       "é x\u3000y z", "<|endoftext|> is text", "日本語のテキスト 123 abc" * 30, "x" * 5000, "a b " * 6000, "🙂🙃 \u200d👩\u200d🚀 end ",
       "\x00\x01", "ﬁ ligature, ǅ and Ⅷ", "e\u0301 combining", " " * 3000, "1234567890" * 500, "\ud7ff\ue000\uffff"]


@pytest.fixture(scope="module")
def direct():
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("direct", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def prose(rng, n):
    return "".join(rng.choice(["word", " ", "  ", "\n", "9", "It's", ",", "é", "日", " the", "\t", "x1"]) for _ in range(n))


def test_encoding_equals_the_whole_text(direct, monkeypatch):
    enc = bpe.encoding(bpe.default_rank_file(), bpe.default_pattern())
    rng = random.Random(1)
    texts = ODD + [prose(rng, rng.randrange(400)) for _ in range(300)]
    want = [direct.encode_ordinary(t or "") for t in texts]
    for size in (1, 8, 100, 1 << 16):                       # cuts at many safe boundaries
        monkeypatch.setattr(bpe.safe_parts, "__defaults__", (size,))
        got = [np.frombuffer(bpe.encode_text(enc, t), dtype="<u4").tolist() for t in texts]
        assert got == want, size


def test_parts_are_the_text_and_cut_at_safe_boundaries():
    rng = random.Random(2)
    for _ in range(200):
        text = prose(rng, 200)
        parts = list(bpe.safe_parts(text, 10))
        assert "".join(parts) == text
        for a, b in zip(parts, parts[1:]):
            assert a[-1].isascii() and a[-1].isalnum() and b[0] in " \n"
    assert list(bpe.safe_parts("x" * 1000, 10)) == ["x" * 1000]           # no boundary: whole


def test_decoding_in_steps(direct):
    enc = bpe.encoding(bpe.default_rank_file(), bpe.default_pattern())
    text = prose(random.Random(3), 3000)
    ids = bpe.encode_text(enc, text)
    assert all(bpe.decode_ids(enc, ids, step) == text.encode() for step in (1, 7, 1 << 18))
    assert bpe.decode_ids(enc, None) == b"" == bpe.decode_ids(enc, b"")
    # Raw bytes: a token may end inside a character.
    split = np.array(direct.encode_ordinary("🙃"), dtype="<u4")
    assert b"".join(bpe.decode_ids(enc, i.tobytes()) for i in split) == "🙃".encode()


def test_query_equals_the_library(spark, tmp_path, direct):
    rng = random.Random(4)
    texts = ODD[:-1] + [prose(rng, 300) for _ in range(20)] + ["long text, " * 30_000]
    df = docs_of(spark, texts, extra=True)
    df = df.union(df.where("doc_id IN (4, 10)")).union(df.where("doc_id = 4").selectExpr("CAST(NULL AS long) AS doc_id", *df.columns[1:]))
    got = op9_byte_bpe(spark, save_docs(spark, df, tmp_path / "d")).collect()
    assert len(got) == len(texts) + 3
    for r in got:
        text = (texts[4 if r.doc_id is None else r.doc_id] or "")
        ids = np.array(direct.encode_ordinary(text), dtype="<u4")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_empty_table(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    assert bpe.decode(bpe.encode(none)).count() == 0
