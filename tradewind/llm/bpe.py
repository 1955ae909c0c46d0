"""Byte-level BPE encoding and decoding with the tiktoken library.

``encode`` maps a text column to its token ids, ``decode`` maps ids back to raw
bytes.  Both are narrow: no shuffle, one Arrow batch at a time, so a job of any
size needs the memory of a few texts per task and a lost executor costs only
its own tasks.

Ids travel as binary: little-endian unsigned 32-bit integers.  This is compact
(four bytes a token), the same on every platform and hashable as it stands.

Defined results: a NULL or empty text has no ids (empty binary, decoded to
empty binary); every input row gives one output row, repeated rows included;
columns other than the key and the text are not read, so clashing names do no
harm.  An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import batches_of

#: Texts above this many characters are cut before encoding.
LONG_TEXT = 1 << 16

# A match of the split pattern never continues from an ASCII letter or digit into a
# blank or a line break: white space is matched alone or as the head of the next match.
_SAFE = re.compile(r"(?<=[0-9A-Za-z])(?=[ \n])")


def default_rank_file() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers
    return public_tokenizers.PATTERN


@lru_cache(maxsize=4)
def encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    """The encoding of a local rank file; built once per worker process."""
    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("local-ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, size: int = LONG_TEXT) -> Iterator[str]:
    """Consecutive parts of ``text`` of about ``size`` characters whose encodings,
    joined, are the encoding of the whole; a stretch without a safe boundary stays whole."""
    begin = 0
    while len(text) - begin > size:
        cut = _SAFE.search(text, begin + size)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode_text(enc: tiktoken.Encoding, text: str | None) -> bytes:
    if not text:
        return b""
    return b"".join(np.asarray(enc.encode_ordinary(p), dtype="<u4").tobytes() for p in safe_parts(text))


def decode_ids(enc: tiktoken.Encoding, ids: bytes | None, step: int = 1 << 18) -> bytes:
    if not ids:
        return b""
    tokens = np.frombuffer(ids, dtype="<u4")
    return b"".join(enc.decode_bytes(tokens[i:i + step].tolist()) for i in range(0, len(tokens), step))


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", rank_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``key`` and ``ids`` (binary) for every row of ``df``."""
    rank_file, pattern = rank_file or default_rank_file(), pattern or default_pattern()
    source = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("ids", pa.binary())])
            rows = ((k.as_py(), encode_text(enc, t.as_py())) for k, t in zip(b.column("k"), b.column("t")))
            yield from batches_of(rows, schema)

    return source.mapInArrow(run, f"k {key_type}, ids binary").withColumnRenamed("k", key)


def decode(df: DataFrame, key: str = "doc_id", ids: str = "ids", rank_file: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """``key``, ``ids`` and ``decoded`` (the raw bytes) for every row of ``df``."""
    rank_file, pattern = rank_file or default_rank_file(), pattern or default_pattern()
    source = df.select(F.col(key).alias("k"), F.col(ids).alias("ids"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(rank_file, pattern)
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("ids", pa.binary()), ("decoded", pa.binary())])
            rows = ((k.as_py(), i.as_py(), decode_ids(enc, i.as_py())) for k, i in zip(b.column("k"), b.column("ids")))
            yield from batches_of(rows, schema)

    return source.mapInArrow(run, f"k {key_type}, ids binary, decoded binary").withColumnRenamed("k", key)
