"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over seven bytes ends a chunk wherever its value is one less than
a multiple of the block size; each chunk gives one sign, so an edit changes the
signs near it and leaves the others.  A fingerprint is ``block:signs:signs`` with
the signs at the block size and at twice that.  The block size is the smallest
of 3, 6, 12, ... at which a text has 64 signs at most; the whole text is always
read, and the last chunk reaches to its end.

Two fingerprints are compared by edit distance between signs made at one block
size: equal block sizes, or one twice the other.  Others have likeness 0.

Fingerprints are a narrow Arrow map, one text at a time; the likeness is a JVM
expression.  A long text is hashed in blocks of bounded size.

Defined results: NULL counts as the empty text, whose fingerprint is ``3::``; two
fingerprints without signs have likeness 1; equal texts have equal fingerprints;
repeated rows each get a result; other columns pass through as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tradewind.llm.common import compressed_batches

#: Bytes that the rolling hash sees; smallest block size; signs that a fingerprint has at most.
WINDOW, SMALLEST, SIGNS = 7, 3, 64
#: Bytes hashed at a time.
BLOCK = 1 << 20

_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def _rolled(data: np.ndarray) -> np.ndarray:
    """Rolling hash after each byte but the first ``WINDOW - 1``, which are context."""
    n = len(data) - WINDOW + 1
    wide = data.astype(np.uint32)
    total = np.zeros(n, np.uint32)
    mixed = np.zeros(n, np.uint32)
    for age in range(WINDOW):                       # the newest byte has age 0
        c = wide[WINDOW - 1 - age:WINDOW - 1 - age + n]
        total += c * np.uint32(WINDOW + 1 - age)    # sum, and sum weighted by recency
        mixed ^= c << np.uint32(5 * age)
    total += mixed
    return total


def _triggers(data: bytes, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Chunk ends at ``block`` and the values of the rolling hash there, plus one."""
    ends, values = [], []
    padded = np.frombuffer(bytes(WINDOW - 1) + data, np.uint8)
    for begin in range(0, len(data), BLOCK):
        h = _rolled(padded[begin:begin + BLOCK + WINDOW - 1]).astype(np.uint64) + np.uint64(1)
        at = np.flatnonzero(h % np.uint64(block) == 0)
        ends.append(at + (begin + 1))
        values.append(h[at])
    if not ends:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(ends), np.concatenate(values)


def _signs(data: memoryview, ends: np.ndarray) -> str:
    marks = ends.tolist()
    if not marks or marks[-1] < len(data):
        marks.append(len(data))
    begin, out = 0, []
    for end in marks:
        out.append(_ALPHABET[zlib.crc32(data[begin:end]) & 63])
        begin = end
    return "".join(out)


def _count(ends: np.ndarray, size: int) -> int:
    return len(ends) + (not len(ends) or int(ends[-1]) < size)


def fingerprint_of(data: bytes) -> str:
    """``block:signs:signs`` of the bytes of a text."""
    if not data:
        return f"{SMALLEST}::"
    block = SMALLEST
    while block * SIGNS < len(data):
        block *= 2
    ends, values = _triggers(data, block)
    while block > SMALLEST and _count(ends, len(data)) <= SIGNS:      # a smaller block size may do as well
        smaller = _triggers(data, block // 2)
        if _count(smaller[0], len(data)) > SIGNS:
            break
        block, (ends, values) = block // 2, smaller
    # A chunk end at twice the block size is one at the block size too.
    coarser = lambda b: values % np.uint64(b) == 0
    while _count(ends, len(data)) > SIGNS:
        block *= 2
        ends, values = ends[coarser(block)], values[coarser(block)]
    view = memoryview(data)
    return f"{block}:{_signs(view, ends)}:{_signs(view, ends[coarser(2 * block)])}"


def with_fingerprints(batches: Iterator[pa.RecordBatch], text: str, into: str) -> Iterator[pa.RecordBatch]:
    """Batches with the fingerprint of ``text`` as last column ``into``: for maps that do more in the same task."""
    for b in batches:
        at = b.schema.get_field_index(text)
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            own = [fingerprint_of((t.as_py() or "").encode()) for t in part.column(at)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(own, pa.string())],
                                             schema=part.schema.append(pa.field(into, pa.string())))


def fingerprints(df: DataFrame, text: str = "text", into: str = "fingerprint", compress: bool = False) -> DataFrame:
    """``df`` with the fingerprint of ``text`` in column ``into``, which it replaces if it is there; narrow.

    ``compress`` leaves ``text`` as Zstandard frames, for a shuffle that moves whole texts."""
    kept = [c for c in df.columns if c != into]
    source = df.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = with_fingerprints(batches, text, into)
        return compressed_batches(found, text) if compress else found

    fields = [StructField(f.name, BinaryType()) if compress and f.name == text else f for f in source.schema.fields]
    return source.mapInArrow(run, StructType([*fields, StructField(into, StringType())]))


def _alike(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / F.greatest(most, F.lit(1)))


def likeness(a: str, b: str) -> Column:
    """Likeness of two fingerprint columns, 0 to 1."""
    block = lambda c: F.split_part(F.col(c), F.lit(":"), F.lit(1)).cast("long")
    signs = lambda c, i: F.split_part(F.col(c), F.lit(":"), F.lit(i))
    return F.when(block(a) == block(b), _alike(signs(a, 2), signs(b, 2))) \
        .when(block(a) == 2 * block(b), _alike(signs(a, 2), signs(b, 3))) \
        .when(2 * block(a) == block(b), _alike(signs(a, 3), signs(b, 2))) \
        .otherwise(F.lit(0.0))
