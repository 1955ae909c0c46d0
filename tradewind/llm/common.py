"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.session import materialize

__all__ = ["documents", "materialize", "remainder", "batches_of", "compressed_batches", "keep_rows", "shared_path",
           "shuffle_partitions", "worker_state"]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def remainder(key: str | Column, modulus: int) -> Column:
    """``crc32(key as text) mod modulus``; NULL for a NULL key."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(col.cast("string").cast("binary")) % F.lit(modulus)


_STATE: dict[str, object] = {}


def worker_state(owner: str, build: Callable[[], object]) -> object:
    """What ``build`` makes, kept in this worker process for the tasks of ``owner`` until another owner asks.

    Spark gives a worker tasks of all stages, one after the other: were each operator's tables kept beside
    those of the operators before it, a pipeline's workers would hold them all."""
    if owner not in _STATE:
        _STATE.clear()
        _STATE[owner] = build()
    return _STATE[owner]


def batches_of(rows: Iterator[Sequence], schema: pa.Schema, max_bytes: int = 16 << 20,
               max_rows: int = 8192) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded rows and (approximately) bounded bytes."""
    held: list[Sequence] = []
    size = 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, (bytes, str)))
        if size >= max_bytes or len(held) >= max_rows:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[Sequence], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(col, type=f.type) for col, f in zip(zip(*rows), schema)], schema=schema)


def keep_rows(df: DataFrame, text: str, keep: Callable[[], Callable[[list], Sequence[bool]]]) -> DataFrame:
    """The rows of ``df``, all columns as they are, whose text ``keep()`` wants; narrow.

    ``keep`` is called once per task and returns a function from texts to booleans.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = keep()
        for b in batches:
            at = b.schema.get_field_index(text)
            for i in range(0, b.num_rows, 2048):
                part = b.slice(i, 2048)
                yield part.filter(pa.array(list(wanted(part.column(at).to_pylist())), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def compressed_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """Batches whose column ``text`` holds Zstandard frames of the UTF-8 bytes."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=1)
    for b in batches:
        at = b.schema.get_field_index(text)
        own = [None if t.as_py() is None else packer.compress(t.as_py().encode()) for t in b.column(at)]
        yield b.set_column(at, pa.field(text, pa.binary()), pa.array(own, pa.binary()))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below the cluster's shared checkpoint folder."""
    from tradewind.session import scratch_path
    return scratch_path(spark, label)
