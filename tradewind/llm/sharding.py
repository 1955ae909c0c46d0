"""Longest-processing-time sharding of groups that must stay together.

Rows with equal keys (here: equal texts) form a group.  Groups, sorted by size
from the largest down, each go to the least-loaded shard, which a heap keeps at
hand.  One heap over all groups would be one task, so the descending order is
cut into ranges, one task each:

* the heaviest groups, a fixed number per shard, are scheduled on the driver;
  the heap of the first range goes on from their loads;
* each further range but the last fills its own bins, one per shard, through a
  heap that starts empty; the driver matches the fullest bin of a range with the
  least-loaded shard (at most ``MAX_RANGES`` x shards numbers, whatever the input);
* the last range holds the smallest groups.  Its heap starts from the true loads
  of the shards, so they level what the larger groups left uneven.

Slots number the rows of each shard without gaps.  Rows are dealt by (shard,
key, row key) into ranges, which splits a group of any size; each range counts
its rows per shard, and the counts of earlier ranges are the offsets.

Defined results: a NULL text has no bytes and belongs to the group of the empty
text; an empty table gives an empty result; repeated rows are separate rows of
one group and take one slot each; ties are broken by the group key.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import materialize, shuffle_partitions

#: Bytes that each row needs beside its text.
ROW_OVERHEAD = 16
#: Groups per shard that the driver schedules; groups of a range; ranges at most.
HEAD_PER_SHARD, GROUPS_PER_RANGE, MAX_RANGES = 64, 100_000, 10_000


def text_size(text: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_OVERHEAD


def _fill(loads: list[int], sizes: list[int]) -> list[int]:
    """Bin of each size, in the given order; ``loads`` is updated."""
    heap = [(load, b) for b, load in enumerate(loads)]
    heapq.heapify(heap)
    out = []
    for s in sizes:
        load, b = heap[0]
        heapq.heapreplace(heap, (load + s, b))
        out.append(b)
    for load, b in heap:
        loads[b] = load
    return out


def _filled(ranged: DataFrame, shards: int, start: dict[int, list[int]]) -> DataFrame:
    """``part, bin, group_key, group_size``: each range's groups, in order, through a heap of its own
    that begins at ``start[part]`` or at zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, loads = None, []
        for b in batches:
            parts, sizes, bins = b.column("part").to_pylist(), b.column("group_size").to_pylist(), []
            for part, run_of in groupby(range(len(parts)), parts.__getitem__):
                if part != at:
                    at, loads = part, list(start.get(part, [0] * shards))
                bins += _fill(loads, [sizes[i] for i in run_of])
            yield pa.record_batch([b.column("part"), pa.array(bins, pa.int32()), b.column("group_key"),
                                   b.column("group_size")], names=["part", "bin", "group_key", "group_size"])

    by_part = ranged.select("part", "group_key", "group_size").repartition("part") \
        .sortWithinPartitions("part", F.col("group_size").desc(), "group_key")
    return by_part.mapInArrow(run, "part int, bin int, group_key binary, group_size long")


def assign_groups(groups: DataFrame, shards: int) -> DataFrame:
    """``group_key, shard`` for ``groups`` (``group_key`` binary, ``group_size`` long)."""
    spark = groups.sparkSession
    groups = materialize(groups.select("group_key", "group_size"), "lpt-groups")
    heaviest = groups.orderBy(F.col("group_size").desc(), "group_key").limit(HEAD_PER_SHARD * shards).collect()
    loads = [0] * shards
    bins = _fill(loads, [r["group_size"] for r in heaviest])
    head = spark.createDataFrame([(r["group_key"], b) for r, b in zip(heaviest, bins)],
                                 "group_key binary, shard int")
    if len(heaviest) < HEAD_PER_SHARD * shards:
        return head
    edge_size, edge_key = F.lit(heaviest[-1]["group_size"]), F.lit(bytes(heaviest[-1]["group_key"]))
    rest = groups.where((F.col("group_size") < edge_size)
                        | ((F.col("group_size") == edge_size) & (F.col("group_key") > edge_key)))
    ranges = 1 + min(MAX_RANGES, -(-groups.count() // GROUPS_PER_RANGE))
    ordered = materialize(
        rest.repartitionByRange(ranges, F.col("group_size").desc(), F.col("group_key"))
        .select(F.spark_partition_id().alias("part"), "group_key", "group_size"), "lpt-order")
    first, last = ordered.agg(F.min("part"), F.max("part")).first()
    if last is None:
        return head
    large = materialize(_filled(ordered.where(F.col("part") < last), shards, {first: loads}), "lpt-large")
    by_part: dict[int, dict[int, int]] = {}
    for r in large.groupBy("part", "bin").agg(F.sum("group_size").alias("load")).collect():
        by_part.setdefault(r["part"], {})[r["bin"]] = r["load"]
    place = []
    for part in sorted(by_part):
        own = by_part[part]
        if part == first:                     # its bins are the shards
            pairs = [(b, b) for b in own]
        else:                                 # the fullest bin to the least-loaded shard
            free = sorted(range(shards), key=lambda s: (loads[s], s))
            pairs = list(zip(sorted(own, key=lambda b: (-own[b], b)), free))
        for b, s in pairs:
            loads[s] += own[b]
            place.append((part, b, s))
    tail = _filled(ordered.where(F.col("part") == last), shards, {last: loads}) \
        .select("group_key", F.col("bin").alias("shard"))
    table = spark.createDataFrame(place, "part int, bin int, shard int")
    middle = large.join(F.broadcast(table), ["part", "bin"]).select("group_key", "shard")
    return head.unionByName(middle).unionByName(tail)


def with_slots(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """``rows`` and ``slot``: numbers from 0 within each shard, in the given order."""
    n = shuffle_partitions(rows.sparkSession)
    place = F.monotonically_increasing_id()
    dealt = materialize(
        rows.repartitionByRange(n, shard, *order).sortWithinPartitions(shard, *order)
        .withColumn("_part", F.shiftright(place, 33).cast("int")).withColumn("_row", place.bitwiseAND((1 << 33) - 1)),
        "lpt-slots")
    # One row per range and shard it holds: at most ranges + shards of them.
    held = dealt.groupBy(shard, "_part").agg(F.count("*").alias("n"), F.min("_row").alias("first")).collect()
    base, offsets = {}, []
    for r in sorted(held, key=lambda r: (r[shard], r["_part"])):
        at = base.get(r[shard], 0)
        offsets.append((r[shard], r["_part"], at - r["first"]))
        base[r[shard]] = at + r["n"]
    table = rows.sparkSession.createDataFrame(offsets, f"{shard} int, _part int, _shift long")
    return dealt.join(F.broadcast(table), [shard, "_part"]) \
        .withColumn("slot", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def shard_documents(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, shard, slot`` for every row: equal texts in one shard, sizes near equal."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(key).alias(key), text_size(text).alias("size"), F.crc32(body).alias("text_crc32"),
                       F.unhex(F.sha2(body, 256)).alias("group_key"))
    groups = rows.groupBy("group_key").agg(F.sum("size").alias("group_size"))
    placed = rows.join(assign_groups(groups, shards), "group_key")
    return with_slots(placed, "shard", ["group_key", key]).drop("group_key")
