"""SimHash near-duplicates with bit-sliced comparison.

``fingerprints`` gives each text its 64-bit fingerprint.  ``near_duplicates``
links fingerprints at ``radius`` or fewer differing bits:

1. Equal fingerprints become one node, the smallest key that has them.
2. The 64 bits are cut into blocks.  Fingerprints within the radius agree on all
   blocks but ``radius`` at least, so each choice of (blocks - radius) blocks is a
   table whose buckets hold every candidate.  More blocks, with longer keys, are
   taken as the number of fingerprints grows; every choice is exact.
3. Buckets are cut into cells of bounded size (``cells.py``).  A task lays the
   fingerprints of its cells down as bit planes: word j of plane p holds bit p of
   64 fingerprints.  One query fingerprint against 64 others is then an XOR per
   plane, added to carry-save counters of 64 lanes.  Words whose 64 lanes have all
   gone beyond the radius are abandoned.
4. A cell returns a spanning forest of its links, fewer rows than it has
   fingerprints, so a large cluster never becomes all its pairs.
5. ``components.py`` joins the forests.

Defined results: a text without words (NULL, empty, blanks) has fingerprint 0;
repeated rows each get a result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.cells import with_cells
from tradewind.llm.common import batches_of, materialize, worker_state
from tradewind.llm.components import components

BITS = 64
#: Fingerprints of a chunk of a bucket; pairs of (query, word) compared at once.
CHUNK, LANE_BATCH = 2048, 1 << 16

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The SimHash of the text's word shingles; words are split at ASCII white space."""
    words = (text or "").encode().translate(_LOWER).split()       # bytes.split() knows just these blanks
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(width, n)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[:n - k + 1].tolist(), ends[k - 1:].tolist())),
                         dtype=np.uint64, count=n - k + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = hashes[i:i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """``key, bits`` (the fingerprint as a signed long) for every row."""
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    key_type = source.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("simhash", dict)                         # nothing is kept: other operators' tables go
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("bits", pa.int64())])
            signed = (f - (1 << 64) if (f := fingerprint(t.as_py(), width)) >> 63 else f for t in b.column("t"))
            yield from batches_of(zip(b.column("k").to_pylist(), signed), schema)

    return source.mapInArrow(run, f"k {key_type}, bits long").withColumnRenamed("k", key)


def planes(bits: np.ndarray) -> np.ndarray:
    """Bit planes of uint64 fingerprints: (words, 64) with 64 fingerprints to a word."""
    words = -(-len(bits) // 64)
    if not words:
        return np.zeros((0, BITS), dtype="<u8")
    padded = np.zeros(words * 64, dtype="<u8")
    padded[:len(bits)] = bits
    rows = np.unpackbits(padded.view(np.uint8).reshape(words, 64, 8), axis=2, bitorder="little")
    packed = np.ascontiguousarray(np.packbits(rows.transpose(0, 2, 1), axis=2, bitorder="little"))
    return packed.view("<u8").reshape(words, BITS)


def within(query: np.ndarray, word: np.ndarray, sliced: np.ndarray, alive: np.ndarray, radius: int,
           step: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Lanes within the radius for pairs of a query fingerprint and a word of planes.

    ``alive`` masks the lanes in question.  Returns the positions of pairs that have
    any and, for these, the mask of such lanes.
    """
    slices = max(1, radius.bit_length())
    at = np.flatnonzero(alive)
    over = ~alive[at]                                         # lanes beyond the radius, or not asked for
    counter = [np.zeros(len(at), dtype=np.uint64) for _ in range(slices)]
    start = (1 << slices) - 1 - radius                        # counters overflow just beyond the radius
    for i in range(slices):
        if start >> i & 1:
            counter[i][:] = ~np.uint64(0)
    for p in range(BITS):
        q = (query[at] >> np.uint64(p)) & np.uint64(1)
        carry = sliced[word[at], p] ^ (np.uint64(0) - q)
        for i in range(slices):                               # add one bit to every lane's counter
            counter[i], carry = counter[i] ^ carry, counter[i] & carry
        over |= carry
        if p % step == step - 1:
            keep = over != ~np.uint64(0)
            if not keep.all():
                at, over, counter = at[keep], over[keep], [c[keep] for c in counter]
                if not len(at):
                    break
    keep = over != ~np.uint64(0)
    return at[keep], ~over[keep]


def _forest(cells: list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]], radius: int) -> Iterator[tuple[int, int]]:
    """Spanning links of some cells, each given as nodes, fingerprints, chunk flags and whether it pairs two chunks."""
    sliced, query, word, alive, owner, base, first = [], [], [], [], [], [], 0
    node_of = np.concatenate([c[0] for c in cells])
    offset = 0
    for nodes, bits, second, cross in cells:
        # Lay out the lanes; queries are all rows, or the first chunk's rows against the second's lanes.
        lanes = np.flatnonzero(second) if cross else np.arange(len(bits))
        ask = np.flatnonzero(~second) if cross else np.arange(len(bits))
        mine = planes(bits[lanes])
        words = len(mine)
        full = np.full(words, ~np.uint64(0))
        if len(lanes) % 64:
            full[-1] = np.uint64((1 << (len(lanes) % 64)) - 1)
        q, w = np.repeat(ask, words), np.tile(np.arange(words), len(ask))
        mask = full[w]
        if not cross:                                         # a pair once: later lanes only
            low = q - 64 * w + 1
            mask = np.where(low <= 0, mask, np.where(low >= 64, np.uint64(0),
                            mask & (~np.uint64(0) << np.clip(low, 0, 63).astype(np.uint64))))
        sliced.append(mine)
        query.append(bits[q])
        word.append(w + first)
        alive.append(mask)
        owner.append(q + offset)
        base.append(np.stack([np.full(words, offset), np.arange(words) * 64], axis=1))
        if cross:
            base[-1] = np.stack([np.full(words, -1), np.arange(words) * 64], axis=1)
        first += words
        offset += len(nodes)
    sliced = np.concatenate(sliced)
    query, word, alive, owner = map(np.concatenate, (query, word, alive, owner))
    base = np.concatenate(base)
    lane_nodes, at = [], 0
    for nodes, bits, second, cross in cells:                  # lane -> position in node_of
        lane_nodes.append(at + (np.flatnonzero(second) if cross else np.arange(len(nodes))))
        at += len(nodes)
    lane_of_word = np.zeros((len(sliced), 64), dtype=np.int64)
    row = 0
    for own in lane_nodes:
        words = -(-len(own) // 64)
        padded = np.zeros(words * 64, dtype=np.int64)
        padded[:len(own)] = own
        lane_of_word[row:row + words] = padded.reshape(words, 64)
        row += words
    parent = np.arange(len(node_of))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(0, len(query), LANE_BATCH):
        cut = slice(i, i + LANE_BATCH)
        hits, lanes = within(query[cut], word[cut], sliced, alive[cut], radius)
        if not len(hits):
            continue
        marked = np.unpackbits(lanes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        h, lane = np.nonzero(marked)
        left, right = owner[cut][hits[h]], lane_of_word[word[cut][hits[h]], lane]
        for a, b in zip(left.tolist(), right.tolist()):
            a, b = root(a), root(b)
            if a != b:
                a, b = (a, b) if node_of[a] < node_of[b] else (b, a)
                parent[b] = a
                yield int(node_of[b]), int(node_of[a])


def _blocks(n: int, radius: int) -> int:
    """Fewest blocks whose buckets hold 64 of ``n`` evenly spread fingerprints at most, up to three more than needed."""
    for blocks in range(radius + 1, radius + 4):
        if n >> (BITS * (blocks - radius) // blocks) <= 64:
            return blocks
    return radius + 4


def _keys(bits: str, blocks: int, radius: int) -> list[Column]:
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [((1 << edges[i + 1]) - (1 << edges[i])) for i in range(blocks)]
    keys = []
    for t, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        mask = sum(masks[i] for i in chosen)
        mask -= (1 << 64) if mask >> 63 else 0
        keys.append(F.struct(F.lit(t).alias("table"), F.col(bits).bitwiseAND(F.lit(mask).cast("long")).alias("block")))
    return keys


def link_forest(nodes: DataFrame, radius: int = 3, chunk: int = CHUNK) -> DataFrame:
    """``u, v``: spanning links of the pairs of ``node, bits`` (distinct bits) within the radius."""
    blocks = _blocks(nodes.count(), radius)
    rows = nodes.select("node", "bits", F.explode(F.array(*_keys("bits", blocks, radius))).alias("k")) \
        .select("node", "bits", "k.table", "k.block")
    cell = ["table", "block", "cell_a", "cell_b"]
    dealt = with_cells(rows, ["table", "block"], "node", chunk).repartition(*cell).sortWithinPartitions(*cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
        yield from batches_of(_links(_whole_cells(batches, cell), radius), schema)

    return dealt.select(*cell, "own", "node", "bits").mapInArrow(run, "u long, v long")


def _whole_cells(batches: Iterator[pa.RecordBatch], cell: list[str]) -> Iterator[tuple]:
    """The cells of a partition sorted by cell, also those that batches cut."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([np.asarray(b.column(c)) for c in cell], axis=1).astype(np.int64)
        cuts = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows]):
            key = tuple(ids[lo].tolist())
            if key != held_key and held:
                yield _cell(held_key, held)
                held = []
            held_key = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield _cell(held_key, held)


def _cell(key: tuple, parts: list[pa.RecordBatch]) -> tuple:
    col = lambda name: np.concatenate([np.asarray(p.column(name)) for p in parts])
    a, b = key[-2:]
    return col("node").astype(np.int64), col("bits").astype(np.int64).view(np.uint64), (col("own") == b) & (a != b), a != b


def _links(cells: Iterator[tuple], radius: int) -> Iterator[tuple[int, int]]:
    """Small cells are compared together, so that array operations are worth their while."""
    held, work = [], 0
    for c in cells:
        if len(c[0]) < 2:
            continue
        held.append(c)
        work += len(c[0]) * -(-len(c[0]) // 64)
        if work >= LANE_BATCH:
            yield from _forest(held, radius)
            held, work = [], 0
    if held:
        yield from _forest(held, radius)


def near_duplicates(prints: DataFrame, key: str = "doc_id", radius: int = 3) -> DataFrame:
    """``key, bits, component_id`` for the rows of ``prints`` (``key, bits``)."""
    prints = materialize(prints, "simhash-prints")
    nodes = materialize(prints.groupBy("bits").agg(F.min(key).alias("node")), "simhash-nodes")
    # A NULL key is the node of a fingerprint only where no row with a key has it; it links with nothing.
    found = components(link_forest(nodes.where("node IS NOT NULL"), radius))
    of_bits = nodes.join(found, "node", "left").select("bits", F.coalesce("component", "node").alias("component_id"))
    return prints.join(of_bits, "bits")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """The rows of ``docs``, with all columns, whose key is the smallest of its component.

    Repeated rows of such a key stay together.
    """
    found = near_duplicates(fingerprints(docs, key, text, width), key, radius)
    kept = found.where(F.col(key).eqNullSafe(F.col("component_id"))).select(F.col(key).alias("_kept")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["_kept"]), "left_semi")
