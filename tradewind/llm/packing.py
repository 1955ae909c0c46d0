"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

``tokenize`` cuts documents into pieces of at most ``capacity`` tokens, ``pack``
places pieces into as few sequences as it can.

A full piece is a sequence of its own.  The others are dealt by hash into
problems of a bounded number of items.  Each problem is evolved by several
islands, a task each: an individual is a set of bins; crossover injects whole
well-filled bins of one parent into the other, drops the bins that hold
duplicates of the injected items and places the displaced items by best fit;
mutation empties a few bins and places their items anew.  After each epoch the
best individual of an island migrates to the next island of its problem.  A
problem that reaches the lower bound (total tokens / capacity) is finished.
The one least-filled bin that each problem may keep is then packed again with
those of other problems, in rounds, so that no loss grows with the input.

State between epochs is a Parquet table in the shared folder, so a lost executor
costs one epoch of its islands.  No task holds more than one problem at a time.

Defined results: a NULL text is the empty text, which is the end token alone;
repeated rows are packed once each; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import batches_of, materialize, worker_state

#: Items of a problem, islands of a problem, individuals of an island, generations of an epoch, epochs.
PROBLEM_ITEMS, ISLANDS, POPULATION, GENERATIONS, EPOCHS = 2048, 3, 4, 6, 2
#: Problems whose least-filled bins are packed together in one round.
MERGED = 64


# --- tokens -----------------------------------------------------------------

def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"     # Spark's tasks are the parallel units
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class _Known(dict):
    """Ids of chunks.  Asked for another chunk, it notes that in ``unseen`` and answers None, so that a text
    takes one lookup a chunk, learned or not."""

    def __init__(self):
        super().__init__()
        self.unseen: list[str] = []

    def __missing__(self, chunk: str) -> None:
        self.unseen.append(chunk)


class CachedTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes, with a bounded cache of chunks.

    A chunk is a run of blanks and line breaks with the run of other characters
    after it.  Byte-level pre-tokens never go on from a character that is not
    white space into white space, so the ids of chunks, joined, are those of the
    text.  A text with any other white space is encoded whole, as are long chunks.
    Letters do not go on into a character that is neither letter nor white space
    either: where a text's letters are those of ``_PLAIN``, words are chunks without
    what follows them, so fewer chunks differ.
    A text that holds the string of an added token is encoded whole, by the tokenizer's
    own defaults: the string becomes that token.
    """

    _CHUNKS = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
    _PLAIN = "A-Za-zÀ-ÖØ-öø-ÿ"
    _WORDS = re.compile(rf"[ \n]*[{_PLAIN}]+|[ \n]*[^ \n{_PLAIN}][^ \n]*|[ \n]+")
    _NOT_PLAIN = re.compile(rf"[^\x00-\x7f{_PLAIN}]")
    _OTHER_SPACE = re.compile(r"[^\S \n]")

    def __init__(self, path: str, entries: int = 1_000_000, longest: int = 40):
        self.tok, self.entries, self.longest, self.known = _tokenizer(path), entries, longest, _Known()
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        # Byte-level tokens are written with one character per byte.
        vocab = self.tok.get_vocab()
        self.bytes_of = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for token, i in vocab.items():
            self.bytes_of[i] = len(token)

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_joined(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks that begin with white space and end without: encoded as one text, cut by the tokens' bytes."""
        ids = np.array(self.tok.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = np.cumsum([len(c.encode()) for c in chunks])
        at = np.cumsum(self.bytes_of[ids])
        cuts = np.searchsorted(at, ends)
        if at[-1] != ends[-1] or (at[cuts] != ends).any():
            return self._encode(chunks)
        cuts, raw = [0, *(4 * (cuts + 1)).tolist()], ids.tobytes()
        return [raw[lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def _learn(self, unseen: set[str]) -> None:
        new = [c for c in unseen if len(c) <= self.longest]
        # Joined chunks must begin with white space, and the one before must not end with it.
        inner = [c for c in new if c[0] in " \n" and c[-1] not in " \n"]
        outer = [c for c in new if c[0] not in " \n" or c[-1] in " \n"]
        for encode, chunks in ((self._encode_joined, inner), (self._encode, outer)):
            for i in range(0, len(chunks), 1024):
                self.known.update(zip(chunks[i:i + 1024], encode(chunks[i:i + 1024])))

    def _split(self, text: str) -> list[str] | None:
        if self._OTHER_SPACE.search(text) or (self.added and self.added.search(text)):
            return None
        return (self._CHUNKS if self._NOT_PLAIN.search(text) else self._WORDS).findall(text)

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        known = self.known
        if len(known) > self.entries:
            known.clear()
        split, found = [self._split(t or "") for t in texts], []
        for chunks in split:
            before = len(known.unseen)
            ids = list(map(known.__getitem__, chunks or ()))
            found.append(b"".join(ids) if len(known.unseen) == before else ids)
        self._learn(set(known.unseen))
        known.unseen.clear()
        for t, chunks, ids in zip(texts, split, found):
            if chunks is None:
                yield self._encode([t])[0]
            elif isinstance(ids, bytes):
                yield ids
            else:
                at = -1
                for _ in range(ids.count(None)):
                    at = ids.index(None, at + 1)
                    learned = known.get(chunks[at])
                    ids[at] = self._encode([chunks[at]])[0] if learned is None else learned      # a long chunk is not kept
                yield b"".join(ids)


def _cached_tokenizer(path: str) -> CachedTokenizer:
    """One per worker process: its tasks share the chunks."""
    return worker_state("packing", lambda: lru_cache(maxsize=2)(CachedTokenizer))(path)


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048,
             tokenizer: str | None = None, end_id: int = 0, keep_ids: bool = True) -> DataFrame:
    """``key, piece, start, length, ids_crc32, ids`` for every piece of every row.

    A document longer than ``capacity`` is cut so that only its first piece is
    shorter.  ``ids`` (little-endian unsigned 32-bit integers) is NULL unless ``keep_ids``.
    """
    path = tokenizer or default_tokenizer()
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    key_type = source.schema["k"].dataType.simpleString()
    end = array("I", [end_id]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cached = _cached_tokenizer(path)
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("piece", pa.int32()), ("start", pa.int64()),
                                ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())])

            def rows():
                for i in range(0, b.num_rows, 512):
                    part = b.slice(i, 512)
                    for k, ids in zip(part.column("k").to_pylist(), cached.encode(part.column("t").to_pylist())):
                        ids += end
                        n = len(ids) // 4
                        edges = [0, *range(n % capacity or capacity, n, capacity), n]
                        for piece, (lo, hi) in enumerate(zip(edges, edges[1:])):
                            own = ids[4 * lo:4 * hi]
                            yield k, piece, lo, hi - lo, zlib.crc32(own), own if keep_ids else None

            yield from batches_of(rows(), schema)

    return source.mapInArrow(run, f"k {key_type}, piece int, start long, length long, ids_crc32 long, ids binary") \
        .withColumnRenamed("k", key)


# --- the genetic algorithm of one island ------------------------------------

class _Bins:
    """Bins under construction; best fit finds the smallest sufficient gap by its bit."""

    def __init__(self, capacity: int):
        self.capacity, self.items, self.gaps, self.by_gap, self.mask = capacity, [], [], {}, 0

    def add(self, items: list[int], gap: int) -> None:
        self.items.append(items)
        self.gaps.append(gap)
        self._offer(len(self.items) - 1, gap)

    def _offer(self, b: int, gap: int) -> None:
        if gap:
            self.by_gap.setdefault(gap, []).append(b)
            self.mask |= 1 << gap

    def place(self, item: int, size: int) -> None:
        fit = self.mask >> size
        if not fit:
            self.add([item], self.capacity - size)
            return
        gap = size + (fit & -fit).bit_length() - 1
        b = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            self.mask ^= 1 << gap
        self.items[b].append(item)
        self.gaps[b] = gap - size
        self._offer(b, gap - size)


def _repair(bins: list[list[int]], loose: list[int], sizes: list[int], capacity: int) -> list[list[int]]:
    """``bins`` with the loose items placed by best fit, the largest first."""
    made = _Bins(capacity)
    for items in bins:
        made.add(list(items), capacity - sum(sizes[i] for i in items))
    for i in sorted(loose, key=lambda i: (-sizes[i], i)):
        made.place(i, sizes[i])
    return made.items


def _fitness(bins: list[list[int]], sizes: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; then fuller ones beside emptier ones."""
    return -len(bins), sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def _cross(host: list[list[int]], donor: list[list[int]], sizes: list[int], capacity: int,
           rng: np.random.Generator) -> list[list[int]]:
    """Inject a random share of the donor's better-filled half; best-fit what that displaces."""
    best = sorted(donor, key=lambda b: (-sum(sizes[i] for i in b), b))[:max(1, len(donor) // 2)]
    chosen = [b for b, take in zip(best, rng.random(len(best)) < 0.5) if take] or best[:1]
    injected = {i for b in chosen for i in b}
    kept = [b for b in host if injected.isdisjoint(b)]
    loose = [i for b in host if not injected.isdisjoint(b) for i in b if i not in injected]
    return _repair(chosen + kept, loose, sizes, capacity)


def _mutate(bins: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Empty the least-filled bin and a few random ones."""
    order = sorted(range(len(bins)), key=lambda b: (sum(sizes[i] for i in bins[b]), b))
    gone = {order[0], *rng.choice(len(bins), size=min(len(bins), 1 + len(bins) // 50), replace=False).tolist()}
    loose = [i for b in gone for i in bins[b]]
    return _repair([bins[b] for b in range(len(bins)) if b not in gone], loose, sizes, capacity)


def evolve(sizes: list[int], population: list[list[list[int]]], capacity: int, generations: int, members: int,
           rng: np.random.Generator) -> list[list[list[int]]]:
    """The island's individuals after some generations, the best first."""
    bound = -(-sum(sizes) // capacity)
    if not population:
        population = [_repair([], list(range(len(sizes))), sizes, capacity)]
    score = lambda p: _fitness(p, sizes, capacity)
    if len(population[0]) > bound:
        while len(population) < members:
            order = rng.permutation(len(sizes)).tolist()       # best fit in a random order, for variety
            made = _Bins(capacity)
            for i in order:
                made.place(i, sizes[i])
            population.append(made.items)
    population.sort(key=score, reverse=True)
    for _ in range(generations):
        if len(population[0]) <= bound:
            break
        a, b = rng.choice(min(len(population), members), size=2, replace=len(population) < 2)
        population += [_cross(population[a], population[b], sizes, capacity, rng),
                       _mutate(population[0], sizes, capacity, rng)]
        population = sorted(population, key=score, reverse=True)[:members]
    return population[:members]


# --- islands and migration on Spark -----------------------------------------

_STATE = "problem long, island int, member int, items array<long>, sizes array<int>, bins array<int>"


def _rows_of(problem: int, island: int, items: np.ndarray, sizes: list[int], population: list) -> pd.DataFrame:
    rows = []
    for member, bins in enumerate(population):
        bin_of = np.empty(len(items), dtype=np.int32)
        for b, own in enumerate(bins):
            bin_of[own] = b
        rows.append((problem, island, member, items, np.asarray(sizes, dtype=np.int32), bin_of))
    return pd.DataFrame(rows, columns=["problem", "island", "member", "items", "sizes", "bins"])


def _bins_of(bin_of: np.ndarray) -> list[list[int]]:
    order = np.argsort(bin_of, kind="stable")
    cuts = np.flatnonzero(np.diff(bin_of[order])) + 1
    return [own.tolist() for own in np.split(order, cuts)]


def _islands(items: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """One row per problem: its best individual. ``items`` has ``problem, item, length``."""
    def begin(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item")
        sizes = pdf["length"].astype(int).tolist()
        rng = np.random.default_rng([int(key[0]) & 0xFFFFFFFF, int(key[1]), 0])
        found = evolve(sizes, [], capacity, GENERATIONS, POPULATION, rng)
        return _rows_of(key[0], key[1], pdf["item"].to_numpy(), sizes, found)

    state = items.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(islands)]))) \
        .groupBy("problem", "island").applyInPandas(begin, _STATE)
    def further(epoch: int):
        def go_on(key, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("member")
            sizes = [int(s) for s in pdf["sizes"].iloc[0]]
            rng = np.random.default_rng([int(key[0]) & 0xFFFFFFFF, int(key[1]), epoch])
            found = evolve(sizes, [_bins_of(np.asarray(b)) for b in pdf["bins"]], capacity, GENERATIONS, POPULATION, rng)
            return _rows_of(key[0], key[1], np.asarray(pdf["items"].iloc[0]), sizes, found)
        return go_on

    for epoch in range(1, epochs):
        state = materialize(state, "packing-epoch")
        elite = state.where("member = 0").withColumn("island", F.pmod(F.col("island") + 1, F.lit(islands))) \
            .withColumn("member", F.lit(POPULATION))
        state = state.unionByName(elite).groupBy("problem", "island").applyInPandas(further(epoch), _STATE)
    best = F.struct(F.array_max("bins").alias("n"), "island").alias("rank")
    return state.where("member = 0").select("*", best) \
        .groupBy("problem").agg(F.min_by(F.struct("items", "sizes", "bins"), "rank").alias("b")).select("problem", "b.*")


def pack(pieces: DataFrame, item: str = "item", length: str = "length", capacity: int = 2048,
         islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """``item, sequence_id, offset`` for every piece (``item``: unique long)."""
    spark = pieces.sparkSession
    source = pieces.select(F.col(item).cast("long").alias("item"), F.col(length).cast("int").alias("length"))
    full = source.where(F.col("length") >= capacity) \
        .select("item", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_ = source.where(F.col("length") < capacity)
    problems = max(1, -(-open_.count() // PROBLEM_ITEMS))
    # sequence_id: the round in the highest bits, then the problem, then the bin.
    placed, round_ = [full], 0
    todo = open_.withColumn("problem", F.pmod(F.xxhash64("item"), F.lit(problems)))
    while True:
        last = problems == 1
        best = materialize(_islands(todo, capacity, islands, epochs), "packing-best")
        base = (round_ << 56)

        def settle(batches: Iterator[pd.DataFrame], base=base, last=last) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for problem, items, sizes, bins in zip(pdf["problem"], pdf["items"], pdf["sizes"], pdf["bins"]):
                    items, sizes = np.asarray(items), np.asarray(sizes, dtype=np.int64)
                    bins = np.asarray(bins, dtype=np.int64)
                    order = np.lexsort((items, -sizes, bins))
                    items, sizes, bins = items[order], sizes[order], bins[order]
                    ends = np.cumsum(sizes)
                    first = np.searchsorted(bins, bins)
                    offset = ends - sizes - (ends - sizes)[first]
                    fill = np.bincount(bins, sizes)
                    spare = -1 if last else int(np.argmin(fill))
                    yield pd.DataFrame({"item": items, "sequence_id": base + (int(problem) << 24) + bins,
                                        "offset": offset, "length": sizes, "problem": problem, "spare": bins == spare})

        settled = materialize(best.mapInPandas(
            settle, "item long, sequence_id long, offset long, length int, problem long, spare boolean"), "packing-placed")
        placed.append(settled.where("NOT spare").select("item", "sequence_id", "offset"))
        if last:
            break
        problems = -(-problems // MERGED)
        todo = settled.where("spare").select("item", "length", F.pmod("problem", F.lit(problems)).alias("problem"))
        round_ += 1
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = 2048,
                   tokenizer: str | None = None) -> DataFrame:
    """``key, piece, start, length, ids_crc32, sequence_id, offset`` for every piece of every document."""
    pieces = tokenize(docs, key, text, capacity, tokenizer, keep_ids=False).drop("ids")
    pieces = materialize(pieces.withColumn("item", F.monotonically_increasing_id()), "packing-pieces")
    return pieces.join(pack(pieces, capacity=capacity), "item").drop("item")


def sequences(pieces: DataFrame, placed: DataFrame, item: str = "item") -> DataFrame:
    """``sequence_id, ids`` (little-endian unsigned 32-bit integers): the packed sequences themselves."""
    return pieces.join(placed, item).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")) \
        .select("sequence_id", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
