"""Interpolated modified Kneser-Ney bigram model, counted in Spark.

A model is a folder of sorted arrays in the cluster's shared storage:

* the vocabulary: 64-bit word hashes in ascending order, with counts.  A word's id
  is its place in that order;
* bigrams: packed pairs (context id, word id) in ascending order, with counts;
* per context the numbers of words that follow it once, twice and more often; per
  word its number of distinct contexts (the continuation count).

Workers map the arrays into memory and look n-grams up by binary search; pages are
read as needed and shared by the workers of a machine, so scoring needs no
copy of the model in any heap.  Where the shared storage is not a file system that
workers see, they fetch the files once into their own temporary folder.

Counting moves packed binary blocks, sorted and delta-coded, that each task has
summed up before: word counts by hash range, then bigrams by range of the context.
Contexts with more than half a shard's share of all tokens are spread over
all shards by the following word.  Shards grow in number with the text, and a task sums up
the blocks of one shard as they arrive, so it holds the shard's distinct words or bigrams
and a bounded number of block entries, however many blocks there are.  Files are
written under a temporary name and moved, so a repeated task does no harm.

The probability of word w after context a, with discounts D of three sizes from
the counts of counts at each level:

    p(w | a) = (c(a w) - D(c(a w))) / c(a) + g(a) * p(w)
    p(w)     = (k(w) - D'(k(w))) / K + g' / (V + 1)

where k is the continuation count and K its sum; g and g' give the discounted
mass to the lower level; V + 1 counts the distinct tokens and the unknown one.
An unknown context passes all to p(w).

Defined results: a NULL text is the empty text, which is the end token alone;
repeated rows are counted and scored each; without training texts every token has
probability 1 / (V + 1) = 1; an empty table gives an empty result.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import batches_of, materialize, shared_path, shuffle_partitions

#: Distinct words, and bigram occurrences, that a task holds before it passes them on.
HELD_WORDS, HELD_BIGRAMS = 500_000, 1 << 22
#: Text bytes per shard of the vocabulary; block entries that a task holds before it sums them up.
VOCABULARY_BYTES, HELD_ENTRIES = 1 << 30, 1 << 22
#: Tokens per shard of bigrams; words that a worker remembers; tokens looked up at once.
SHARD_TOKENS, KNOWN_WORDS, TOGETHER = 1 << 22, 400_000, 1 << 19

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_END = b""                                    # no word is empty


def words_of(text: str | None) -> list[bytes]:
    """Words, split at ASCII white space, A-Z in lower case, and the end."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() + [_END]


# --- files ------------------------------------------------------------------

def _filesystem(uri: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _write(folder: str, name: str, values: np.ndarray) -> None:
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)
    data = io.BytesIO()
    np.save(data, values, allow_pickle=False)
    hidden = f"{root}/.{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(hidden) as out:
        out.write(data.getvalue())
    store.move(hidden, f"{root}/{name}.npy")


@lru_cache(maxsize=4096)
def _mapped(folder: str, name: str) -> np.ndarray:
    from pyarrow import fs
    store, root = _filesystem(folder)
    path = f"{root}/{name}.npy"
    if not isinstance(store, fs.LocalFileSystem):
        own = tempfile.mkdtemp(prefix="kneser-ney-")
        fs.copy_files(path, f"{own}/a.npy", source_filesystem=store, destination_filesystem=fs.LocalFileSystem())
        path = f"{own}/a.npy"
        found = np.load(path, mmap_mode="r")
        os.unlink(path)                       # the mapping keeps the data; nothing is left behind
        os.rmdir(own)
        return found
    return np.load(path, mmap_mode="r")


def _packed(values: np.ndarray, sorted_: bool) -> bytes:
    """Byte planes of the values, or of their differences, compressed."""
    kept = np.diff(values, prepend=values.dtype.type(0)) if sorted_ else values
    return zlib.compress(np.ascontiguousarray(kept).view(np.uint8).reshape(len(kept), -1).T.tobytes(), 1)


def _unpacked(data: bytes, kind: str, sorted_: bool) -> np.ndarray:
    width = np.dtype(kind).itemsize
    values = np.ascontiguousarray(np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(width, -1).T).view(kind)[:, 0]
    return np.cumsum(values, dtype=kind) if sorted_ else values


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    return key[first], np.add.reduceat(count, first) if len(first) else count


# --- the vocabulary ---------------------------------------------------------

def _hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 0)


def _count_words(docs: DataFrame, bits: int) -> DataFrame:
    """``shard, keys, counts``: packed word hashes by their highest bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

        def rows():
            held: Counter = Counter()
            for b in batches:
                for t in b.column("text"):
                    held.update(words_of(t.as_py()))
                    if len(held) > HELD_WORDS:
                        yield from flush(held)
                        held.clear()
            yield from flush(held)

        def flush(held: Counter):
            if not held:
                return
            key, count = _summed([np.fromiter(map(_hash, held), np.uint64, len(held))],
                                 [np.fromiter(held.values(), np.int64, len(held))])
            cuts = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
            for s in range(1 << bits):
                own = slice(cuts[s], cuts[s + 1])
                if cuts[s] < cuts[s + 1]:
                    yield s, _packed(key[own], True), _packed(count[own].astype(np.uint32), False)

        yield from batches_of(rows(), schema)

    return docs.select("text").mapInArrow(run, "shard int, keys binary, counts binary")


def _gather(parts: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray]:
    """The sum of packed blocks.  It is brought up to date whenever the waiting entries outgrow it, so
    about as many entries are held as it has distinct keys, and each is sorted a few times only."""
    keys, counts = [np.zeros(0, dtype="<u8")], [np.zeros(0, dtype=np.int64)]
    summed = waiting = 0
    for pdf in parts:
        for k, c in zip(pdf["keys"], pdf["counts"]):
            keys.append(_unpacked(k, "<u8", True))
            counts.append(_unpacked(c, "<u4", False))
            waiting += len(keys[-1])
            if waiting > max(HELD_ENTRIES, summed):
                key, count = _summed(keys, counts)
                keys, counts, summed, waiting = [key], [count], len(key), 0
    return _summed(keys, counts)


@dataclass(frozen=True)
class Vocabulary:
    """Ids of words; a worker remembers the words it has met."""

    folder: str
    bits: int
    starts: tuple[int, ...]                   # first id of each shard, then the number of words
    tokens: int

    @property
    def size(self) -> int:
        return self.starts[-1]

    def ids(self, words: list[bytes], known: dict[bytes, int]) -> np.ndarray:
        """Ids; the number of words stands for an unknown one."""
        fresh = set(words).difference(known)
        if fresh:
            if len(known) > KNOWN_WORDS:
                known.clear()
                fresh = set(words)
            fresh = list(fresh)
            hashes = np.fromiter(map(_hash, fresh), np.uint64, len(fresh))
            known.update(zip(fresh, self._search(hashes).tolist()))
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _search(self, hashes: np.ndarray) -> np.ndarray:
        order = np.argsort(hashes)
        asked = hashes[order]
        found = np.full(len(asked), self.size, dtype=np.int64)
        cuts = np.searchsorted(asked >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
            if self.starts[s] == self.starts[s + 1]:
                continue
            table, own = _mapped(self.folder, f"words-{s}"), slice(cuts[s], cuts[s + 1])
            at = np.minimum(np.searchsorted(table, asked[own]), len(table) - 1)
            found[own] = np.where(table[at] == asked[own], at + self.starts[s], self.size)
        out = np.empty_like(found)
        out[order] = found
        return out


def _dense(folder: str, name: str, starts: tuple[int, ...], ids: np.ndarray, width: int = 0) -> np.ndarray:
    """Values of arrays that are kept per range of ids; ids at the end of the last range have value 0."""
    out = np.zeros((len(ids), width) if width else len(ids), dtype=np.int64)
    shard = np.searchsorted(np.asarray(starts), ids, side="right") - 1
    for s in np.unique(shard).tolist():
        if s < len(starts) - 1:
            own = shard == s
            out[own] = _mapped(folder, f"{name}-{s}")[ids[own] - starts[s]]
    return out


def _vocabulary(docs: DataFrame, folder: str, bits: int) -> Vocabulary:
    def merge(key: tuple[Any, ...], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, counts = _gather(parts)
        _write(folder, f"words-{key[0]}", words)
        _write(folder, f"counts-{key[0]}", counts)
        yield pd.DataFrame({"shard": [key[0]], "n": [len(words)], "tokens": [int(counts.sum())]})

    sizes = _count_words(docs, bits).groupBy("shard").applyInPandas(merge, "shard int, n long, tokens long").collect()
    by = {r["shard"]: r["n"] for r in sizes}
    starts = tuple(np.concatenate(([0], np.cumsum([by.get(s, 0) for s in range(1 << bits)]))).tolist())
    if starts[-1] >= (1 << 32) - 1:
        raise ValueError("more than 2^32 distinct words: pairs of ids no longer fit 64 bits")
    return Vocabulary(folder, bits, starts, sum(r["tokens"] for r in sizes))


# --- bigrams ----------------------------------------------------------------

def discounts(counts_of_counts: list[int]) -> tuple[float, float, float]:
    """Discounts of counts 1, 2 and 3 or more; 0.75 where too few counts are known to estimate them."""
    n = counts_of_counts
    if not all(n[:4]):
        return 0.75, 0.75, 0.75
    y = n[0] / (n[0] + 2 * n[1])
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return tuple(d if 0 < d < i + 1 else 0.75 for i, d in enumerate(found))


@dataclass(frozen=True)
class Model:
    folder: str
    words: Vocabulary
    shards: int
    docs: int                                 # the count of the begin context, whose id is words.size
    hot: tuple[tuple[int, int, int, int], ...]   # contexts spread by word: id, words once, twice, more often
    lower: tuple[float, float, float]         # discounts of continuation counts
    upper: tuple[float, float, float]         # discounts of bigram counts
    types: int                                # distinct bigrams
    lower_mass: float                         # mass that p(w) gives to the uniform distribution


def _shard_of(context: np.ndarray, word: np.ndarray, hot: np.ndarray, size: int, shards: int) -> np.ndarray:
    at = np.where(np.isin(context, hot), word, context)
    return at * shards // (size + 1)


def _range_starts(size: int, shards: int) -> tuple[int, ...]:
    """First id of each shard's range, then the number of ids (words and the begin context)."""
    return tuple(-(-s * (size + 1) // shards) for s in range(shards)) + (size + 1,)


def _pairs(texts: list[str | None], words: Vocabulary, known: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, words and text numbers of all tokens."""
    lists = [words_of(t) for t in texts]
    ids = words.ids([w for own in lists for w in own], known)
    lengths = np.array([len(own) for own in lists])
    context = np.concatenate(([words.size], ids[:-1])) if len(ids) else ids
    context[np.concatenate(([0], np.cumsum(lengths)[:-1]))] = words.size
    return context, ids, np.repeat(np.arange(len(texts)), lengths)


def _text_groups(column: pa.Array) -> Iterator[list[str | None]]:
    held, size = [], 0
    for t in column.to_pylist():
        held.append(t)
        size += len(t or "")
        if size > 4 * TOGETHER:
            yield held
            held, size = [], 0
    if held:
        yield held


def _count_bigrams(docs: DataFrame, words: Vocabulary, hot: np.ndarray, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])

        def rows():
            known, held, n = {}, [], 0
            for b in batches:
                for texts in _text_groups(b.column("text")):
                    context, word, _ = _pairs(texts, words, known)
                    held.append((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64))
                    n += len(word)
                    if n > HELD_BIGRAMS:
                        yield from flush(held)
                        held, n = [], 0
            yield from flush(held)

        def flush(held: list):
            if not held:
                return
            key, count = np.unique(np.concatenate(held), return_counts=True)
            shard = _shard_of((key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64),
                              hot, words.size, shards)
            order = np.argsort(shard, kind="stable")
            key, count, cuts = key[order], count[order], np.searchsorted(shard[order], np.arange(shards + 1))
            for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                own = slice(cuts[s], cuts[s + 1])
                yield s, _packed(key[own], True), _packed(count[own].astype(np.uint32), False)

        yield from batches_of(rows(), schema)

    return docs.select("text").mapInArrow(run, "shard int, keys binary, counts binary")


def train(docs: DataFrame, text: str = "text") -> Model:
    """A model of the texts of ``docs``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(text).alias("text"))
    folder = shared_path(spark, "kneser-ney")
    text_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, (shuffle_partitions(spark) - 1).bit_length(), (text_bytes // VOCABULARY_BYTES).bit_length())
    words = _vocabulary(docs, folder, bits)
    shards = 1 << max(bits, (words.tokens // SHARD_TOKENS).bit_length())
    starts = _range_starts(words.size, shards)
    edge = max(1, words.tokens // (2 * shards))

    # Contexts above half a shard's share: fewer than 2 x shards of them.
    def frequent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for s in pdf["id"].tolist():
                if words.starts[s] < words.starts[s + 1]:
                    count = _mapped(folder, f"counts-{s}")
                    at = np.flatnonzero(count > edge)
                    yield pd.DataFrame({"id": at + words.starts[s], "count": count[at]})

    # The count of the end token is the number of texts, which is also how often the begin context occurs.
    end = int(words._search(np.array([_hash(_END)], dtype=np.uint64))[0]) if words.size else 0
    texts = int(_dense(folder, "counts", words.starts, np.array([end]))[0]) if words.size else 0
    heavy = [r["id"] for r in spark.range(1 << bits).mapInPandas(frequent, "id long, count long").collect()]
    hot = np.array(sorted(heavy + ([words.size] if texts > edge else [])), dtype=np.int64)

    def merge(key: tuple[Any, ...], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = key[0]
        pairs, counts = _gather(parts)
        _write(folder, f"pairs-{s}", pairs)
        # One byte a count; larger ones are listed.
        _write(folder, f"pair-counts-{s}", np.minimum(counts, 255).astype(np.uint8))
        large = np.flatnonzero(counts >= 255)
        _write(folder, f"large-{s}", np.stack([large, counts[large]], axis=1).astype(np.int64))
        context, word = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        size_ = np.minimum(counts, 3) - 1
        spread = np.isin(context, hot)
        own = np.zeros((starts[s + 1] - starts[s], 3), dtype=np.uint32)
        np.add.at(own, (context[~spread] - starts[s], size_[~spread]), 1)
        _write(folder, f"followers-{s}", own)
        ids, n = np.unique(word, return_counts=True)
        cuts = np.searchsorted(ids, np.array(starts))
        rows = [(r, _packed(ids[a:b].astype(np.uint64), True), _packed(n[a:b].astype(np.uint32), False), "words")
                for r, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
        shares = np.zeros((len(hot), 3), dtype=np.int64)
        np.add.at(shares, (np.searchsorted(hot, context[spread]), size_[spread]), 1)
        rows.append((-1, shares.tobytes(), np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64).tobytes(), "sums"))
        yield pd.DataFrame(rows, columns=["shard", "keys", "counts", "kind"])

    merged = materialize(_count_bigrams(docs, words, hot, shards).groupBy("shard")
                         .applyInPandas(merge, "shard int, keys binary, counts binary, kind string"), "kneser-ney-sums")

    def continuations(key: tuple[Any, ...], parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, n = _gather(parts)
        own = np.zeros(starts[key[0] + 1] - starts[key[0]], dtype=np.int64)
        own[ids.astype(np.int64) - starts[key[0]]] = n
        _write(folder, f"contexts-{key[0]}", own)
        sizes = np.bincount(np.minimum(n, 5), minlength=6)[1:6]
        yield pd.DataFrame([(int(n.sum()), *sizes.tolist())], columns=["k", "n1", "n2", "n3", "n4", "more"])

    below = merged.where("kind = 'words'").groupBy("shard") \
        .applyInPandas(continuations, "k long, n1 long, n2 long, n3 long, n4 long, more long") \
        .agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("k", "n1", "n2", "n3", "n4", "more")]).first()
    held = {r["shard"] for r in merged.where("kind = 'words'").select("shard").distinct().collect()}

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shares, sizes = np.zeros((len(hot), 3), dtype=np.int64), np.zeros(4, dtype=np.int64)
        for pdf in batches:
            for a, b in zip(pdf["keys"], pdf["counts"]):
                shares += np.frombuffer(a, dtype=np.int64).reshape(-1, 3)
                sizes += np.frombuffer(b, dtype=np.int64)
        yield pd.DataFrame({"at": np.arange(-1, len(hot)), "a": [int(sizes[0]), *shares[:, 0].tolist()],
                            "b": [int(sizes[1]), *shares[:, 1].tolist()], "c": [int(sizes[2]), *shares[:, 2].tolist()],
                            "d": [int(sizes[3]), *[0] * len(hot)]})

    sums = {r["at"]: r for r in merged.where("kind = 'sums'").mapInPandas(add_up, "at long, a long, b long, c long, d long")
            .groupBy("at").agg(*[F.sum(c).alias(c) for c in "abcd"]).collect()}
    top = sums.get(-1)
    upper = discounts([top["a"], top["b"], top["c"], top["d"]] if top else [0] * 4)
    lower = discounts([below["n1"], below["n2"], below["n3"], below["n4"]])
    gone = lower[0] * below["n1"] + lower[1] * below["n2"] + lower[2] * (below["n3"] + below["n4"] + below["more"])
    for s in set(range(shards)) - held:       # ranges without any word that follows another
        _write(folder, f"contexts-{s}", np.zeros(starts[s + 1] - starts[s], dtype=np.int64))
    return Model(folder, words, shards, texts, tuple((int(h), sums[i]["a"], sums[i]["b"], sums[i]["c"])
                                                     for i, h in enumerate(hot.tolist())),
                 lower, upper, below["k"], gone / below["k"] if below["k"] else 1.0)


# --- scores -----------------------------------------------------------------

def _pair_counts(model: Model, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Counts of known pairs, 0 if unseen."""
    keys, back = np.unique((context.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64), return_inverse=True)
    hot = np.array([h[0] for h in model.hot], dtype=np.int64)
    shard = _shard_of((keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64),
                      hot, model.words.size, model.shards)
    found = np.zeros(len(keys), dtype=np.int64)
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(model.shards + 1))
    for s in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
        own = order[cuts[s]:cuts[s + 1]]
        try:
            table = _mapped(model.folder, f"pairs-{s}")
        except FileNotFoundError:             # a shard without pairs
            continue
        at = np.minimum(np.searchsorted(table, keys[own]), len(table) - 1)
        hit = table[at] == keys[own]
        count = np.where(hit, _mapped(model.folder, f"pair-counts-{s}")[at], 0).astype(np.int64)
        large = _mapped(model.folder, f"large-{s}")
        if len(large):
            place = np.minimum(np.searchsorted(large[:, 0], at), len(large) - 1)
            count = np.where((count == 255) & (large[place, 0] == at), large[place, 1], count)
        found[own] = count
    return found[back]


def probabilities(model: Model, context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """p(word | context) for arrays of ids; ``words.size`` is the unknown word, and as a context the begin.

    An unknown context is -1.
    """
    size, upper, lower = model.words.size, np.array((0, *model.upper)), np.array((0, *model.lower))
    starts = _range_starts(size, model.shards)
    p = np.full(len(word), model.lower_mass / (size + 1))
    if not model.types:
        return p
    known = word < size
    k = np.zeros(len(word), dtype=np.int64)
    k[known] = _dense(model.folder, "contexts", starts, word[known])
    p += (k - lower[np.minimum(k, 3)]) / model.types
    seen = context >= 0
    total = np.zeros(len(word), dtype=np.int64)
    ids, back = np.unique(context[seen], return_inverse=True)
    count = np.where(ids == size, model.docs, 0)
    count[ids < size] = _dense(model.folder, "counts", model.words.starts, ids[ids < size])
    followers = np.zeros((len(ids), 3), dtype=np.int64)
    hot = np.array(model.hot, dtype=np.int64).reshape(-1, 4)
    spread = np.isin(ids, hot[:, 0])
    followers[spread] = hot[np.searchsorted(hot[:, 0], ids[spread]), 1:]
    shard = np.searchsorted(np.asarray(starts), ids, side="right") - 1
    for s in np.unique(shard[~spread]).tolist():
        own = (shard == s) & ~spread
        try:
            followers[own] = _mapped(model.folder, f"followers-{s}")[ids[own] - starts[s]]
        except FileNotFoundError:
            pass
    total[seen] = count[back]
    mass = np.zeros(len(word))
    mass[seen] = (followers @ upper[1:])[back]
    use = total > 0
    c = np.zeros(len(word), dtype=np.int64)
    both = use & known
    c[both] = _pair_counts(model, context[both], word[both])
    p[use] = (c[use] - upper[np.minimum(c[use], 3)] + mass[use] * p[use]) / total[use]
    return p


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_tokens, n_known, base_score, score`` for every row: log10 probabilities under the unigram
    model with one added to every count, and under the Kneser-Ney model.

    ``10 ** (-score / n_tokens)`` is the perplexity.
    """
    source = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    key_type = source.schema["k"].dataType.simpleString()
    words = model.words

    def scored(texts: list[str | None], known: dict) -> Iterator[tuple]:
        context, word, owner = _pairs(texts, words, known)
        first = np.concatenate(([True], owner[1:] != owner[:-1]))
        context = np.where((context == words.size) & ~first, -1, context)
        count = np.zeros(len(word), dtype=np.int64)
        in_vocabulary = word < words.size
        count[in_vocabulary] = _dense(words.folder, "counts", words.starts, word[in_vocabulary])
        base = np.log10((count + 1) / (words.tokens + words.size + 1))
        own = np.log10(probabilities(model, context, word))
        n = len(texts)
        return zip(np.bincount(owner, minlength=n).tolist(), np.bincount(owner, count > 0, n).astype(int).tolist(),
                   np.bincount(owner, base, n).tolist(), np.bincount(owner, own, n).tolist())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = {}
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                                ("base_score", pa.float64()), ("score", pa.float64())])

            def rows():
                keys = iter(b.column("k").to_pylist())
                for texts in _text_groups(b.column("t")):
                    for r in scored(texts, known):
                        yield next(keys), *r

            yield from batches_of(rows(), schema)

    return source.mapInArrow(run, f"k {key_type}, n_tokens long, n_known long, base_score double, score double") \
        .withColumnRenamed("k", key)
