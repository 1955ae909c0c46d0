"""Approximate nearest neighbours with a permutation index.

``pivots`` reference vectors are drawn from a bounded sample.  A vector is represented by
its ``prefix`` nearest pivots, in order.  Index blocks of a bounded number of
vectors each hold the pivot inverted files of their vectors: for every pivot the
vectors that have it and at which place.  A query walks the files of its own
nearest pivots, which gives the footrule distance to every posted vector,

    prefix * (prefix + 1) - 2 * sum over shared pivots of min(prefix - i, prefix - j),

with i and j the pivot's places in the two representations (a missing pivot is
at place ``prefix``).  The ``rerank`` share of the block with the least distance,
all that tie with the last included, is ranked by cosine.

Queries go against all index blocks, in blocks; a task holds one pair of blocks.
Equal vectors are indexed once, with their smallest keys, so a vector that a
third of all rows share costs one entry and none of its copies is lost.

The number of blocks grows with the input and so does the work of a query; the
footrule walk is about ``prefix / pivots`` of ``prefix`` additions per vector, and ``rerank``
of the vectors are read at full length.  ``recall`` measures against brute force.

Each length of the queries' vectors has pivots and an index of its own, built one
after the other; vectors of other lengths can't be compared.

Defined results: vectors that are NULL, zero or hold NULL or non-finite
components take no part; repeated rows count once per key; empty tables give empty results; with
fewer candidates than asked for, all are returned.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.common import materialize
from tradewind.llm.vectors import cosines, unit, usable

#: Pivots and places kept; the share of a block that is reranked, and its least number of rows.
PIVOTS, PREFIX, RERANK, RERANK_ROWS = 256, 64, 0.15, 256
#: Rows of an index block and of a query block.
BLOCK, QUERY_BLOCK = 4096, 4096
#: Vectors that are candidates for pivots.
SAMPLE = 4096


def choose_pivots(vectors: DataFrame, count: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """Pivots from at most ``sample`` vectors chosen by hash, spread by farthest-first order."""
    place = F.xxhash64(F.lit("pivot"), "vector")
    rows = vectors.orderBy(place, "vector").limit(sample).select("vector").collect()
    if not rows:
        return np.zeros((0, 0))
    pool = unit(np.array([r["vector"] for r in rows]))
    chosen, nearest = [0], pool @ pool[0]
    while len(chosen) < min(count, len(pool)):
        nxt = int(np.argmin(nearest))
        chosen.append(nxt)
        nearest = np.maximum(nearest, pool @ pool[nxt])
    return pool[chosen]


def permutations(rows: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """(rows, prefix): the nearest pivots of each row, nearest first."""
    prefix = min(prefix, len(pivots))
    sims = unit(rows) @ pivots.T
    part = np.argpartition(-sims, prefix - 1, axis=1)[:, :prefix]
    order = np.argsort(-np.take_along_axis(sims, part, axis=1), axis=1, kind="stable")
    return np.take_along_axis(part, order, axis=1).astype(np.int16)


class InvertedFiles:
    """The postings of a block: per pivot the rows that have it among their nearest, and its place there."""

    def __init__(self, perms: np.ndarray, pivots: int):
        n, self.prefix = perms.shape
        flat = perms.ravel()
        order = np.argsort(flat, kind="stable")
        self.rows, self.places = order // self.prefix, order % self.prefix
        self.starts = np.searchsorted(flat[order], np.arange(pivots + 1))
        self.n = n

    def footrule(self, query: np.ndarray) -> np.ndarray:
        """Distances of one query's representation to all rows."""
        k = self.prefix
        shared = np.zeros(self.n, dtype=np.int32)
        for i, p in enumerate(query.tolist()):
            own = slice(self.starts[p], self.starts[p + 1])
            shared[self.rows[own]] += np.minimum(k - i, k - self.places[own])
        return k * (k + 1) - 2 * shared


def _classes(vectors: DataFrame, keep: int) -> DataFrame:
    """Distinct vectors with their ``keep`` smallest keys, ascending."""
    # Equal numbers may differ in the sign of zero: they are brought to one form before grouping.
    plain = vectors.select("key", F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector")).distinct()
    # A rank with a limit is cut to ``keep`` rows of a vector in every task before rows move.
    first = F.row_number().over(Window.partitionBy("vector").orderBy("key"))
    least = plain.withColumn("r", first).where(F.col("r") <= keep)
    return least.groupBy("vector").agg(F.array_sort(F.collect_list("key")).alias("keys"))


def search(embeddings: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", vector: str = "embedding",
           pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, key, score``: for each row of ``queries`` its nearest rows of ``embeddings``
    (other than those with its own key), nearest first, ties to the smaller key."""
    rows, asked = usable(embeddings, key, vector), usable(queries, key, vector)
    widths = sorted(r["d"] for r in asked.groupBy(F.size("vector").alias("d")).count().collect())
    found = [_search(rows.where(F.size("vector") == d), asked.where(F.size("vector") == d), k, pivots, prefix, rerank, block)
             for d in widths]
    if not found:
        found = [embeddings.sparkSession.createDataFrame([], "query_id long, rank int, key long, score double")]
    return functools.reduce(DataFrame.unionByName, found).withColumnRenamed("key", key)


def _search(rows: DataFrame, queries: DataFrame, k: int, pivots: int, prefix: int, rerank: float, block: int) -> DataFrame:
    """``query_id, rank, key, score`` among vectors of one length."""
    classes = materialize(_classes(rows, k + 1), "ann-classes")
    points = choose_pivots(classes, pivots)
    own_prefix = min(prefix, len(points))

    def blocks(df: DataFrame, size: int, name: str, *by: str) -> tuple[DataFrame, int]:
        n = max(1, -(-df.count() // size))
        return df.withColumn(name, F.pmod(F.xxhash64(F.lit(name), *by), F.lit(n)).cast("int")), n

    index, shards = blocks(classes, block, "shard", "vector")
    # By key as well: queries that share a vector are spread over the blocks.
    asked, parts = blocks(queries.distinct(), QUERY_BLOCK, "part", "key", "vector")
    side = index.select("shard", "keys", F.lit(None).cast("long").alias("query_id"), "vector")
    asks = asked.select("part", F.col("key").alias("query_id"), "vector")

    def represent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                m = np.stack(pdf["vector"].to_numpy())
                perms = permutations(m, points, own_prefix)
                yield pdf.assign(perm=[p.tobytes() for p in perms], vector=[v.tobytes() for v in m])

    coded = materialize(side.mapInPandas(
        represent, "shard int, keys array<long>, query_id long, vector binary, perm binary"), "ann-index")
    coded_asks = materialize(asks.mapInPandas(
        represent, "part int, query_id long, vector binary, perm binary"), "ann-queries")
    # Every index block meets every query block: each side is copied once per block of the other.
    left = coded.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = coded_asks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def compare(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "key": [], "score": []}
        if len(mine) and len(theirs):
            matrix = lambda col, kind: np.stack([np.frombuffer(v, dtype=kind) for v in col])
            mine = mine.sort_values("vector", ignore_index=True)
            base, perms = matrix(mine["vector"], np.float64), matrix(mine["perm"], np.int16)
            keys = mine["keys"].tolist()
            files = InvertedFiles(perms, len(points))
            most = min(len(base), max(4 * k, RERANK_ROWS, int(np.ceil(rerank * len(base)))))
            for q, v, p in zip(theirs["query_id"], theirs["vector"], theirs["perm"]):
                distance = files.footrule(np.frombuffer(p, dtype=np.int16))
                last = np.partition(distance, most - 1)[most - 1]
                near = np.flatnonzero(distance <= last)
                score = cosines(np.broadcast_to(np.frombuffer(v, dtype=np.float64), base[near].shape), base[near])
                # A class gives k rows at most, and k + 1 classes are enough, since one may be the query's own;
                # classes that tie with the last of them stay.
                edge = np.partition(score, max(0, len(score) - k - 1))[max(0, len(score) - k - 1)]
                best = [(-s, int(x)) for s, i in zip(score.tolist(), near) if s >= edge for x in keys[i] if x != q]
                for s, x in sorted(best)[:k]:
                    out["query_id"].append(q)
                    out["key"].append(x)
                    out["score"].append(-s)
        return pd.DataFrame(out)

    found = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")) \
        .applyInPandas(compare, "query_id long, key long, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "key")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "key", "score")


def brute_force(vectors: dict[int, list[float]], query: int, k: int = 5) -> list[tuple[int, float]]:
    """The exact neighbours of one of some vectors on the driver: for audits of chosen queries and for tests."""
    ids = np.array([i for i in sorted(vectors) if i != query])
    if not len(ids):
        return []
    score = cosines(np.broadcast_to(np.array(vectors[query]), (len(ids), len(vectors[query]))),
                    np.array([vectors[i] for i in ids.tolist()]))
    order = np.lexsort((ids, -score))[:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def recall(found: DataFrame, embeddings: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id",
           vector: str = "embedding", block: int = 1 << 14) -> float:
    """The share of true neighbours (by brute force over all rows, in blocks) that ``found`` has.

    The audited ``queries`` are held by every task, so pass a bounded number of them.
    """
    asked = [(r["key"], r["vector"]) for r in usable(queries, key, vector).collect()]
    if not asked:
        return 1.0
    if len({len(v) for _, v in asked}) > 1:
        raise ValueError("audit the queries of one vector length at a time")
    ids, q = np.array([a for a, _ in asked]), unit(np.array([v for _, v in asked]))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            sims = q @ unit(np.stack(pdf["vector"].to_numpy())).T
            sims[ids[:, None] == pdf["key"].to_numpy()[None, :]] = -2
            best = np.sort(sims, axis=1)[:, ::-1][:, :k]
            yield pd.DataFrame({"query_id": np.repeat(ids, best.shape[1]), "s": best.ravel()}).query("s > -2")

    exact = usable(embeddings, key, vector).where(F.size("vector") == q.shape[1]).mapInPandas(scan, "query_id long, s double")
    order = Window.partitionBy("query_id").orderBy(F.col("s").desc())
    kth = exact.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k) \
        .groupBy("query_id").agg(F.min("s").alias("kth"), F.count("*").alias("n"))
    hit = found.join(kth, "query_id").where(F.col("score") >= F.col("kth") - 1e-12).count()
    return hit / max(1, kth.agg(F.sum("n")).first()[0] or 0)
