"""Embedding near-duplicates by NN-descent.

Within each label, every distinct vector keeps a list of its ``K`` nearest others:

1. Lists start from buckets of random-hyperplane codes, about ``BUCKET`` vectors each.
   Codes grow with the label's size; so many tables of them are made that a pair at the
   threshold shares a bucket with chance ``START``, however long they are.
2. NN-descent: the members of a node's list and the nodes that list it are
   compared with one another (neighbours of neighbours), and lists keep the
   nearest.  Pairs that were compared before are not compared again: one of the
   two must be new to the node.  Rounds end when few lists change and no link joined
   two components.
   A list has ``K`` places for links (pairs within the threshold) and ``K`` for the
   nearest others, so links never push out the rest.  Links join components whether
   lists have a place for them or not: every comparison yields a spanning forest of
   the links it sees, and ``components.py`` joins these.
3. A list is saturated if its places for links are full: more may be.  Lists that grew
   until they are not would be quadratic in a large group, so the list is enlarged to
   the node's whole component: all its members are compared with
   all nodes outside that list one of them or are listed by one, in cells of bounded size,
   until no link is new and few lists change.  At last each pair of a component is compared
   exactly once and adds to the two nodes' numbers of links; the pairs themselves
   are never written.  Numbers of links are thus exact within components.
4. Audit: random nodes are compared with all others of their labels, until ``LINKED``
   nodes that have links were met, or ``MOST_AUDITED`` nodes (or all) were asked; its work thus grows with
   the table, not with its square, also where links are rare.  If less than ``RECALL`` of those met have all
   of their links, further tables and rounds are made, ``ATTEMPTS`` times; after that all pairs of each
   label are compared, in cells, which is quadratic but misses nothing.

Hot buckets, much-listed nodes and large components are cut into cells
(``cells.py``); in 3, cells that pair members with nodes outside.  Vectors of 32-bit
components move as these and are scaled in the tasks, in double precision.  Equal vectors are one node with a multiplicity, so a vector that
a third of all rows share is one node and its copies are counted, not compared.

Defined results: NULL labels and vectors that are NULL, zero or hold NULL or
non-finite components link with nothing, nor do vectors of unequal length; of a
``vec_id`` with several different vectors the smallest (label, vector) counts for
all its rows; repeated rows each get the result; a NULL ``vec_id`` links with
nothing and is kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.llm.cells import with_cells, with_facing_cells
from tradewind.llm.common import materialize
from tradewind.llm.components import components
from tradewind.llm.vectors import cosines, unit, usable

#: Links of a list, and other neighbours; vectors of a bucket; rows of a chunk.
K, BUCKET, CHUNK = 8, 128, 512
#: The chance that a pair at the threshold meets in a start bucket; the share of list entries that must change for another round.
START, CHANGED = 0.9, 0.01
#: The audit: nodes compared with all others at first, at a time and at most, nodes with links to meet, the share of
#: these that must have all their links, further attempts.
AUDITED, AT_ONCE, MOST_AUDITED, LINKED, RECALL, ATTEMPTS = 256, 8_192, 65_536, 300, 0.99, 2

_CELL = ["cell_a", "cell_b"]


def _similar(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Cosines of unit rows; values at the threshold are computed pair by pair."""
    sims = a @ b.T
    i, j = np.nonzero(np.abs(sims - threshold) < 1e-9)
    if len(i):
        sims[i, j] = cosines(a[i], b[j])
    return sims


def _nodes(rows: DataFrame) -> DataFrame:
    """``node, grp, copies, vector``: distinct vectors of a label; the node is the smallest key."""
    one = rows.groupBy("key").agg(F.min(F.struct("label", "vector")).alias("r")).select("key", "r.*")
    return one.groupBy("label", "vector").agg(F.min("key").alias("node"), F.count("*").alias("copies")) \
        .select("node", F.concat_ws(":", F.col("label").cast("string"), F.size("vector").cast("string")).alias("grp"),
                "copies", "vector")


def _packed(vector: np.ndarray, short: bool) -> bytes:
    """A vector as ``_matrix`` reads it: a mark and its 32-bit components, or the 64-bit ones of its unit vector."""
    if short:
        return b"f" + np.asarray(vector, dtype=np.float32).tobytes()
    return unit(np.asarray(vector, dtype=np.float64)[None, :])[0].tobytes()


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows of packed vectors, which are alike in kind; an odd number of bytes tells the mark."""
    if len(vectors.iloc[0]) % 2:
        return unit(np.stack([np.frombuffer(v, dtype=np.float32, offset=1) for v in vectors]).astype(np.float64))
    return np.stack([np.frombuffer(v, dtype=np.float64) for v in vectors])


def _cell_runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The cells of a partition that is sorted by ``keys``, also those that batches cut."""
    held = None
    for pdf in batches:
        if held is not None:
            pdf = pd.concat([held, pdf], ignore_index=True)
        if not len(pdf):
            continue
        ids = pdf[keys]
        cuts = np.flatnonzero((ids.to_numpy()[1:] != ids.to_numpy()[:-1]).any(axis=1)) + 1
        edges = [0, *cuts.tolist()]
        for lo, hi in zip(edges, edges[1:]):
            yield pdf.iloc[lo:hi]
        held = pdf.iloc[edges[-1]:]
    if held is not None and len(held):
        yield held


def _stars(hit: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A row of each component of the links ``hit``, and the component's other rows."""
    hit = hit | hit.T
    left = hit.any(axis=1)
    while left.any():
        first = int(np.argmax(left))
        seen = np.zeros(len(hit), dtype=bool)
        seen[first] = True
        front = np.array([first])
        while len(front):
            reached = hit[front].any(axis=0) & ~seen
            seen |= reached
            front = np.flatnonzero(reached)
        left &= ~seen
        seen[first] = False
        yield first, np.flatnonzero(seen)


def _compared(cells: DataFrame, keys: list[str], k: int, threshold: float, facing: bool = False) -> DataFrame:
    """``u, v, sim, link``: for each row of a cell its best partners there, links and others, if better than
    its list's last; and, with NULL ``sim``, a spanning forest of all links of the cell, ``link`` being true.

    Rows have ``node, vector, last_link, last, fresh, side``; a pair needs one fresh row and two sides.
    The cells are those of ``with_facing_cells`` if ``facing``, else those of ``with_cells``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        us, vs, ss, held = [], [], [], 0

        def add(u, v, s):
            nonlocal held
            us.append(u)
            vs.append(v)
            ss.append(s)
            held += len(u)

        def out():
            sim = np.concatenate(ss)
            return pd.DataFrame({"u": np.concatenate(us), "v": np.concatenate(vs), "sim": sim, "link": np.isnan(sim)})

        for cell in _cell_runs(batches, [*keys, *_CELL]):
            if len(cell) < 2:
                continue
            node, side, fresh = cell["node"].to_numpy(), cell["side"].to_numpy(), cell["fresh"].to_numpy(dtype=bool)
            m = _matrix(cell["vector"])
            if facing:
                left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
                across = _similar(m[left], m[right], threshold)
                across[~(fresh[left][:, None] | fresh[right][None, :])] = -2
                sims = np.full((len(cell), len(cell)), -2.0)
                sims[np.ix_(left, right)] = across
                sims[np.ix_(right, left)] = across.T
            else:
                sims = _similar(m, m, threshold)
                own, a, b = cell["own"].to_numpy(), int(cell["cell_a"].iloc[0]), int(cell["cell_b"].iloc[0])
                off = (side[:, None] == side[None, :]) | ~(fresh[:, None] | fresh[None, :])
                if a != b:
                    off |= own[:, None] == own[None, :]       # pairs of one chunk meet in a cell of their own
                sims[off] = -2
            hit = sims >= threshold
            for first, rest in _stars(hit):
                add(node[rest], np.full(len(rest), node[first]), np.full(len(rest), np.nan))
            for kind, last in ((hit, "last_link"), (~hit, "last")):
                wanted = np.where(kind & (sims > cell[last].to_numpy()[:, None]), sims, -2)
                if not (wanted > -2).any():
                    continue
                best = np.argpartition(-wanted, min(k, len(cell)) - 1, axis=1)[:, :k]
                s = np.take_along_axis(wanted, best, axis=1)
                i, j = np.nonzero(s > -2)
                add(node[i], node[best[i, j]], s[i, j])
            if held > 100_000:
                yield out()
                us, vs, ss, held = [], [], [], 0
        if held:
            yield out()

    rows = cells.select(*keys, *_CELL, "own", "node", "vector", "last_link", "last", "fresh", "side")
    return rows.repartition(*keys, *_CELL).sortWithinPartitions(*keys, *_CELL) \
        .mapInPandas(run, "u long, v long, sim double, link boolean")


def _lists(found: DataFrame, old: DataFrame | None, k: int, threshold: float) -> DataFrame:
    """``u, v, sim, fresh``: the ``k`` nearest links and others of each node among the old list and what was found."""
    pairs = found.where("NOT link").select("u", "v", "sim").withColumn("fresh", F.lit(True))
    if old is not None:
        pairs = pairs.unionByName(old.select("u", "v", "sim").withColumn("fresh", F.lit(False)))
    pairs = pairs.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u", F.col("sim") >= threshold).orderBy(F.col("sim").desc(), "v")
    return pairs.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k).drop("r")


def _with_last(rows: DataFrame, lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """``rows`` with the last similarity of the node's full lists, -1.5 for lists that have room."""
    full = lambda kind: F.when(F.count(F.when(kind, 1)) >= k, F.min(F.when(kind, F.col("sim")))).otherwise(-1.5)
    link = F.col("sim") >= threshold
    last = lists.groupBy(F.col("u").alias("node")).agg(full(link).alias("last_link"), full(~link).alias("last"))
    return rows.join(last, "node", "left").fillna(-1.5, ["last_link", "last"])


def _joined(parts: DataFrame, found: DataFrame) -> tuple[DataFrame, bool]:
    """``node, component`` after the links of ``found``, and whether any of them joined two components."""
    u, v = (parts.select(F.col("node").alias(c), F.col("component").alias(f"{c}_component")) for c in "uv")
    across = found.where("link").select("u", "v").join(u, "u").join(v, "v") \
        .select(F.col("u_component").alias("u"), F.col("v_component").alias("v")).where("u <> v").distinct()
    across = materialize(across, "nn-across")
    if across.isEmpty():
        return parts, False
    moved = components(across).select(F.col("node").alias("component"), F.col("component").alias("to"))
    parts = parts.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    return materialize(parts, "nn-components"), True


def _tables(bits: int, threshold: float) -> int:
    """Tables of codes of so many bits for a pair at the threshold to share a bucket with chance ``START``."""
    same = max(0.5, 1 - np.arccos(np.clip(threshold, -1, 1)) / np.pi) ** bits
    return 1 if same >= START else int(np.ceil(np.log1p(-START) / np.log1p(-same)))


def _start(nodes: DataFrame, width: int, k: int, threshold: float, seed: int) -> DataFrame:
    """Candidates from the buckets of random-hyperplane codes."""
    sizes = nodes.groupBy("grp").agg(F.count("*").alias("n"))
    bits = F.least(F.lit(40), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BUCKET)))).cast("int")
    needed = np.array([_tables(b, threshold) for b in range(41)])
    most = sizes.agg(F.max(bits)).first()[0] or 0
    rng = np.random.default_rng(seed)
    planes = rng.normal(size=(int(needed[most]), most, width))

    def codes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            m = _matrix(pdf["vector"])
            wide = np.zeros((len(m), width))
            wide[:, :m.shape[1]] = m[:, :width]
            own = pdf["bits"].to_numpy()
            for t in range(int(needed[own].max())):
                # Above the label's number of bits all codes are 0.
                signs = (wide @ planes[t].T > 0) & (np.arange(most)[None, :] < own[:, None])
                coded = pd.DataFrame({"grp": pdf["grp"], "node": pdf["node"], "vector": pdf["vector"],
                                      "bucket": t * (1 << 40) + signs @ (1 << np.arange(most, dtype=np.int64))})
                yield coded[needed[own] > t]

    def by_width(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, part in pdf.groupby(pdf["vector"].str.len()):
                yield from codes(iter([part]))

    coded = nodes.join(sizes, "grp").select("grp", "node", "vector", bits.alias("bits")) \
        .mapInPandas(by_width, "grp string, node long, vector binary, bucket long")
    cells = with_cells(coded, ["grp", "bucket"], "node", CHUNK) \
        .withColumns({"last_link": F.lit(-1.5), "last": F.lit(-1.5), "fresh": F.lit(True), "side": F.col("node")})
    return _compared(cells, ["grp", "bucket"], k, threshold)


def _round(lists: DataFrame, nodes: DataFrame, k: int, threshold: float) -> DataFrame:
    """Candidates among the neighbours of each node, in both directions."""
    near = lists.select(F.col("u").alias("w"), F.col("v").alias("node"), "fresh")
    back = lists.select(F.col("v").alias("w"), F.col("u").alias("node"), "fresh")
    self_ = lists.select(F.col("u").alias("w"), F.col("u").alias("node"), F.lit(False).alias("fresh"))
    members = near.unionByName(back).unionByName(self_).groupBy("w", "node").agg(F.max("fresh").alias("fresh"))
    busy = members.groupBy("w").agg(F.max("fresh").alias("any")).where("any").select("w")
    known = _with_last(nodes.select("node", "vector", F.col("node").alias("side")), lists, k, threshold)
    cells = with_cells(members.join(busy, "w", "left_semi"), ["w"], "node", CHUNK)
    return _compared(cells.join(known, "node"), ["w"], k, threshold)


def neighbour_lists(nodes: DataFrame, parts: DataFrame, width: int, threshold: float, k: int = K, seed: int = 0,
                    lists: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``u, v, sim, fresh``, the lists of all nodes that have any neighbour; and the components after all links found."""
    total = max(1, nodes.count() * k)
    found = materialize(_start(nodes, width, k, threshold, seed), "nn-found")
    lists = materialize(_lists(found, lists, k, threshold), "nn-lists")
    parts, _ = _joined(parts, found)
    while True:
        found = materialize(_round(lists, nodes, k, threshold), "nn-found")
        lists = materialize(_lists(found, lists, k, threshold), "nn-lists")
        parts, joined = _joined(parts, found)
        if not joined and lists.where("fresh").count() < CHANGED * total:
            return lists, parts


def _beside(lists: DataFrame, parts: DataFrame, k: int, threshold: float) -> DataFrame:
    """``w, node, side``: the components ``w`` that hold a saturated list: their members (side 0), and the nodes
    of other components that are listed by a member or list one (side 1)."""
    full = lists.where(F.col("sim") >= threshold).groupBy(F.col("u").alias("node")).agg(F.count("*").alias("n")) \
        .where(F.col("n") >= k)
    wide = full.join(parts, "node").select(F.col("component").alias("w")).distinct()
    of = parts.select(F.col("node").alias("u"), F.col("component").alias("w"))
    to = parts.select(F.col("node").alias("v"), F.col("component").alias("c"))
    ends = lists.select("u", "v").join(of, "u").join(to, "v").where("w <> c")
    outside = ends.select("w", F.col("v").alias("node")).unionByName(ends.select(F.col("c").alias("w"), F.col("u").alias("node")))
    return parts.select(F.col("component").alias("w"), "node", F.lit(0).cast("long").alias("side")) \
        .unionByName(outside.distinct().withColumn("side", F.lit(1).cast("long"))).join(wide, "w", "left_semi")


def enlarged(nodes: DataFrame, lists: DataFrame, parts: DataFrame, threshold: float,
             k: int = K) -> tuple[DataFrame, DataFrame]:
    """Lists and components after saturated lists were enlarged to their components until no link is new
    and few lists change."""
    seen, entries = None, max(1, lists.count())
    while True:
        rows = materialize(_beside(lists, parts, k, threshold), "nn-beside")
        if seen is not None:                                  # the same components: what is beside them may be new
            rows = rows.join(seen, ["w", "node", "side"], "left").withColumn("fresh", F.col("seen").isNull()).drop("seen")
        else:
            rows = rows.withColumn("fresh", F.col("side") == 1)
        busy = rows.where("fresh").select("w").distinct()
        cells = with_facing_cells(rows.join(busy, "w", "left_semi"), ["w"], "side", "node", CHUNK)
        known = _with_last(nodes.select("node", "vector"), lists, k, threshold)
        found = materialize(_compared(cells.join(known, "node"), ["w"], k, threshold, facing=True), "nn-found")
        lists = materialize(_lists(found, lists, k, threshold), "nn-lists")
        before, (parts, joined) = rows, _joined(parts, found)
        if not joined and lists.where("fresh").count() < CHANGED * entries:
            return lists, parts
        seen = None if joined else before.select("w", "node", "side", F.lit(True).alias("seen"))


def _count_links(nodes: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """``node, links``: links (with copies) of each node with the others of its component."""
    cells = with_cells(nodes.join(parts, "node"), ["component"], "node", CHUNK)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for cell in _cell_runs(batches, ["component", *_CELL]):
            node, own, copies = (cell[c].to_numpy() for c in ("node", "own", "copies"))
            cross = cell["cell_a"].iloc[0] != cell["cell_b"].iloc[0]
            m = _matrix(cell["vector"])
            if cross:
                left, right = np.flatnonzero(own == cell["cell_a"].iloc[0]), np.flatnonzero(own == cell["cell_b"].iloc[0])
                hit = _similar(m[left], m[right], threshold) >= threshold
                pairs = [(left, hit @ copies[right]), (right, copies[left] @ hit)]
            else:
                hit = _similar(m, m, threshold) >= threshold
                np.fill_diagonal(hit, False)
                pairs = [(np.arange(len(node)), hit @ copies)]
            for at, n in pairs:
                yield pd.DataFrame({"node": node[at], "links": n})

    keys = ["component", *_CELL]
    counted = cells.select(*keys, "own", "node", "copies", "vector").repartition(*keys).sortWithinPartitions(*keys) \
        .mapInPandas(run, "node long, links long")
    return counted.groupBy("node").agg(F.sum("links").alias("links"))


def every_link(nodes: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """Components by comparing all pairs of each label."""
    cells = with_cells(nodes, ["grp"], "node", CHUNK) \
        .withColumns({"last_link": F.lit(2.0), "last": F.lit(2.0), "fresh": F.lit(True), "side": F.col("node")})
    return _joined(parts, materialize(_compared(cells, ["grp"], 1, threshold), "nn-found"))[0]


def _true_links(nodes: DataFrame, asked: DataFrame, threshold: float) -> DataFrame:
    """``node, true``: links (with copies) of the nodes ``asked``, which the driver holds, with all of their labels."""
    by_grp: dict[str, list] = {}
    for r in asked.select("node", "grp", "vector").toLocalIterator():
        by_grp.setdefault(r["grp"], []).append((r["node"], r["vector"]))
    held = {g: (np.array([n for n, _ in rows]), _matrix(pd.Series([v for _, v in rows]))) for g, rows in by_grp.items()}

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for g, part in pdf.groupby("grp"):
                if g not in held:
                    continue
                ids, m = held[g]
                true = np.zeros(len(ids), dtype=np.int64)
                for at in range(0, len(part), CHUNK):
                    some = part.iloc[at:at + CHUNK]
                    hit = _similar(m, _matrix(some["vector"]), threshold) >= threshold
                    hit &= ids[:, None] != some["node"].to_numpy()[None, :]
                    true += hit @ some["copies"].to_numpy()
                yield pd.DataFrame({"node": ids[true > 0], "n": true[true > 0]})

    return nodes.select("node", "grp", "copies", "vector").mapInPandas(scan, "node long, n long") \
        .groupBy("node").agg(F.sum("n").alias("true"))


def audit(nodes: DataFrame, links: DataFrame, threshold: float, linked: int = LINKED) -> float:
    """The share of nodes with links, of which random nodes are asked until ``linked`` were met, whose links ``links`` has all;
    1 if none of ``MOST_AUDITED`` random nodes has a link."""
    n = nodes.count()
    place = F.pmod(F.xxhash64(F.lit("audit"), "node"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    met, whole, at, size = 0, 0, 0.0, AUDITED
    while met < linked and at < 1 and n and at * n < MOST_AUDITED:
        to = min(1.0, at + size / n)
        true = _true_links(nodes, nodes.where((place >= at) & (place < to)), threshold).join(links, "node", "left")
        right = F.coalesce(F.col("links"), F.lit(0)) == F.col("true")
        a, b = true.agg(F.count("*"), F.count(F.when(right, 1))).first()
        met, whole, at, size = met + a, whole + b, to, min(4 * size, AT_ONCE)
    return whole / met if met else 1.0


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding",
                    label: str = "label") -> DataFrame:
    """``key, n_links, component_id, kept`` for every row."""
    rows = usable(embeddings, key, vector, label).withColumnRenamed(label, "label").where("label IS NOT NULL")
    rows = materialize(rows, "nn-rows")
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 1
    short = isinstance(embeddings.schema[vector].dataType.elementType, T.FloatType)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(vector=[_packed(v, short) for v in pdf["vector"]])

    nodes = materialize(_nodes(rows).mapInPandas(pack, "node long, grp string, copies long, vector binary"), "nn-nodes")
    lists, parts, seed = None, nodes.select("node", F.col("node").alias("component")), 0
    while True:
        lists, parts = neighbour_lists(nodes, parts, width, threshold, seed=seed, lists=lists)
        lists, parts = enlarged(nodes, lists, parts, threshold)
        links = materialize(_count_links(nodes, parts, threshold), "nn-links")
        if audit(nodes, links, threshold) >= RECALL:
            break
        if seed >= ATTEMPTS:
            parts = every_link(nodes, parts, threshold)
            links = materialize(_count_links(nodes, parts, threshold), "nn-links")
            break
        seed += 1
    of_node = nodes.select("node", "copies").join(parts, "node", "left").join(links, "node", "left") \
        .select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                F.coalesce("component", "node").alias("c"))
    # From nodes back to keys: every key of a distinct (label, vector) has its node's result.
    one = rows.groupBy("key").agg(F.min(F.struct("label", "vector")).alias("r")).select("key", "r.*")
    least = one.groupBy("label", "vector").agg(F.min("key").alias("node"))
    of_key = one.join(least, ["label", "vector"]).join(of_node, "node").select(F.col("key").alias("_key"), "n", "c")
    out = embeddings.select(F.col(key).cast("long").alias(key))
    return out.join(of_key, out[key] == of_key["_key"], "left").select(
        key, F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", F.col(key)).alias("component_id"),
        F.col(key).eqNullSafe(F.coalesce("c", F.col(key))).alias("kept"))
