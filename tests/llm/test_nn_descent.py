import numpy as np
import pandas as pd

from tests.llm.test_simhash import roots
from tradewind.llm import nn_descent as nd
from tradewind.llm.cells import with_facing_cells
from tradewind.llm.queries import op3_nn_descent
from tradewind.llm.vectors import cosines

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, threshold=0.93):
    """n_links and component_id of usable rows (id, vector, label)."""
    m = np.array([v for _, v, _ in rows], dtype=np.float64)
    label = np.array([x for _, _, x in rows])
    hit = np.zeros((len(rows), len(rows)), dtype=bool)
    for i in range(len(rows)):
        hit[i] = (cosines(np.broadcast_to(m[i], m.shape), m) >= threshold) & (label == label[i])
        hit[i, i] = False
    root = roots(len(rows), list(zip(*np.nonzero(hit))))
    least = {}
    for (i, _, _), r in zip(rows, root):
        least[r] = min(least.get(r, i), i)
    return {i: (int(h.sum()), least[r]) for (i, _, _), h, r in zip(rows, hit, root)}


def fixture(seed):
    rng = np.random.default_rng(seed)
    rows, at = [], 0

    def add(v, label):
        nonlocal at
        rows.append((at, v.astype(np.float32).tolist(), label))
        at += 1
    for label in (1, 2):
        for v in rng.normal(size=(260, 24)):
            add(v, label)
        for v in rng.normal(size=(12, 24)):                                  # pairs
            add(v, label)
            add(v + 0.1 * rng.normal(size=24), label)
    centre = rng.normal(size=24)
    for _ in range(90):                                                      # a large group, some links missing
        add(centre + 0.27 * rng.normal(size=24), 1)
    for _ in range(60):                                                      # exact copies
        add(centre, 1)
    for _ in range(5):
        add(centre, 2)
    return rows


def test_query_against_brute_force_with_odd_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(nd, "CHUNK", 32)
    rows = fixture(1)
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [0.0] * 24, 1), (n + 2, [float("nan")] * 24, 1), (n + 3, [None] + rows[0][1][1:], 1),
           (n + 4, rows[-1][1], None), (n + 5, [1.0, 2.0], 1), (n + 6, [], 2), (None, rows[-1][1], 2)]
    df = spark.createDataFrame(rows + odd + rows[-1:], SCHEMA).selectExpr("*", "1 AS key", "1 AS node", "1 AS n_links", "1 AS c")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op3_nn_descent(spark, str(tmp_path)).collect()
    assert len(got) == n + len(odd) + 1
    want = brute(rows)
    for r in got:
        links, component = want.get(r.vec_id, (0, r.vec_id))
        assert (r.n_links, r.component_id, r.kept) == (links, component, r.vec_id == component), r


def at_cosine(rng, v, cosine):
    """A random unit vector with that cosine to the unit vector ``v``."""
    w = rng.normal(size=len(v))
    w -= (w @ v) * v
    return cosine * v + np.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w)


def test_links_beyond_full_lists_join_groups(spark):
    """Two groups whose members have more links within their own group than a list has places."""
    rng = np.random.default_rng(5)
    a = np.eye(24)[0]
    b = at_cosine(rng, a, 0.955)
    rows = [(i, at_cosine(rng, c, 0.996).tolist(), 1) for i, c in enumerate([a] * 14 + [b] * 14)]
    want = brute(rows)
    assert {c for _, c in want.values()} == {0}
    got = nd.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == want


def test_saturated_lists_are_enlarged_to_their_component(spark):
    """Nodes 1 and 11 know each other, but of their groups only 2 and 12 are linked."""
    angles = {1: 0.0, 2: 0.3, 3: 0.1, 4: 0.2, 11: 0.8, 12: 0.5, 13: 0.7, 14: 0.6}
    nodes = spark.createDataFrame([(n, "1:2", 1, np.array([np.cos(x), np.sin(x)]).tobytes()) for n, x in angles.items()],
                                  "node long, grp string, copies long, vector binary")
    pairs = [(u, v, float(np.cos(angles[u] - angles[v])), False) for g in ((1, 2, 3, 4), (11, 12, 13, 14))
             for u in g for v in g if u != v]
    pairs.append((1, 11, float(np.cos(0.8)), False))
    lists = spark.createDataFrame(pairs, "u long, v long, sim double, fresh boolean")
    parts = spark.createDataFrame([(n, 1 if n < 10 else 11) for n in angles], "node long, component long")
    _, parts = nd.enlarged(nodes, lists, parts, 0.95, k=3)
    assert {r.component for r in parts.collect()} == {1}


def test_audit_sees_missing_links(spark):
    rows = spark.createDataFrame([(1, [1.0, 0.0], 1), (2, [1.0, 0.01], 1), (3, [0.0, 1.0], 1)], SCHEMA)
    nodes = spark.createDataFrame([(r.vec_id, "1:2", 1, np.array(r.embedding).tobytes()) for r in rows.collect()],
                                  "node long, grp string, copies long, vector binary")
    none = spark.createDataFrame([], "node long, links long")
    assert nd.audit(nodes, none, 0.93) == 0.0
    assert nd.audit(nodes, spark.createDataFrame([(1, 1), (2, 1)], "node long, links long"), 0.93) == 1.0


def test_audit_meets_rare_links(spark):
    """One linked pair among 2,000 nodes, and a large group whose links are all known."""
    rng = np.random.default_rng(7)
    vectors = [v / np.linalg.norm(v) for v in rng.normal(size=(2000, 24))]
    vectors.append(at_cosine(rng, vectors[0], 0.99))
    rows = [(i, "1:24", 1, v.tobytes()) for i, v in enumerate(vectors)]
    nodes = spark.createDataFrame(rows, "node long, grp string, copies long, vector binary")
    none = spark.createDataFrame([], "node long, links long")
    assert nd.audit(nodes, none, 0.93) == 0.0
    assert nd.audit(nodes, spark.createDataFrame([(0, 1), (2000, 1)], "node long, links long"), 0.93) == 1.0


def test_tables_grow_with_the_codes():
    same = 1 - np.arccos(0.93) / np.pi
    for bits in range(41):
        assert 1 - (1 - same ** bits) ** nd._tables(bits, 0.93) >= nd.START


def test_missed_links_are_found_by_comparing_all(spark, monkeypatch):
    """The descent finds no link at all."""
    monkeypatch.setattr(nd, "CHUNK", 16)
    nothing = spark.createDataFrame([], "u long, v long, sim double, fresh boolean")
    monkeypatch.setattr(nd, "neighbour_lists", lambda nodes, parts, *_, **__: (nothing, parts))
    monkeypatch.setattr(nd, "enlarged", lambda nodes, lists, parts, *_: (lists, parts))
    rows = [r for r in fixture(3) if r[0] % 7 == 0]
    got = nd.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == brute(rows)


def test_empty_table(spark):
    assert nd.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_facing_cells_pair_the_two_sides_once(spark):
    rows = [(g, i, int(i < left)) for g, (left, n) in enumerate([(3, 40), (20, 20), (0, 9), (25, 70), (1, 2)]) for i in range(n)]
    df = spark.createDataFrame(rows, "g long, i long, side long")
    got, largest = {}, {}
    for r in with_facing_cells(df, ["g"], "side", "i", 8).collect():
        largest.setdefault((r.g, r.cell_a, r.cell_b), []).append(r)
    for (g, _, _), cell in largest.items():
        for a in (r.i for r in cell if r.side == 0):
            for b in (r.i for r in cell if r.side == 1):
                got[g, a, b] = got.get((g, a, b), 0) + 1
    want = {(g, i, j): 1 for g, i, s in rows for h, j, t in rows if g == h and s == 0 and t == 1}
    assert got == want


def test_packed_vectors_of_both_widths():
    rng = np.random.default_rng(11)
    for width in (1, 7, 8):
        m = rng.normal(size=(5, width)).astype(np.float32).astype(np.float64)
        short = nd._matrix(pd.Series([nd._packed(v, True) for v in m]))
        assert np.array_equal(short, nd._matrix(pd.Series([nd._packed(v, False) for v in m])))


def test_audit_stops_where_links_are_rare(spark, monkeypatch):
    monkeypatch.setattr(nd, "MOST_AUDITED", 300)
    asked = []
    own = nd._true_links
    monkeypatch.setattr(nd, "_true_links", lambda nodes, some, t: asked.append(some.count()) or own(nodes, some, t))
    rng = np.random.default_rng(12)
    nodes = spark.createDataFrame([(i, "1:24", 1, nd._packed(v, True)) for i, v in enumerate(rng.normal(size=(2500, 24)))],
                                  "node long, grp string, copies long, vector binary")
    assert nd.audit(nodes, spark.createDataFrame([], "node long, links long"), 0.93) == 1.0
    assert 300 <= sum(asked) < 2000
