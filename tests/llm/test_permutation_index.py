import numpy as np

from tradewind.llm import permutation_index as pi
from tradewind.llm.queries import op2_permutation_index

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n, seed, width=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    return [(centres[i % 8] + 0.6 * rng.normal(size=width)).astype(np.float32).tolist() for i in range(n)]


def test_query_against_brute_force_with_odd_rows(spark, tmp_path):
    data = vectors(700, 1)
    same = data[3]
    rows = [(i, v, 1) for i, v in enumerate(data)] + [(1000 + i, same, None) for i in range(120)]
    odd = [(2000, None, 1), (2050, [0.0] * 16, 1), (2100, [float("nan")] * 16, 1), (2150, [None] + same[1:], 1),
           (2200, [float("inf")] + same[1:], 1), (2250, [], 1), (2300, [1.0, 2.0], 1), (None, same, 1)]
    df = spark.createDataFrame(rows + odd + rows[:1], SCHEMA).selectExpr("*", "1 AS key", "2 AS query_id", "3 AS score")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {}
    for r in op2_permutation_index(spark, str(tmp_path)).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    exact = {i: [float(x) for x in v] for i, v, _ in rows}
    asked = [i for i in exact if i % 50 == 0]
    assert sorted(got) == sorted(asked)
    hits = 0
    for i in asked:
        want = pi.brute_force(exact, i)
        mine = sorted(got[i])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        hits += len({v for v, _ in want} & {v for _, v, _ in mine})
        assert all(abs(s - pi.brute_force({i: exact[i], v: exact[v]}, i)[0][1]) < 1e-12 for _, v, s in mine)
    assert hits >= 0.9 * 5 * len(asked)
    copies = sorted(got[1000])
    assert [v for _, v, _ in copies] == [3, 1001, 1002, 1003, 1004]          # ties go to the smaller ids


def test_recall_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(pi, "RERANK_ROWS", 20)
    rows = spark.createDataFrame([(i, v, 1) for i, v in enumerate(vectors(1500, 2))], SCHEMA)
    asked = rows.where("vec_id % 25 = 0")
    found = pi.search(rows, asked, block=400).cache()
    assert found.count() == 60 * 5
    assert pi.recall(found, rows, asked) >= 0.9


def test_footrule_from_inverted_files():
    rng = np.random.default_rng(3)
    perms = np.stack([rng.permutation(12)[:5] for _ in range(50)]).astype(np.int16)
    files = pi.InvertedFiles(perms, 12)

    def footrule(a, b):
        place = lambda p, x: p.index(x) if x in p else 5
        return sum(abs(place(a, x) - place(b, x)) for x in range(12))
    for q in perms[:10]:
        assert files.footrule(q).tolist() == [footrule(q.tolist(), p.tolist()) for p in perms]


def test_few_rows_and_empty_table(spark):
    one = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 1.0], 1)], SCHEMA)
    assert [(r.query_id, r["rank"], r.vec_id) for r in pi.search(one, one.where("vec_id = 0")).collect()] == [(0, 1, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert pi.search(none, none).count() == 0


def test_each_vector_length_has_an_index(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=2).tolist(), 1) for i in range(200)] + [(1000 + i, rng.normal(size=3).tolist(), 1) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {}
    for r in pi.search(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got) == [0, 50, 100, 150, 1000, 1050]
    for q, found in got.items():
        want = pi.brute_force({i: v for i, v, _ in rows if (i < 1000) == (q < 1000)}, q)
        assert [v for _, v in sorted(found)] == [v for v, _ in want]


def test_a_vector_shared_by_a_third_of_all_rows(spark):
    rng = np.random.default_rng(9)
    same = rng.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else rng.normal(size=8).tolist(), 1) for i in range(1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    classes = pi._classes(pi.usable(df, "vec_id", "embedding"), 6)
    assert "WindowGroupLimit" in classes._jdf.queryExecution().executedPlan().toString()      # cut before rows move
    assert max(classes.collect(), key=lambda r: len(r["keys"]))["keys"] == [0, 3, 6, 9, 12, 15]
    got = sorted((r["rank"], r.vec_id) for r in pi.search(df, df.where("vec_id = 600")).collect())
    assert [v for _, v in got] == [0, 3, 6, 9, 12]
