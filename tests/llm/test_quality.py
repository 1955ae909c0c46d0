import random
import zlib

import numpy as np

from tests.llm.helpers import DOC_SCHEMA, docs_of
from tradewind.llm import quality as q
from tradewind.llm.queries import op1_pu_quality


def prose(rng):
    return " ".join(rng.choice("abcdefgh") * rng.randrange(1, 4) + str(rng.choice("xyz")) + rng.choice(["", ",", "."])
                    for _ in range(rng.randrange(30, 200)))


def junk(rng):
    return " ".join(w.upper() + "!!" for w in prose(rng).split())


def test_query_separates_held_out_rows(spark, tmp_path):
    rng = random.Random(1)
    kinds = [rng.random() < 0.8 for _ in range(600)]
    texts = [prose(rng) if k else junk(rng) for k in kinds] + [None, "", "x" * 300_000]
    docs_of(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    # Labels of the held-out fold are turned round: whoever learns them gets worse.
    label = lambda i: int(kinds[i]) if zlib.crc32(str(i).encode()) % 5 else int(not kinds[i])
    rows = [(i, label(i), 0) for i in range(0, 600, 2)] + [(0, label(0), None), (2, None, 0), (None, 1, 1), (9999, 1, 1)]
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in op1_pu_quality(spark, str(tmp_path)).collect()}
    assert len(got) == len(texts) and all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in range(600) if got[i].held_out]
    assert np.mean([got[i].predicted == kinds[i] for i in held]) >= 0.97


def test_prior_and_risk_on_known_mixtures():
    rng = np.random.default_rng(0)
    row = lambda n, at: np.column_stack([rng.normal(at, 1, (n, 3)), np.ones(n)])
    for prior in (0.3, 0.8):
        pos, mixed = row(1500, 2), np.concatenate([row(int(3000 * prior), 2), row(int(3000 * (1 - prior)), -2)])
        rng.shuffle(mixed)
        assert abs(q.class_prior(pos, mixed) - prior) < 0.08
        w = q.nn_pu(pos, mixed, prior)
        assert (row(500, 2) @ w > 0).mean() > 0.97 and (row(500, -2) @ w < 0).mean() > 0.97


def test_nothing_to_learn_from_and_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = q.learn(docs_of(spark, ["a b"]), none)
    assert [r.score for r in q.score(docs_of(spark, ["a b", None]), model).collect()] == [0.5, 0.5]
    assert q.score(spark.createDataFrame([], DOC_SCHEMA), model).count() == 0


def test_features_are_finite_for_odd_texts():
    for t in (None, "", " \n", "\x00", "🙂" * 100, "A!" * 5000, "one", "é１² ǅ", "\n".join(["same line"] * 50)):
        assert np.isfinite(q.features(t)).all()


def plain_features(text):
    """The features by their definitions, character by character."""
    import math
    text = text or ""
    words = text.split()
    out = [0.0] * q.FEATURES
    if not words:
        return out
    n = len(words)

    def shape(c):
        if ord(c) > 0xFFFF:
            c = "\uffff"
        return " " if c.isspace() else "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c if ord(c) < 128 else "o"
    shapes = [shape(c) for c in text]
    count = lambda s: sum(x == s for x in shapes)
    letters, dense = count("X") + count("x"), len(shapes) - count(" ")
    low = text.lower().split()
    lines = [x for x in text.split("\n") if x.strip()]
    out[0] = math.log1p(n)
    out[1] = sum(low[i] == low[i + 1] for i in range(len(low) - 1)) / n
    out[2] = sum(len(set(low[i:i + q.WINDOW])) for i in range(0, n, q.WINDOW)) / n
    out[3] = count("X") / max(1, letters)
    out[4] = 1 - (letters + count("9")) / max(1, dense)
    out[5] = count("9") / max(1, dense)
    out[6] = min(dense / n, 40.0)
    out[7] = min(len(lines) / n, 1.0)
    out[8] = 1 - len(set(lines)) / max(1, len(lines))
    runs = [s for i, s in enumerate(shapes) if i == 0 or s != shapes[i - 1]]
    share = [0.0] * q.SHAPES
    for word in "".join(runs).split():
        share[zlib.crc32(word.encode()) % q.SHAPES] += 1 / n
    return out[:q.PLAIN] + [math.sqrt(x) for x in share]


def test_features_equal_plain_ones():
    rng = random.Random(5)
    texts = [prose(rng) for _ in range(10)] + [junk(rng) for _ in range(5)] + [
        None, "", "Hello, World 42!", "é１² ǅ \x00", "same\nsame\n\nother", "".join(rng.choice("aA1!,;") for _ in range(300))]
    for t in texts:
        assert np.allclose(q.features(t), plain_features(t), atol=1e-5), t


def test_scores_equal_plain_ones(spark):
    """The query's score is the logistic function of the weighted, standardised, clipped features."""
    import math
    rng = random.Random(9)
    texts = [prose(rng) if i % 2 else junk(rng) for i in range(200)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    model = q.learn(docs, labels)
    got = {r.doc_id: r.score for r in q.score(docs, model).collect()}
    for i in range(0, 200, 7):
        f = plain_features(texts[i])
        z = sum(w * min(8, max(-8, (x - m) / s)) for w, x, m, s in zip(model.weights, f, model.mean, model.scale)) + model.weights[-1]
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-4


def test_gradient_of_the_risk():
    """The weights found lie at a least of the non-negative unbiased risk, computed plainly."""
    rng = np.random.default_rng(3)
    row = lambda n, at: np.column_stack([rng.normal(at, 1, (n, 2)), np.ones(n)])
    pos, unl, prior = row(400, 1), np.concatenate([row(300, 1), row(300, -1)]), 0.5

    def risk(w):
        loss = lambda z: np.log1p(np.exp(-z)).mean()
        return prior * loss(pos @ w) + max(0.0, loss(-unl @ w) - prior * loss(-pos @ w)) + 0.5e-3 * (w @ w)
    w = q.nn_pu(pos, unl, prior)
    assert all(risk(w) <= risk(w + d) + 1e-3 for d in rng.normal(0, 0.2, (50, 3)))


def test_driver_rows_are_bounded_under_a_hot_key(spark, monkeypatch):
    rows = [(1, f"text {i}", "en", "s", 1) for i in range(3000)] + [(i, f"word {i}", "en", "s", 1) for i in range(2, 400)]
    labels = spark.createDataFrame([(i, 1) for i in range(1, 100)], "doc_id long, quality int")
    fetched = []
    plain = q._feature_rows
    monkeypatch.setattr(q, "_feature_rows", lambda df: fetched.append(plain(df)) or fetched[-1])
    q.learn(spark.createDataFrame(rows, DOC_SCHEMA), labels, max_positives=20, max_unlabelled=50)
    assert len(fetched[0]) == 20 and 0 < len(fetched[1]) <= 50
