"""Periodic runs against plain search, and the query against its contract restated."""

import hashlib
import random
import zlib

import pytest

from tests.llm.helpers import DOC_SCHEMA, docs_of, save_docs
from tradewind.llm import periodic_runs as pr
from tradewind.llm.queries import op12_periodic_runs


def plain_runs(w, least):
    """Every maximal stretch of every period, kept if no smaller period fits."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            m = i + q - s
            smaller = any(all(w[k] == w[k + p] for k in range(s, s + m - p)) for p in range(1, q))
            if m >= max(least, 2 * q) and not smaller:
                out.append((s, m, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def words_of(rng, n):
    alphabet = rng.choice([1, 2, 2, 3, 5, 40])
    w = [rng.randrange(alphabet) for _ in range(n)]
    if n > 4 and rng.random() < 0.6:
        b = rng.randrange(n)
        p = rng.randint(1, max(1, (n - b) // 3))
        w = [w[i] if i < b else w[b + (i - b) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_equal_plain_search(least):
    rng = random.Random(least)
    for _ in range(1200):
        w = words_of(rng, rng.randint(0, 70))
        assert pr.runs_of(w, least) == plain_runs(w, least)
        assert pr.text_runs([b"w%d" % x for x in w], least) == plain_runs(w, least)


def test_last_ends_of_all_suffixes():
    """After each word, the segments name the last earlier end of every suffix that ends a square."""
    rng = random.Random(5)
    for _ in range(100):
        w, automaton = [rng.randrange(2) for _ in range(30)], pr.LastOccurrences()
        for i, x in enumerate(w):
            got = set(automaton.append(x))
            want = {}
            for m in range(1, i + 1):
                ends = [e for e in range(m - 1, i) if w[e - m + 1:e + 1] == w[i - m + 1:i + 1]]
                if ends:
                    want[i - ends[-1]] = m
            assert got == {(d, m) for d, m in want.items() if m >= d}


def restated(rows):
    """The contract of the query, word by word."""
    out = []
    for doc, text in rows:
        w = (text or "").encode().split()
        n, h = len(w), zlib.crc32(str(doc).encode())
        g = h // 10
        if doc is not None and h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(w, 12)
        drop = {i for s, m, q in runs for i in range(s + q, s + m)}
        top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        kept = b" ".join(x for i, x in enumerate(w) if i not in drop)
        out.append((doc, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
                    hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_restated_contract(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "   \t\n", "one", "a " * 11, "a " * 12, "a a " * 30, "x y\x0bz\x0c" * 9]
    texts += [" ".join(f"w{x}" for x in words_of(rng, rng.randint(0, 90))) for _ in range(150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(40, texts[40]), (40, texts[40]), (None, "b c " * 9)]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC_SCHEMA) \
        .selectExpr("*", "'x' AS k", "'x' AS t", "'x' AS runs", "'x' AS w", "'x' AS n", "'x' AS a", "'x' AS collapsed")
    got = op12_periodic_runs(spark, save_docs(spark, df, tmp_path / "d"))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                           "collapsed_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == restated(rows)
    assert any(r[1] > 0 for r in restated(rows))


def test_long_text_and_empty_table(spark):
    text = " ".join(f"w{i % 4001}" for i in range(120_000))
    row = pr.periodic_runs(docs_of(spark, [text])).first()
    assert row["n_words"] == 120_000 and [tuple(r) for r in row["runs"]] == [(0, 120_000, 4001)]
    assert row["collapsed"] == " ".join(f"w{i}" for i in range(4001))
    assert pr.periodic_runs(docs_of(spark, ["x"]).limit(0)).count() == 0
