"""Piecewise fingerprints and the succession of documents against plain versions."""

import hashlib
import random
import zlib

import pytest

from tests.llm.helpers import DOC_SCHEMA, docs_of, save_docs
from tradewind.llm import piecewise as pw
from tradewind.llm import succession
from tradewind.llm.queries import op13_piecewise_fingerprint

SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def plain_fingerprint(data):
    """Byte by byte, trying every block size from the smallest."""
    rolled = []
    for i in range(len(data)):
        seen = [data[i - k] if i >= k else 0 for k in range(7)]
        total = sum(c * (8 - k) for k, c in enumerate(seen))
        mixed = 0
        for k, c in enumerate(seen):
            mixed ^= (c << (5 * k)) & 0xFFFFFFFF
        rolled.append((total + mixed) & 0xFFFFFFFF)

    def signs(block):
        out, begin = "", 0
        for i, h in enumerate(rolled):
            if (h + 1) % block == 0 or i == len(data) - 1:
                out += SIGNS[zlib.crc32(data[begin:i + 1]) & 63]
                begin = i + 1
        return out

    block = 3
    while len(signs(block)) > 64:
        block *= 2
    return f"{block}:{signs(block)}:{signs(2 * block)}"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def plain_likeness(a, b):
    (ba, a1, a2), (bb, b1, b2) = a.split(":"), b.split(":")
    ba, bb = int(ba), int(bb)
    pair = (a1, b1) if ba == bb else (a1, b2) if ba == 2 * bb else (a2, b1) if bb == 2 * ba else None
    if pair is None:
        return 0.0
    most = max(map(len, pair))
    return 1.0 if most == 0 else 1.0 - distance(*pair) / most


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeéß ñ") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_fingerprint_equals_plain_one(monkeypatch):
    rng = random.Random(3)
    texts = ["", "a", "abc", "a" * 7, "a" * 3000, "ab" * 999, "\x00" * 50, "日本語" * 200]
    texts += [prose(rng, rng.randint(0, 400)) for _ in range(60)]
    for t in texts:
        assert pw.fingerprint_of(t.encode()) == plain_fingerprint(t.encode()), t[:40]
    whole = [pw.fingerprint_of(t.encode()) for t in texts]
    monkeypatch.setattr(pw, "BLOCK", 100)                 # blocks don't change it
    assert [pw.fingerprint_of(t.encode()) for t in texts] == whole


def test_an_edit_keeps_most_signs():
    rng = random.Random(4)
    for n in (60, 600, 6000):
        text, other = prose(rng, n), prose(rng, n)
        edited = text[:len(text) // 2] + "Q" + text[len(text) // 2:]
        a, b, c = (pw.fingerprint_of(t.encode()) for t in (text, edited, other))
        assert plain_likeness(a, b) > 0.9 > 0.4 > plain_likeness(a, c)


def test_likeness_equals_plain_one(spark):
    rng = random.Random(6)
    prints = [pw.fingerprint_of(prose(rng, rng.choice([0, 3, 30, 60, 120, 240])).encode()) for _ in range(40)]
    pairs = [(a, b) for a in prints for b in prints[:15]]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", pw.likeness("a", "b").alias("s")).collect()
    assert all(r["s"] == pytest.approx(plain_likeness(r["a"], r["b"]), abs=1e-12) for r in got)
    assert {r["s"] for r in got if r["a"] == r["b"]} == {1.0}


def restated(rows):
    """The contract of the query; equal ids ordered by content hash, which ``order`` holds."""
    out = []
    for at, (doc, text) in enumerate(rows):
        nxt = rows[(at + 1) % len(rows)][1] or ""
        text = text or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + nxt[:third]
        a, b, c = (plain_fingerprint(t.encode()) if t else "3::" for t in (text, edited, nxt))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b,
                    round(plain_likeness(a, b), 12), round(plain_likeness(a, c), 12)))
    return sorted(out, key=str)


def collected(df):
    assert df.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                          "near_next"]
    return sorted(((*r[:5], round(r[5], 12), round(r[6], 12)) for r in map(tuple, df.collect())), key=str)


@pytest.mark.parametrize("copies", [1, 30])
def test_query_equals_restated_contract(spark, tmp_path, copies):
    rng = random.Random(7)
    texts = [None, "", "x", "ab", "abcé", "ñ" * 500] + [prose(rng, rng.randint(0, 150)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts) if i != 12]
    rows += [(12, "the copied text " * 9)] * copies + [(None, "without an id")]
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in shuffled], DOC_SCHEMA) \
        .selectExpr("*", "'x' AS fingerprint", "'x' AS edited", "'x' AS next", "'x' AS copies", "'x' AS times")
    assert collected(op13_piecewise_fingerprint(spark, save_docs(spark, df, tmp_path / "d"))) == restated(order)


def test_few_and_no_documents(spark, tmp_path):
    one = save_docs(spark, docs_of(spark, ["only one text here"]), tmp_path / "one")
    assert collected(op13_piecewise_fingerprint(spark, one)) == restated([(0, "only one text here")])
    none = save_docs(spark, docs_of(spark, ["x"]).limit(0), tmp_path / "none")
    assert op13_piecewise_fingerprint(spark, none).count() == 0


def test_succession_over_many_ranges(spark):
    rng = random.Random(8)
    ids = rng.sample(range(10_000), 900)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(5)
    rows, begins = succession.in_order(df)
    assert len(begins) > 8
    got = {r["doc_id"]: r["next"]["text"] for r in succession.with_next(rows, begins, ["text"]).collect()}
    order = sorted(ids, reverse=True)
    assert got == {a: f"t{b}" for a, b in zip(order, order[1:] + order[:1])}
