"""Spelling variants against all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.helpers import DOC_SCHEMA, docs_of, save_docs
from tradewind.llm import spelling as sp
from tradewind.llm.queries import op11_spelling_variants


def edits(w, alphabet):
    out = {w[:i] + w[i + 1:] for i in range(len(w))}
    out |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in alphabet}
    out |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in alphabet}
    return out - {w}


def plain_groups(count, factor=5):
    alphabet = sorted(set("".join(count)))
    form = {}
    out = {}
    for w, n in count.items():
        near = [v for v in edits(w, alphabet) if v in count]
        best = min(near, key=lambda v: (-count[v], v)) if near else None
        form[w] = best if best and count[best] >= factor * n else None
        out[w] = (n, len(near))
    rows = []
    for w, (n, near) in out.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, near, count[form[w]] if form[w] else None))
    return sorted(rows)


def random_words(rng, n):
    alphabet = rng.choice(["ab", "abc", "aéèñ", "abcdefgh"])
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randint(1, 11))) for _ in range(n)}
    for w in list(words):
        for v in rng.sample(sorted(edits(w, alphabet)), 2):
            words.add(v)
    return sorted(words - {""})


@pytest.mark.parametrize("seed", range(4))
def test_groups_equal_all_pairs(spark, seed):
    rng = random.Random(seed)
    count = {w: rng.choice([5, 6, 25, 31, 200, 1000, 40_000]) for w in random_words(rng, 250) if len(w) >= 4}
    got = sp.spelling_groups(spark.createDataFrame(list(count.items()), "word string, n long"))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain_groups(count)


def test_long_chain_of_forms(spark):
    words = ["aaaaaaaaaaaa"[:i] + "bbbbbbbbbbbb"[i:] for i in range(13)]
    count = {w: 5 ** (i + 1) for i, w in enumerate(words)}
    got = {r["word"]: r["root"] for r in sp.spelling_groups(
        spark.createDataFrame(list(count.items()), "word string, n long")).collect()}
    assert set(got.values()) == {words[-1]}


def test_each_pair_once(spark):
    words = ["aaaaaa", "aaaaaaa", "aaaaab", "abcdef", "bbcdef", "abcdefg", "bcdefg"]
    pairs = sp.near_pairs(spark.createDataFrame([(w, 5) for w in words], "word string, n long")).collect()
    got = Counter(frozenset((r["a"], r["b"])) for r in pairs)
    want = {frozenset((a, b)) for a in words for b in words if b in edits(a, "abcdefg")}
    assert set(got) == want and set(got.values()) == {1}


def restated(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % 199 == 0:
                at = h % len(w)
                w = w[:at] + w[at + 1:]
            count[w] += 1
    return plain_groups({w: n for w, n in count.items() if len(w) >= 6 and n >= 5})


def test_query_equals_restated_contract(spark, tmp_path):
    rng = random.Random(11)
    words = ["Garten", "garten", "gärten", "Öffnung", "öffnung", "PLANET", "planets", "planet", "straße", "strasse",
             "naïveté", "short", "×÷×÷×÷", "kitchen", "kitchens", "kitcheen"]
    weights = [2 ** (i % 9) for i in range(len(words))]
    joins = [" ", ", ", "-", "1", "\n", "_", "Ā"]
    rows = [(i, "".join(w + rng.choice(joins) for w in rng.choices(words, weights, k=rng.randint(0, 60))))
            for i in range(300)]
    rows += [(300, None), (301, ""), (302, "garten " * 5000), (303, rows[0][1]), (303, rows[0][1]), (None, "planet")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOC_SCHEMA) \
        .selectExpr("*", "'x' AS word", "'x' AS form", "'x' AS size", "'x' AS chunk")
    got = op11_spelling_variants(spark, save_docs(spark, df, tmp_path / "d"))
    want = restated(rows)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want
    assert any(r[1] for r in want) and any(len(r[0]) == 6 and r[3] for r in want)


def test_no_words(spark, tmp_path):
    for at, df in enumerate([docs_of(spark, ["x"]).limit(0), docs_of(spark, [None, "", "a b c"])]):
        assert op11_spelling_variants(spark, save_docs(spark, df, tmp_path / str(at))).count() == 0
