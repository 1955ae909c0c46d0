import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.helpers import DOC_SCHEMA, docs_of
from tradewind.llm import kneser_ney as kn
from tradewind.llm.queries import op4_kneser_ney


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", text) + ["</end>"]


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.count, self.pair, self.ctx = Counter(), Counter(), Counter()
        for t in texts:
            own = tokens(t)
            self.count.update(own)
            for a, b in zip(["<begin>"] + own, own):
                self.pair[a, b] += 1
                self.ctx[a] += 1
        self.n, self.v = sum(self.count.values()), len(self.count)
        self.cont = Counter(b for _, b in self.pair)
        self.k = len(self.pair)
        self.du = kn.discounts([sum(c == i for c in self.pair.values()) for i in (1, 2, 3, 4)])
        self.dl = kn.discounts([sum(c == i for c in self.cont.values()) for i in (1, 2, 3, 4)])
        self.after = defaultdict(list)
        for (a, _), c in self.pair.items():
            self.after[a].append(c)

    def p(self, a, w):
        cut = lambda d, c: d[min(c, 3) - 1] if c else 0
        if not self.k:
            return 1 / (self.v + 1)
        g = sum(cut(self.dl, c) for c in self.cont.values()) / self.k
        p = (self.cont[w] - cut(self.dl, self.cont[w])) / self.k + g / (self.v + 1)
        if not self.ctx[a]:
            return p
        c = self.pair[a, w]
        return (c - cut(self.du, c) + sum(cut(self.du, x) for x in self.after[a]) * p) / self.ctx[a]

    def score(self, text):
        own = tokens(text)
        return (len(own), sum(self.count[w] > 0 for w in own),
                sum(math.log10((self.count[w] + 1) / (self.n + self.v + 1)) for w in own),
                sum(math.log10(self.p(a, w)) for a, w in zip(["<begin>"] + own, own)))


def corpus(n, seed):
    rng = random.Random(seed)
    vocab = ["The", "of", "and"] * 20 + [f"w{i}" for i in range(150)] + ["É", "x\xa0y", "</end>x"]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60))) for _ in range(n)]


ODD = [None, "", " \t\n", "THE the", "unseen words only", "the unseen of", "\x0b the\x0cof ", "w1 " * 3000]


@pytest.mark.parametrize("small", [False, True])
def test_query_equals_the_plain_model(spark, tmp_path, monkeypatch, small):
    if small:                                 # many blocks, shards and large counts
        monkeypatch.setattr(kn, "SHARD_TOKENS", 200)
        monkeypatch.setattr(kn, "VOCABULARY_BYTES", 500)
    texts = corpus(300, 1) + ODD
    docs_of(spark, texts, extra=True).selectExpr("*", "'x' AS n_tokens", "'x' AS base_score") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    got = op4_kneser_ney(spark, str(tmp_path)).collect()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    plain = Plain([t for i, t in enumerate(texts) if not held(i)])
    assert len(got) == len(texts)
    for r in got:
        n, known, base, score = plain.score(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), n, known, plain.n)
        assert abs(r.base_score - base) < 1e-6 * max(1, -base) and abs(r.score - score) < 1e-6 * max(1, -score), r
    better = [r.score > r.base_score for r in got if r.held_out]
    assert sum(better) > 0.6 * len(better)


def test_probabilities_sum_to_one(spark):
    docs = docs_of(spark, corpus(60, 2))
    model = kn.train(docs)
    size = model.words.size
    for a in [-1, 0, 5, size // 2, size - 1, size]:
        assert abs(kn.probabilities(model, np.full(size + 1, a), np.arange(size + 1)).sum() - 1) < 1e-9


def test_nothing_to_learn_from_and_empty_table(spark):
    none = spark.createDataFrame([], DOC_SCHEMA)
    model = kn.train(none)
    rows = kn.score(docs_of(spark, ["a b", None]), model).collect()
    assert [(r.n_tokens, r.n_known, r.base_score, r.score) for r in rows] == [(3, 0, 0.0, 0.0), (1, 0, 0.0, 0.0)]
    assert kn.score(none, model).count() == 0


def test_blocks_are_packed_without_loss():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 1 << 63, 1000, dtype=np.uint64))
    assert (kn._unpacked(kn._packed(keys, True), "<u8", True) == keys).all()
    counts = rng.integers(0, 1 << 31, 1000).astype(np.uint32)
    assert (kn._unpacked(kn._packed(counts, False), "<u4", False) == counts).all()


def test_sums_hold_distinct_keys_and_not_all_blocks(monkeypatch):
    import pandas as pd
    monkeypatch.setattr(kn, "HELD_ENTRIES", 50)
    rng, held, plain = np.random.default_rng(4), [], Counter()
    whole = kn._summed
    monkeypatch.setattr(kn, "_summed", lambda k, c: held.append(sum(map(len, k))) or whole(k, c))

    def parts():
        for _ in range(60):
            keys = np.unique(rng.integers(0, 90, 30).astype(np.uint64))
            counts = rng.integers(1, 9, len(keys)).astype(np.uint32)
            plain.update(dict(zip(keys.tolist(), counts.tolist())))
            yield pd.DataFrame({"keys": [kn._packed(keys, True)], "counts": [kn._packed(counts, False)]})

    keys, counts = kn._gather(parts())
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(plain) and (np.diff(keys.astype(np.int64)) > 0).all()
    assert max(held) <= 2 * 90 + 30                # of some 1,500 entries
    assert [len(x) for x in kn._gather(iter(()))] == [0, 0]


def test_vocabulary_shards_grow_with_the_text(spark, monkeypatch):
    docs = docs_of(spark, corpus(300, 3))
    few = kn.train(docs).words
    monkeypatch.setattr(kn, "VOCABULARY_BYTES", 500)
    many = kn.train(docs).words
    assert len(many.starts) > 2 * len(few.starts) - 1 and (many.size, many.tokens) == (few.size, few.tokens)
