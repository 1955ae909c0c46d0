import gc
import random
import re
import weakref
from collections import defaultdict

import numpy as np

import corpus_pipeline as cp
from tests.llm.helpers import DOC_SCHEMA
from tests.llm.test_packing import verify as verify_packing
from tests.llm.test_simhash import brute as brute_groups
from tests.llm.test_simhash import plain_fingerprint
from tradewind.llm import langid, packing, quality
from tradewind.llm.common import remainder


def fixture_rows():
    rng = random.Random(4)
    vocab = [a + b + c for a in "bdgklmnprst" for b in "aeiou" for c in ("", "n", "r")]
    prose = lambda n: " ".join(rng.choice(vocab) + rng.choice(vocab) for _ in range(n))
    code = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    clean = [prose(rng.randrange(40, 160)) + (f' digest = "{code()}" ' if i % 5 == 0 else ".") for i in range(90)]
    texts = clean + clean[:4] * 3                                            # exact copies
    texts += [clean[i].replace(clean[i].split()[9], "other", 1) for i in range(10, 16)]
    texts += [prose(60).upper().replace(" ", "!! ") for _ in range(20)]      # junk
    texts += [prose(70) + f' token = "{code()}" ' + prose(50)]
    texts += [None, "", "123 !! 4", prose(9000)]
    return [(i, t, "xx", "src", None if t is None else len(t)) for i, t in enumerate(texts)]


def test_stages_against_brute_force(spark, tmp_path):
    rows = fixture_rows()
    n_clean = 90
    spark.createDataFrame(rows, DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i < n_clean + 18)) for i in range(0, len(rows) - 6, 2)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, sf, held = spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path), {r[0]: r[1] for r in rows}
    fold = remainder("doc_id", 5)
    model = quality.learn(docs.where(fold != 0), spark.createDataFrame(labels, "doc_id long, quality int").where(fold != 0))
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        if name == "packing":
            last = out.collect()
            break
        out.write.parquet(f"{tmp_path}/out-{name}")
        assert out.columns == docs.columns
        before, docs = held, spark.read.parquet(f"{tmp_path}/out-{name}")
        held = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(held)
        if name == "quality":
            kept = model.score(np.stack([quality.features(t) for t in before.values()])) >= 0.3
            assert set(held) == {i for i, k in zip(before, kept) if k}
            assert not set(held) & set(range(n_clean + 18, n_clean + 38)) and set(held) >= set(range(n_clean))
        elif name == "language":
            assert held == {i: t for i, t in before.items() if langid.normalise(t)}
        elif name == "near_duplicates":
            ids = sorted(before)
            group = brute_groups([plain_fingerprint(before[i]) for i in ids])
            smallest = defaultdict(lambda: 10 ** 9)
            for i, g in zip(ids, group):
                smallest[g] = min(smallest[g], i)
            assert set(held) == set(smallest.values())
            assert not set(held) & set(range(n_clean, n_clean + 12))          # exact copies are gone
        elif name == "secrets":
            assert held == {i: re.sub(r'token = "[0-9a-f]+|[0-9a-f]{32,}', "[SECRET]", t) for i, t in before.items()}
            assert sum("[SECRET]" in t for t in held.values()) >= 18
            assert all(r.n_chars == len(r.text) for r in docs.collect())
    texts = {i: held[k] for i, k in enumerate(sorted(held))}
    renumber = {k: i for i, k in enumerate(sorted(held))}
    again = [type("R", (), {**r.asDict(), "doc_id": renumber[r.doc_id]}) for r in last]
    n, total = verify_packing(again, [texts[i] for i in range(len(texts))], 2048)
    assert n <= -(-total // 2048) + 1
    whole = cp.run(spark, sf)
    assert sorted(whole.select("doc_id", "piece", "length", "ids_crc32").collect()) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in last)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], DOC_SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0


def test_a_worker_holds_the_tables_of_one_operator():
    """The stages share worker processes: what one stage keeps there goes when the next one begins."""
    model = (("aa", b" abc abd "), ("bb", b" xyz xyw "))
    automata = weakref.ref(langid.parser(model))
    assert langid.parser(model) is automata()                                # kept for the stage's further tasks
    chunks = weakref.ref(packing._cached_tokenizer(packing.default_tokenizer()))
    assert packing._cached_tokenizer(packing.default_tokenizer()) is chunks()
    gc.collect()
    assert automata() is None
    quality.features("plain words")
    gc.collect()
    assert chunks() is None
