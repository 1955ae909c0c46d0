import random
import re

import numpy as np
import xxhash

from tests.llm.helpers import DOC_SCHEMA, docs_of
from tradewind.llm import simhash as sh
from tradewind.llm.components import components
from tradewind.llm.queries import op6_simhash


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


def brute(prints, radius=3):
    return roots(len(prints), [(i, j) for i in range(len(prints)) for j in range(i)
                               if bin(prints[i] ^ prints[j]).count("1") <= radius])


def clustered(n, seed):
    rng = random.Random(seed)
    centres = [rng.getrandbits(64) for _ in range(n // 15)]
    out = []
    for _ in range(n):
        x = rng.choice(centres)
        for _ in range(rng.randrange(5)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


def test_fingerprints_and_components_of_the_query(spark, tmp_path):
    rng = random.Random(2)
    words = ["É", "the", "Quick", "fox\xa0x", "a", "𝄞", "jumps"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(60)) for _ in range(200)) for _ in range(8)]
    near = [b.replace(b.split()[20], "Changed", 1) for b in base]
    texts = [None, "", " \t\n", "a", "A b", "a\x0bb", "one two three"] + base + near + base[:3] + ["copy"] * 40
    docs_of(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(op6_simhash(spark, str(tmp_path)).collect())
    prints = [plain_fingerprint(t) for t in texts]
    assert [r.fingerprint for r in rows] == [f"{p:016x}" for p in prints]
    assert [r.component_id for r in rows] == brute(prints)


def test_cells_of_a_hot_bucket_and_many_blocks(spark, monkeypatch):
    prints = clustered(700, 3) + [x << 48 for x in range(0, 300)]       # 300 that share 48 bits
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(prints)]
    df = spark.createDataFrame(signed, "doc_id long, bits long")
    monkeypatch.setattr(sh, "CHUNK", 64)
    monkeypatch.setattr(sh, "_blocks", lambda n, radius: 5)
    monkeypatch.setattr(sh.link_forest, "__defaults__", (3, 64))
    got = {r.doc_id: r.component_id for r in sh.near_duplicates(df).collect()}
    assert [got[i] for i in range(len(prints))] == brute(prints)


def test_bit_slices_agree_with_popcounts():
    bits = np.array(clustered(300, 4), dtype=np.uint64)
    sliced = sh.planes(bits)
    for radius in (0, 1, 3, 7):
        query = np.repeat(bits[:40], len(sliced))
        word = np.tile(np.arange(len(sliced)), 40)
        alive = np.full(len(word), ~np.uint64(0))
        hits, lanes = sh.within(query, word, sliced, alive, radius)
        got = {(int(h) // len(sliced), 64 * int(word[h]) + k) for h, m in zip(hits, lanes) for k in range(64) if int(m) >> k & 1}
        want = {(q, j) for q in range(40) for j in range(64 * len(sliced))
                if bin(int(bits[q]) ^ (int(bits[j]) if j < 300 else 0)).count("1") <= radius}
        assert got == want


def test_empty_table_repeated_rows_and_null_keys(spark):
    none = sh.near_duplicates(sh.fingerprints(spark.createDataFrame([], DOC_SCHEMA)))
    assert none.count() == 0
    one = docs_of(spark, ["a b c d", "x y z"])
    keyless = spark.createDataFrame([(None, "q r s", None, None, None)], DOC_SCHEMA)
    rows = sh.near_duplicates(sh.fingerprints(one.union(one).union(keyless))).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None) == [(0, 0), (0, 0), (1, 1), (1, 1)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}}
