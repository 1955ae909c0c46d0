import random
import zlib
from collections import Counter, defaultdict

from tests.llm.helpers import DOC_SCHEMA, docs_of
from tradewind.llm import sharding
from tradewind.llm.queries import op8_lpt_sharding


def verify(rows, texts, shards):
    by_text, load, slots = defaultdict(set), Counter(), defaultdict(list)
    for r in rows:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
        by_text[body].add(r.shard)
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
        assert 0 <= r.shard < shards
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return load


def test_sizes_near_equal_and_groups_whole(spark, tmp_path):
    rng = random.Random(5)
    texts = ["x" * int(rng.paretovariate(1.2) * 20) + str(i) for i in range(3000)] + [None, "", "é"] + ["copy"] * 700
    docs_of(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    rows = op8_lpt_sharding(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    load = verify(rows, texts, 40)
    groups = Counter()
    for t in texts:
        groups[t or ""] += len((t or "").encode()) + 16
    one_heap = [0] * 40
    sharding._fill(one_heap, sorted(groups.values(), reverse=True))
    assert max(load.values()) <= max(one_heap) + 200 and min(load.values()) >= min(one_heap) - 200


def test_hot_group_few_and_no_rows(spark):
    texts = ["same"] * 500
    rows = sharding.shard_documents(docs_of(spark, texts), 4).collect()
    assert len(verify(rows, texts, 4)) == 1
    assert sharding.shard_documents(docs_of(spark, ["a"]), 4).count() == 1
    assert sharding.shard_documents(spark.createDataFrame([], DOC_SCHEMA), 4).count() == 0


def test_repeated_rows_take_a_slot_each(spark):
    one = docs_of(spark, ["a", "b"])
    rows = sharding.shard_documents(one.union(one), 2).collect()
    assert sorted((r.doc_id, r.slot) for r in rows) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_ranges_level_like_one_heap(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HEAD_PER_SHARD", 4)
    monkeypatch.setattr(sharding, "GROUPS_PER_RANGE", 300)
    rng = random.Random(6)
    texts = ["x" * rng.randint(0, 400) + str(i) for i in range(2000)]
    load = verify(sharding.shard_documents(docs_of(spark, texts), 7).collect(), texts, 7)
    assert max(load.values()) - min(load.values()) <= 100
