import zlib
from collections import Counter

from lexweave.llm import sharding
from tests.llm.cases import documents, frame


def test_contract(spark):
    rows = sharding.shard_documents(frame(spark)).collect()
    docs = documents()
    assert len(rows) == len(docs)
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in docs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r["slot"])
        assert 0 <= r["shard"] < 40 and r["law"] == "key" and r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    placed = {}
    for r in rows:
        assert placed.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_even_weights_even_shares_and_growth_moves_only_into_the_new_shard(spark):
    ids = spark.range(40_000).withColumnRenamed("id", "doc_id")
    tree = sharding.even_tree(40)
    rows = sharding.place(sharding.place(sharding.place(ids, "doc_id", tree), "doc_id", tree.grown(), "g1"), "doc_id", tree.grown().grown(), "g2")
    rows = rows.collect()
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(40)) and max(counts.values()) < 1.2 * min(counts.values())
    moved = [r for r in rows if r["g1"] != r["shard"]]
    assert all(r["g1"] == 40 for r in moved) and 700 < len(moved) < 1300
    assert all(r["g2"] in (r["g1"], 41) for r in rows)


def test_a_changed_weight_moves_rows_only_to_or_from_its_subtree(spark):
    ids = spark.range(5_000).withColumnRenamed("id", "doc_id")
    a = sharding.even_tree(40)
    b = sharding.Tree(tuple(3.0 if s == 5 else 1.0 for s in range(40)), 40)
    rows = sharding.place(sharding.place(ids, "doc_id", a, "a"), "doc_id", b, "b").collect()
    region = lambda s: s // 8
    assert any(r["a"] != r["b"] for r in rows)
    assert all(region(r["b"]) == 0 for r in rows if r["a"] != r["b"])


def test_weights_of_zero_get_nothing(spark):
    ids = spark.range(1_000).withColumnRenamed("id", "doc_id")
    tree = sharding.Tree(tuple(0.0 if s < 8 else 1.0 for s in range(40)), 40)
    assert min(r["shard"] for r in sharding.place(ids, "doc_id", tree).collect()) >= 8


def test_empty(spark):
    assert sharding.shard_documents(frame(spark, [])).collect() == []
