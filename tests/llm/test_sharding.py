import zlib
from collections import Counter

from helpers import documents
from pyspark.sql import functions as F
from sightline.llm import sharding

FOLDER = "/root/testdata/sf0.01"


def test_shards_sizes_slots_and_growth(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = sharding.shard_documents(docs).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    slots = {}
    for r in rows:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(30 < len(s) < 100 for s in slots.values())
    moved = sum(r.grown_shard == 16 for r in rows)
    assert 0.5 / 17 < moved / len(rows) < 2 / 17


def test_weights_move_rows_only_into_what_gained(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    tree = sharding.tree_of(16)
    heavier = {r: {k: dict(v) for k, v in racks.items()} for r, racks in tree.items()}
    heavier["region0"]["rack0"][0] = 3.0
    both = sharding.place(sharding.place(keys, tree, F.col("k")), heavier, F.col("k"), "new")
    rows = both.collect()
    share = Counter(r.level2 for r in rows)
    assert all(1000 < share[str(k)] < 1500 for k in range(16))
    for r in rows:
        if r.level0 != r.new0:
            assert r.new0 == "region0"
        elif r.level0 == "region0" and r.level1 != r.new1:
            assert r.new1 == "rack0"
        elif (r.level0, r.level1) == ("region1", r.new1):
            assert r.level2 == r.new2


def test_growing_is_the_same_as_starting_larger(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    before = None
    for n in range(1, 42):
        placed = {r.k: (r.level0, r.level1, int(r.level2)) for r in sharding.place(keys, sharding.tree_of(n), F.col("k")).collect()}
        if before:
            moved = [k for k in placed if placed[k] != before[k]]
            assert all(placed[k][2] == n - 1 for k in moved) and abs(len(moved) - 3000 / n) < 5 * (3000 / n) ** 0.5
        before = placed
    assert len({p[:2] for p in before.values()}) == 11 and len({p[0] for p in before.values()}) == 6
    docs = documents(spark, ["x"] * 200, list(range(200)))
    for n in (1, 4, 8, 15, 16, 23):
        grown = {r.doc_id: r.grown_shard for r in sharding.shard_documents(docs, n).collect()}
        assert grown == {r.doc_id: r.shard for r in sharding.shard_documents(docs, n + 1).collect()}


def test_nulls_repeats_and_empty(spark):
    docs = documents(spark, [None, "", "x", "x", "y" * 100_000, "z"], [1, 2, 3, 3, None, None])
    rows = sharding.shard_documents(docs).collect()
    assert sorted(r.size for r in rows) == [1, 1, 2, 2, 2, 100_001]
    assert len({(r.shard, r.slot) for r in rows}) == 6 and len({r.shard for r in rows if r.doc_id == 3}) == 1
    assert sharding.shard_documents(documents(spark, [])).count() == 0
