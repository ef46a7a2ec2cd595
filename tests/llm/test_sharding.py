import struct
import zlib
from collections import Counter

import xxhash
from pyspark.sql import functions as F

from patronage.llm import queries, sharding
from tests.llm.rows import documents, no_documents


def slot_of(doc_id, slots=sharding.SLOTS):
    value = xxhash.xxh64_intdigest(struct.pack("<q", doc_id), seed=42) if doc_id is not None else 42
    return (value - (1 << 64) if value >> 63 else value) % slots


def owner_of(slot, shards):
    """The shard of the largest draw, a chained 64-bit hash of slot and shard as signed number."""

    def draw(shard):
        value = xxhash.xxh64_intdigest(struct.pack("<i", shard), seed=xxhash.xxh64_intdigest(struct.pack("<i", slot), seed=42))
        return value - (1 << 64) if value >> 63 else value

    return max(range(shards), key=lambda shard: (draw(shard), shard))


def test_query_equals_shards_computed_anew(spark):
    """`shard` and `grown_shard` of every row from its id alone, and the places in each shard."""
    sf_dir = "/root/testdata/sf0.01"
    owners = {slot: (owner_of(slot, 24), owner_of(slot, 25)) for slot in range(sharding.SLOTS)}
    assert all(grown in (shard, 24) for shard, grown in owners.values())
    places = {}
    for r in queries.op9_sharding(spark, sf_dir).collect():
        assert (r.shard, r.grown_shard) == owners[slot_of(r.doc_id)]
        places.setdefault(r.shard, set()).add(r.slot)
    assert all(slots == set(range(len(slots))) for slots in places.values())


def test_query_keeps_the_law(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    rows = queries.op9_sharding(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    by_shard, by_slot = {}, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.virtual_slot == slot_of(r.doc_id) and 0 <= r.shard < 24
        assert r.grown_shard in (r.shard, 24)
        by_shard.setdefault(r.shard, []).append(r.slot)
        by_slot.setdefault(r.virtual_slot, []).append(r)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    for group in by_slot.values():
        assert len({(r.shard, r.grown_shard, r.slot_bytes) for r in group}) == 1
        assert sum(r.size for r in group) == group[0].slot_bytes
    assert 0 < sum(r.grown_shard == 24 for r in rows) < len(rows) / 8


def test_shard_depends_on_key_and_count_alone(spark):
    some = {r.doc_id: r.shard for r in sharding.shard_documents(documents(spark, ["a"] * 40, 20)).collect()}
    other = {r.doc_id: r.shard for r in sharding.shard_documents(documents(spark, ["b" * 5000] * 80)).collect()}
    assert all(other[doc_id] == shard for doc_id, shard in some.items())


def test_nulls_repeats_long_and_empty(spark):
    docs = documents(spark, [None, "", "é" * 200_000]).unionAll(documents(spark, [None, ""]))
    docs = docs.unionAll(docs.limit(1).withColumn("doc_id", F.lit(None).cast("long")))
    rows = sharding.shard_documents(docs).collect()
    assert sorted(r.size for r in rows) == [8, 8, 8, 8, 8, 400_008]
    assert max(Counter((r.shard, r.slot) for r in rows).values()) == 1
    assert next(r for r in rows if r.doc_id is None).virtual_slot == slot_of(None)
    assert sharding.shard_documents(no_documents(spark)).count() == 0


def test_every_edit_moves_slots_only_to_the_new_shard(spark):
    old = sharding.first_map(spark, 5, 512)
    new = sharding.grow(old, 6)
    pairs = old.alias("a").join(new.alias("b"), "virtual_slot").select("a.shard", F.col("b.shard").alias("then"), "b.version").collect()
    assert {r.version for r in pairs} == {2} and all(r.then in (r.shard, 5) for r in pairs)
    assert 512 / 12 < sum(r.then == 5 for r in pairs) < 512 / 4
    again = sharding.first_map(spark, 6, 512).select("virtual_slot", "shard")
    assert new.select("virtual_slot", "shard").exceptAll(again).count() == 0


def test_rebalance_evens_out_bytes(spark):
    old = sharding.first_map(spark, 4, 256)
    sizes = old.select("virtual_slot", F.when(F.col("shard") == 1, 100).otherwise(10).cast("long").alias("slot_bytes"))
    new = sharding.rebalance(old, sizes, 4)
    assert new.count() == 256
    loads = lambda m: [r.b for r in m.join(sizes, "virtual_slot").groupBy("shard").agg(F.sum("slot_bytes").alias("b")).collect()]
    assert max(loads(old)) > 4000 and max(loads(new)) - min(loads(new)) <= 200
    moved = old.alias("a").join(new.alias("b"), "virtual_slot").filter("a.shard <> b.shard")
    assert moved.filter("a.shard <> 1").count() == 0


def test_versions_are_kept(spark, tmp_path):
    path = f"file://{tmp_path}/map"
    sharding.save_map(sharding.first_map(spark, 3, 64), path)
    sharding.save_map(sharding.grow(sharding.load_map(spark, path, 1), 4), path)
    assert {r.shard for r in sharding.load_map(spark, path, 1).collect()} <= {0, 1, 2}
    assert sharding.load_map(spark, path, 2).filter("shard = 3").count() > 0
