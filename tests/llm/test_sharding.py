import zlib

import pytest
from pyspark.errors import AnalysisException

from lexledger.llm import sharding


def docs_of(spark):
    rows = [(k, "word " * (k % 37) + "é" * (k % 5)) for k in range(3000)] + [(None, "no id"), (None, None), (7, None), (3, "word word word " + "é" * 3)] + [(9, "again")] * 40
    return rows, spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, slot int, shard string")


def test_places_are_gapless_and_shards_even(spark):
    rows, df = docs_of(spark)
    out, m = sharding.assign(df)
    got = out.collect()
    sizes = lambda t: len((t or "").encode()) + 1
    key = lambda i, t: (i is not None, i or 0, sizes(t), zlib.crc32((t or "").encode()))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sorted(key(i, t) for i, t in rows)
    load = [0] * 8
    for shard in range(8):
        own = sorted((r for r in got if r.shard == shard), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        order = [(r.virtual_slot, r.doc_id is not None, r.doc_id or 0, r["size"], r.text_crc32) for r in own]
        assert order == sorted(order)
        load[shard] = sum(r["size"] for r in own)
    assert max(load) - min(load) < 0.01 * sum(load) / 8
    by_slot = {r.virtual_slot: r["size"] for r in got}
    assert all(m.shard_of[s] in range(8) for s in by_slot) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    again, _ = sharding.assign(df.repartition(7))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))  # the documents alone decide


def test_no_documents(spark):
    out, m = sharding.assign(spark.createDataFrame([], "doc_id long, text string"))
    assert out.count() == 0 and sorted(set(m.shard_of)) == list(range(8))


def test_edits_move_only_what_they_must():
    sizes = {s: 50 + s * 7919 % 101 for s in range(sharding.SLOTS)}
    one = sharding.first_map(sizes, 8)
    assert max(one.loads(sizes)) - min(one.loads(sizes)) <= 50
    assert sharding.rebalanced(one, sizes) is one
    grown = sharding.rebalanced(one, sizes, 9)
    moves = one.moves(grown)
    assert grown.version == 2 and {b for _, b in moves.values()} == {8}  # a new shard only takes
    assert sum(sizes[s] for s in moves) <= sum(sizes.values()) / 9 + 150 and max(grown.loads(sizes)) <= sum(sizes.values()) / 9 + 150
    less = sharding.rebalanced(grown, sizes, 8)
    assert all(a == 8 for s, (a, b) in grown.moves(less).items() if grown.shard_of[s] == 8) and max(less.shard_of) == 7
    hot = sizes | {0: 200_000}  # a slot larger than a share: nothing else stays with it, and the edit ends
    edited = sharding.rebalanced(one, hot)
    loads = edited.loads(hot)
    assert max(loads) == loads[edited.shard_of[0]] and sorted(loads)[-2] < 1.01 * sorted(loads)[0]


def test_versions_and_moving_documents(spark, tmp_path):
    _, df = docs_of(spark)
    _, one = sharding.assign(df)
    root = str(tmp_path / "map")
    sharding.save_map(spark, root, one)
    with pytest.raises(AnalysisException):
        sharding.save_map(spark, root, one)
    sizes = sharding.slot_bytes(sharding.placed(df, one).withColumn("size", sharding.size_of(df.text)))
    two = sharding.rebalanced(one, sizes, 10)
    sharding.save_map(spark, root, two)
    assert sharding.load_map(spark, root) == two and sharding.load_map(spark, root, 1) == one
    sharding.write_shards(df, one, str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    assert stored.count() == df.count() and stored.where("shard = 3").count() > 0
    moved = sharding.moving(spark, str(tmp_path / "docs"), one, two)
    moves = one.moves(two)
    expect = sharding.placed(df, one).collect()
    assert sorted((r.doc_id or -1, r.virtual_slot, r.to) for r in moved.collect()) == sorted((r.doc_id or -1, r.virtual_slot, moves[r.virtual_slot][1]) for r in expect if r.virtual_slot in moves)
