import zlib

import pytest
from demandloom.llm import sharding


def check(docs, shards, **given):
    rows = docs.select("doc_id", "text").collect()
    placed = sharding.shard_by_bytes(docs, shards, **given).collect()
    got = sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in placed), key=str)
    bodies = [(r["doc_id"], (r["text"] or "").encode()) for r in rows]
    assert got == sorted(((i, len(b) + 8, zlib.crc32(b)) for i, b in bodies), key=str)
    slots, size = {}, [0] * shards
    for r in placed:
        slots.setdefault(r["shard"], []).append(r["slot"])
        size[r["shard"]] += r["size"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    largest = max((len(b) + 8 for _, b in bodies), default=0)
    mean = sum(size) / shards
    # A cut may miss its place by half a text, or by the tolerance.
    slack = largest + 2 * sharding.TOLERANCE * mean + 1
    assert all(abs(s - mean) <= slack for s in size)
    return placed


def test_given_documents(corpus):
    check(corpus[1], 24)


def test_ranges_inside_shards(corpus):
    placed = check(corpus[1], 5, range_bytes=20_000)
    whole = sharding.shard_by_bytes(corpus[1], 5, range_bytes=20_000)
    assert len({r["shard"] for r in placed}) == 5
    # The same rows in the same places on a second run, however they are partitioned.
    again = sharding.shard_by_bytes(corpus[1].repartition(7), 5, range_bytes=20_000)
    assert sorted(whole.select("doc_id", "shard", "slot").collect()) == sorted(
        again.select("doc_id", "shard", "slot").collect()
    )


def test_edges(edges):
    check(edges, 3)


def test_more_shards_than_rows(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert len(check(docs, 24)) == 2


def test_empty(nothing):
    assert sharding.shard_by_bytes(nothing, 24).collect() == []


def test_hot_group_is_split_and_small_groups_are_not(spark):
    hot = [(i, "hot " * 50) for i in range(600)]
    groups = [(1000 + i, f"text {i % 300} " * 20) for i in range(900)]
    docs = spark.createDataFrame(hot + groups, "doc_id long, text string")
    placed = check(docs, 6)
    shards = {}
    for r in placed:
        shards.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert len(shards[zlib.crc32(b"hot " * 50)]) > 1
    assert sum(len(s) > 1 for s in shards.values()) <= 6


def test_equal_rows_stay_together_however_many(spark):
    docs = spark.createDataFrame([(1, "same")] * 50 + [(2, "x")], "doc_id long, text string")
    placed = sharding.shard_by_bytes(docs, 4).collect()
    assert len({r["shard"] for r in placed if r["doc_id"] == 1}) == 1


@pytest.mark.parametrize("edge", [(-5, 3), (0, sharding.LOW), (7, 9), (8, 0)])
def test_counts_below(spark, edge):
    keys = [(h, d, 10 + d) for h in (-5, 0, 7) for d in (1, 3, 9)]
    keyed = spark.createDataFrame(keys, "_h long, _id long, size long")
    size, rows = sharding.counts_below(keyed, [(-6, 0), edge, (100, 0)])
    below = [s for h, d, s in keys if (h, d) < edge]
    assert (size[1], rows[1]) == (sum(below), len(below))
    assert (size[0], rows[2]) == (0, len(keys))
