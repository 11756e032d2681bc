import numpy as np
import pytest
from pyspark.sql import functions as F

from demandloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>, rank string, score double"


def brute(ids, vectors, queries, top):
    found = {}
    for q in queries:
        others = [
            (-sum(int(a) * int(b) for a, b in zip(vectors[q], v, strict=True)), i)
            for i, v in zip(ids, vectors, strict=True)
            if i != ids[q]
        ]
        found[ids[q]] = [(k + 1, i, -s) for k, (s, i) in enumerate(sorted(others)[:top])]
    return found


def answers(df):
    found: dict = {}
    for r in df.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return found


@pytest.mark.parametrize("rows", [50, 300, 10_000])
def test_given_vectors(spark, rows):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = topk.quantised(vectors, 64)
    local = sorted(whole.collect(), key=lambda r: r["vec_id"])
    ids, lists = [r["vec_id"] for r in local], [r["vector"] for r in local]
    asked = [k for k, i in enumerate(ids) if i % 20 == 0]
    found = topk.top_k(whole, whole.where(F.col("vec_id") % 20 == 0), 20, rows, 10)
    assert answers(found) == brute(ids, lists, asked, 20)


@pytest.mark.parametrize("largest", [3, 60_000, 1 << 29])
def test_every_kind_of_number(spark, largest):
    rng = np.random.default_rng(largest)
    lists = rng.integers(-largest, largest, (90, 5)).tolist()
    lists[7] = lists[8] = lists[9]
    whole = spark.createDataFrame(list(enumerate(lists)), "vec_id long, vector array<long>")
    found = topk.top_k(whole, whole.where("vec_id < 10"), 4, 20, 3)
    assert answers(found) == brute(list(range(90)), lists, range(10), 4)


def test_beyond_64_bits_is_an_error(spark):
    whole = spark.createDataFrame([(0, [1 << 40]), (1, [1 << 40])], "vec_id long, vector array<long>")
    with pytest.raises(Exception, match="beyond 64 bits"):
        topk.top_k(whole, whole, 1).collect()


def test_pruned_pairs_do_not_reach_the_floor():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-40, 40, (3000, 64))
    block = topk.Block(np.arange(3000), vectors.T)
    queries = vectors[:5] + rng.integers(-2, 3, (5, 64))
    floors = np.sort(queries @ vectors.T, axis=1)[:, -15]
    row, col, score = block.best(np.full(5, -1), queries, floors, 10)
    want = [tuple(np.lexsort((np.arange(3000), -s))[:10]) for s in queries @ vectors.T]
    assert [tuple(col[row == k]) for k in range(5)] == want
    assert (score == (queries[row] * vectors[col]).sum(axis=1)).all()


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, 0.25]), (20, [0.0, 0.0]), (1, [0.5, 0.25]), (1, [0.5, 0.25]), (2, None),
        (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (40, [1.0]),
        (6, [2.0]), (60, []), (7, []), (8, [-0.01, 0.0]),
    ]
    frame = spark.createDataFrame([(*r, "x", 0.5) for r in rows], SCHEMA)
    whole = topk.quantised(frame, 64)
    found = answers(topk.top_k(whole, whole.where(F.col("vec_id") % 20 == 0), 3, 4, 2))
    assert found == {
        0: [(1, 1, 1280), (2, 1, 1280), (3, 20, 0)],
        20: [(1, 0, 0), (2, 1, 0), (3, 1, 0)],
        40: [(1, 6, 8192)],
        60: [(1, 7, 0)],
    }
    none = frame.limit(0)
    assert topk.top_k(topk.quantised(none, 64), topk.quantised(none, 64), 3).count() == 0
