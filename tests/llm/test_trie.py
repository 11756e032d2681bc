import hashlib
import random
import zlib

import pytest

from demandloom.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, n_convs string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", *trie.FIGURES, "ends_sha256")


def ordered(rows):
    own: dict = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(v)] for c, v in own.items()}


def rebuild(own):
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return made


def brute(made):
    members: dict = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    found = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(q[:-1] == p for q in members if q)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(made[c]) == len(path))))
        parent = min(members[path[:-1]]) if path else None
        children = sum(1 for q in below if len(q) == len(path) + 1)
        sha = hashlib.sha256(ends.encode()).hexdigest()
        found.append((min(convs), len(path), parent, len(convs), children, len(leaves), saved, sha))
    return sorted(found, key=repr)


def rows_of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def random_turns(seed):
    draw = random.Random(seed)
    return [
        (c, t, draw.choice(["u", "a"]), draw.choice(["x", "yy", "é"]))
        for c in range(0, 320, draw.choice([1, 7]))
        for t in range(draw.choice([0, 1, 3, 9]))
    ]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("parts", [1, 9])
def test_random_conversations(spark, seed, parts):
    turns = random_turns(seed)
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA)
    made = rebuild(ordered(turns))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        sequences = trie.rebuilt(trie.sequences(frame))
        assert rows_of(trie.prefix_trie(sequences)) == brute(made)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_copies_are_split_over_ranges(spark, monkeypatch):
    """A conversation of most rows spreads over the ranges; its node is put together again."""
    turns = [(c, t, "u", f"turn {t}") for c in range(4000) for t in range(4)]
    turns += [(c, t, "u", f"turn {t}") for c in range(4000, 4050) for t in range(c % 7)]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA)
    monkeypatch.setattr(trie, "HASHED_IDS", 100)
    assert rows_of(trie.prefix_trie(trie.sequences(frame))) == brute(ordered(turns))


def test_edges(spark):
    turns = [
        (5, None, None, None), (5, 1, "u", "b"), (5, 1, "u", "b"), (5, 0, "a", None),
        (None, 0, "u", "no conversation"), (7, 3, "u", ""), (107, 0, "u", "x" * 100_000),
        (-3, 0, "u", "below zero"), (100, 2, "u", "second"), (100, 1, None, "first"),
    ]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], SCHEMA)
    own = ordered(turns)
    assert rows_of(trie.prefix_trie(trie.sequences(frame))) == brute(own)
    assert trie.prefix_trie(trie.rebuilt(trie.sequences(frame.limit(0)))).count() == 0


def test_a_conversation_left_without_turns(spark):
    """Where the head of the family is not there and all own turns are replaced."""
    c = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    frame = spark.createDataFrame([(c, 0, "u", "x", 1, "x")], SCHEMA)
    (root,) = trie.prefix_trie(trie.rebuilt(trie.sequences(frame))).collect()
    assert (root["conv_id"], root["depth"], root["parent_conv_id"], root["n_convs"]) == (c, 0, None, 1)
    assert root["ends_sha256"] == hashlib.sha256(str(c).encode()).hexdigest()
