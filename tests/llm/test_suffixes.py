import random

import numpy as np
import pytest
from demandloom.llm import suffixes
from hypothesis import given, settings
from hypothesis import strategies as st


def brute(texts, length):
    """(kept, removed, runs) of each text by the definition."""
    seen = {}
    for text in texts:
        for s in range(len(text) - length + 1):
            part = text[s : s + length]
            seen[part] = seen.get(part, 0) + 1
    found = []
    for text in texts:
        gone = [False] * len(text)
        for s in range(len(text) - length + 1):
            if seen[text[s : s + length]] > 1:
                gone[s : s + length] = [True] * length
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        found.append((kept, sum(gone), runs))
    return found


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.integers(1, 40))
def test_sliding_min(values, width):
    width = min(width, len(values))
    got = suffixes.sliding_min(np.array(values, dtype=np.uint64), width)
    assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


@given(st.lists(st.integers(0, 9), min_size=1, max_size=40), st.data())
def test_range_minima(values, data):
    first = data.draw(st.lists(st.integers(0, len(values) - 1), min_size=1, max_size=9))
    last = [data.draw(st.integers(f, len(values) - 1)) for f in first]
    got = suffixes.range_minima(np.array(values), np.array(first), np.array(last))
    assert got.tolist() == [min(values[f : e + 1]) for f, e in zip(first, last, strict=True)]


@settings(deadline=None)
@given(st.lists(st.text("ab", min_size=3, max_size=14), min_size=1, max_size=9), st.data())
def test_repeated_columns(rows, data):
    length = 3
    rows = [r.encode() for r in rows]
    offsets = [data.draw(st.integers(0, len(r) - length)) for r in rows]
    got = set()
    for row, first, last in zip(*suffixes.repeated_columns(rows, offsets, length), strict=True):
        got |= {(int(row), s) for s in range(first, last + 1)}
    at = {}
    for i, (row, offset) in enumerate(zip(rows, offsets, strict=True)):
        for s in range(len(row) - length + 1):
            at.setdefault((s - offset, row[s : s + length]), []).append((i, s))
    assert got == {place for places in at.values() if len(places) > 1 for place in places}


@settings(deadline=None, max_examples=50)
@given(st.lists(st.text("ab", max_size=90), min_size=1, max_size=6))
def test_anchors_stand_for_every_string_once(texts):
    length, gram = 20, 6
    bounds = np.cumsum([0] + [len(t) for t in texts])
    data = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    text, place, first, last, _ = suffixes.anchors(data, bounds, length, gram)
    starts = [s for f, e in zip(first, last, strict=True) for s in range(f, e + 1)]
    want = [b + s for b, t in zip(bounds, texts, strict=False) for s in range(len(t) - length + 1)]
    assert starts == want
    relative = {}
    joined = "".join(texts)
    for p, f, e in zip(place, first, last, strict=True):
        for s in range(f, e + 1):
            assert s <= p <= s + length - gram
            assert relative.setdefault(joined[s : s + length], p - s) == p - s


def check(docs, length):
    rows = docs.select("doc_id", "text").collect()
    want = brute([(r["text"] or "").encode() for r in rows], length)
    want = sorted(((r["doc_id"], *w) for r, w in zip(rows, want, strict=True)), key=str)
    got = suffixes.without_repeats(docs, length).collect()
    got = sorted(
        ((r["_row"]["doc_id"], bytes(r["kept"]), r["n_removed"], r["n_spans"]) for r in got),
        key=str,
    )
    assert got == want


@pytest.fixture(scope="module")
def woven(spark):
    """Texts that share passages of many lengths at many offsets, and runs of one letter."""
    rng = random.Random(8)
    letters = "abcdefghé "

    def random_text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    pool = [random_text(n) for n in (60, 99, 100, 101, 150, 400, 700)]
    texts = ["", None, "z" * 350, "ab" * 300, pool[4] * 3, pool[5], pool[5], pool[5][1:-1]]
    for _ in range(60):
        parts = [rng.choice(pool)[rng.randrange(30) :] for _ in range(rng.randrange(4))]
        texts.append("".join(x for p in parts for x in (random_text(rng.randrange(80)), p)))
    docs = list(enumerate(texts)) + [(3, texts[3]), (None, pool[6]), (None, pool[6])]
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_woven_texts(woven):
    check(woven, 100)


def test_small_chunks_and_groups_change_nothing(woven, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 333)
    monkeypatch.setattr(suffixes, "GROUP_ROWS", 5)
    monkeypatch.setattr(suffixes, "HELD_ROWS", 2)
    check(woven, 100)


@pytest.mark.parametrize("hot", [3, 0])
def test_hot_keys_are_parted_and_nothing_is_lost(spark, monkeypatch, hot):
    """A passage of 90 bytes in many contexts, some of which agree for 100 bytes and more."""
    monkeypatch.setattr(suffixes, "HOT_ROWS", hot)
    monkeypatch.setattr(suffixes, "GROUP_ROWS", 1)
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh") for _ in range(90))
    texts = []
    for i in range(30):
        left = "".join(rng.choice("xyz") for _ in range(1 + i % 4))
        right = "".join(rng.choice("xyz") for _ in range(40))
        texts.append(f"{left}{passage}{right}")
    texts += [texts[0][:-20], texts[1], "q" + passage + "x" * 12, "q" + passage + "x" * 9]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 100)


def test_given_documents(corpus):
    check(corpus[1], suffixes.LENGTH)


def test_edges(edges):
    check(edges, suffixes.LENGTH)


def test_empty(nothing):
    assert suffixes.without_repeats(nothing).collect() == []


def test_stage_keeps_rows_and_columns(spark, edges):
    done = suffixes.drop_repeats(spark, edges, "")
    assert done.columns == edges.columns and done.schema["n_chars"] == edges.schema["n_chars"]
    got = {r["doc_id"]: r for r in done.collect() if r["doc_id"] is not None}
    assert done.count() == edges.count()
    assert got[1]["text"] is None and got[2]["text"] == ""
    assert got[6]["text"] == "" and got[6]["n_chars"] == 0
    assert got[4]["text"] == "one" and got[4]["n_chars"] == 3


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeéö") for _ in range(rng.randint(3, 7))) for _ in range(n))


def stage(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    done = suffixes.drop_repeats(spark, docs, "")
    return [r["text"] for r in done.orderBy("doc_id").collect()]


def test_stage_drops_passages_of_over_50_words(spark):
    """They go as whole words wherever they are; shorter ones stay, however often."""
    rng = random.Random(8)
    passage, short = words(rng, 51), words(rng, 50)
    texts = [
        f"{words(rng, 70)} {passage} {words(rng, 9)}",
        f"{words(rng, 4)} {passage}",
        f"{words(rng, 60)} {short} {words(rng, 30)}",
        f"{words(rng, 5)} {short} {words(rng, 3)}",
        f"{short}",
        f"{words(rng, 90)}",
    ]
    got = stage(spark, texts)
    assert got[2:] == texts[2:]
    assert got[:2] == [texts[0].replace(passage, ""), texts[1].replace(passage, "")]


def test_stage_leaves_words_whole(spark):
    """Words that begin or end alike around a passage are no part of it."""
    rng = random.Random(9)
    passage = words(rng, 60)
    texts = [f"oneé {passage} étwo", f"otherneé {passage} éthree", "é" * 700, "é" * 700]
    assert stage(spark, texts) == ["oneé  étwo", "otherneé  éthree", "é" * 700, "é" * 700]
