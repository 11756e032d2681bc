import itertools
import zlib

import numpy as np
import pytest
from demandloom.llm import packing
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    made = Tokenizer.from_file(packing.TOKENIZER)
    made.encode_special_tokens = True
    return made


@pytest.fixture(scope="module")
def words():
    return packing.WordIds(packing.TOKENIZER)


def brute_cost(places, penalties, window):
    """Least padding plus penalties over all ways to cut, the last place being a cut."""
    best = None
    inner = range(1, len(places) - 1)
    for n in range(len(places) - 1):
        for chosen in itertools.combinations(inner, n):
            cuts = [0, *chosen, len(places) - 1]
            gaps = [places[b] - places[a] for a, b in itertools.pairwise(cuts)]
            if max(gaps) <= window:
                cost = sum(window - g for g in gaps) + sum(penalties[c] for c in cuts[1:])
                best = cost if best is None else min(best, cost)
    return best


@settings(deadline=None)
@given(
    st.lists(st.tuples(st.integers(1, 10), st.sampled_from([0, 2, 7])), min_size=1, max_size=9),
    st.integers(10, 17),
)
def test_cuts_are_the_cheapest(steps, window):
    places = [0, *itertools.accumulate(s for s, _ in steps)]
    penalties = [0, *(p for _, p in steps)]
    cuts = packing.plan_cuts(places, penalties, window)
    gaps = [places[b] - places[a] for a, b in itertools.pairwise(cuts)]
    assert cuts[0] == 0 and cuts[-1] == len(places) - 1 and max(gaps) <= window
    cost = sum(window - g for g in gaps) + sum(penalties[c] for c in cuts[1:])
    assert cost == brute_cost(places, penalties, window)


def test_last_window_as_powers_of_two():
    assert packing.binary_lengths(4096, 4096) == [4096]
    assert packing.binary_lengths(2048, 4096) == [2048]
    assert packing.binary_lengths(0, 4096) == []
    assert packing.binary_lengths(4090, 4096) == [4090]
    assert sum(packing.binary_lengths(3001, 4096)) == 3001


@settings(deadline=None, max_examples=400)
@given(st.text(alphabet="aZéÉİŉΣς 'sS.,!\n\t ́K1٣中😀", max_size=20))
def test_chunk_ids_equal_the_tokenizer(words, tokenizer, text):
    flat = [words[chunk] for chunk in packing.chunks_of(text)]
    ids = [i for n in flat for i in words.flat[words.ends[n] : words.ends[n + 1]]]
    assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, docs, tokenizer, window=4096):
    """Every id of every document lies in one piece, offsets are gapless, windows hold."""
    want = {}
    for n, (doc_id, text) in enumerate(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        want.setdefault((doc_id, np.array(ids, dtype="<u4").tobytes()), []).append(n)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        ends = list(itertools.accumulate(r["length"] for r in pieces))
        assert [r["offset"] for r in pieces] == [0, *ends[:-1]] and ends[-1] <= window
    whole = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        whole.setdefault(r["doc_id"], []).append(r)
    for doc_id, pieces in whole.items():
        body = b"".join(bytes(p["ids"]) for p in pieces)
        expected = [k[1] for k, v in want.items() if k[0] == doc_id for _ in v]
        assert len(body) == sum(map(len, expected))
        assert all(p["length"] * 4 == len(p["ids"]) for p in pieces)
        at = 0
        for p in pieces:
            assert p["start"] == at
            at = (at + p["length"]) % p["doc_tokens"]
    assert set(whole) == {k[0] for k in want}
    return sequences


def test_given_documents(corpus, tokenizer):
    pairs, docs = corpus
    rows = packing.pack(docs).collect()
    sequences = check(rows, pairs, tokenizer)
    lengths = [sum(r["length"] for r in s) for s in sequences.values()]
    padding = sum(4096 - n for n in lengths if n & (n - 1))
    assert padding < 0.03 * sum(lengths)
    by_id = dict(pairs)
    for r in rows[:50]:
        ids = tokenizer.encode(by_id[r["doc_id"]], add_special_tokens=False).ids + [2]
        part = np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes()
        assert zlib.crc32(part) == zlib.crc32(bytes(r["ids"]))


def test_edges(edges, tokenizer):
    rows = packing.pack(edges).collect()
    check(rows, [(r["doc_id"], r["text"]) for r in edges.collect()], tokenizer)
    assert sum(r["length"] for r in rows if r["doc_id"] == 2) == 1


def test_blocks_and_a_full_memory_change_nothing(edges, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 5000)
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    check(
        packing.pack(edges).collect(),
        [(r["doc_id"], r["text"]) for r in edges.collect()],
        tokenizer,
    )


def test_empty(nothing):
    assert packing.digests(packing.pack(nothing)).collect() == []
