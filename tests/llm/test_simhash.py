import itertools

import pytest
import xxhash
from demandloom.llm import simhash
from demandloom.llm.components import connected_components
from hypothesis import given
from hypothesis import strategies as st

BLANKS = " \t\n\x0b\x0c\r"


def brute_fingerprint(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    for b in BLANKS:
        low = low.replace(b, " ")
    words = [w for w in low.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    """Smallest id each reaches; ids and fingerprints in parallel lists."""
    comp = list(range(len(fps)))

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in itertools.combinations(range(len(fps)), 2):
        if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
            comp[root(i)] = root(j)
    ids = {}
    for i, (doc_id, _) in enumerate(fps):
        ids.setdefault(root(i), []).append(doc_id)
    smallest = {r: min((x for x in v if x is not None), default=None) for r, v in ids.items()}
    return [smallest[root(i)] for i in range(len(fps))]


@given(st.text(alphabet="aBÉ \n\x1c\x85z", max_size=60))
def test_fingerprint_equals_brute_force(text):
    assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def as_long(value):
    return value - (1 << 64) if value >> 63 else value


def check(docs, pairs):
    fps = [(i, brute_fingerprint(t or "")) for i, t in pairs]
    want = sorted(
        zip(fps, brute_components(fps), strict=True), key=lambda x: (str(x[0][0]), x[0][1])
    )
    got = simhash.near_duplicates(docs).collect()
    got = sorted(
        (((r["doc_id"], r["fp"] % (1 << 64)), r["component_id"]) for r in got),
        key=lambda x: (str(x[0][0]), x[0][1]),
    )
    assert got == want


def test_given_documents(corpus):
    pairs, docs = corpus
    check(docs, pairs)


def test_edges(edges):
    check(edges, [(r["doc_id"], r["text"]) for r in edges.collect()])


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).collect() == []


def test_links_lose_none_at_any_place_of_the_flips(spark):
    import random

    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = set(base)
    for b in base:
        for n in (1, 2, 3, 4):
            for _ in range(6):
                x = b
                for bit in rng.sample(range(64), n):
                    x ^= 1 << bit
                fps.add(x)
    for bits in itertools.combinations((0, 15, 16, 31, 32, 47, 48, 63), 3):
        fps.add(base[0] ^ sum(1 << b for b in bits))
    frame = spark.createDataFrame([(as_long(x),) for x in fps], "fp long")
    got = {(r["a"], r["b"]) for r in simhash.links(frame).collect()}
    want = {
        tuple(sorted((as_long(x), as_long(y))))
        for x, y in itertools.combinations(fps, 2)
        if (x ^ y).bit_count() <= 3
    }
    assert got == want


def test_more_bits_than_the_ring_allows_is_an_error(spark):
    with pytest.raises(ValueError, match="chain budgets"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)


def test_components_of_a_long_chain_a_star_and_a_loop(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(200, 300)]
    edges = spark.createDataFrame([*chain, *star, (7, 7), (400, 300 + 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(edges).collect()}
    assert {got[i] for i in range(100, 161)} == {100}
    assert {got[i] for i in (5, *range(200, 300))} == {5}
    assert got[500] == 400 and 7 not in got


def test_stage_keeps_one_row_of_each_group(spark, edges):
    kept = simhash.keep_one(spark, edges, "")
    assert kept.columns == edges.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # 1, 2 and 3 hold no word; 6 and 7 are copies; the row without an id stands alone.
    assert sorted(x for x in ids if x is not None) == [1, 4, 5, 6, 8, 9]


def test_stage_tells_rows_of_one_id_apart(spark):
    """Ids that repeat or are NULL: one row of each group stays, whatever the id."""
    words = lambda tag: " ".join(f"{tag}{i * i % 101}" for i in range(60))
    rows = [(7, words("a")), (7, words("b")), (7, words("b")), (8, words("b")), (9, words("c"))]
    rows += [(None, words(t)) for t in "cdefdd"] + [(6, words("f"))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r["doc_id"], r["text"]) for r in simhash.keep_one(spark, docs, "").collect()]
    want = [(7, "a"), (7, "b"), (9, "c"), (None, "d"), (None, "e"), (6, "f")]
    assert sorted(got, key=str) == sorted(((i, words(t)) for i, t in want), key=str)
