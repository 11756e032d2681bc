import base64
import hashlib

import numpy as np
import pytest
import regex
import tiktoken
from demandloom.llm import bpe
from hypothesis import given, settings
from hypothesis import strategies as st


@pytest.fixture(scope="module")
def library():
    with open(bpe.RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={}
    ).encode_ordinary


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.RANKS, bpe.PATTERN)


def ids_of(codec, texts):
    numbers = [[codec[s] for s in bpe.stretches(t, codec.find)] for t in texts]
    codec.learn()
    found = list(codec.put_together(numbers))
    assert [body for _, body in found] == [t.encode() for t in texts]
    return [np.frombuffer(ids, dtype="<u4").tolist() for ids, _ in found]


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet=" \n\t aé's1٣.!中😀\x1c", max_size=30))
def test_stretches_part_between_matches(text):
    find = regex.compile(bpe.PATTERN).findall
    parts = bpe.stretches(text, find)
    assert "".join(parts) == text
    assert [m for p in parts for m in find(p)] == find(text)


def test_words_of_all_kinds(codec, library):
    texts = [
        "",
        " ",
        "a" * 999,
        "aaab" * 300,
        "abab" * 257 + "a",
        "naïve façade — 中文字符 😀😀😀 ́́",
        "it's we'll  two  blanks\n\n\nand\tlines \n end ",
        "0123456789" * 40,
        "<|endoftext|>",
        "\x00\x01\x7f ",
    ]
    assert ids_of(codec, texts) == [library(t) for t in texts]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.text(max_size=25), min_size=1, max_size=4))
def test_any_text(codec, library, texts):
    assert ids_of(codec, texts) == [library(t) for t in texts]


def check(docs, library):
    pairs = [(r["doc_id"], r["text"] or "") for r in docs.select("doc_id", "text").collect()]
    got = sorted(
        ((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.encode(docs).collect()),
        key=str,
    )
    want = sorted(
        ((i, np.array(library(t), dtype="<u4").tobytes(), t.encode()) for i, t in pairs), key=str
    )
    assert got == want


def test_given_documents(corpus, library):
    check(corpus[1], library)


def test_edges(edges, library):
    check(edges, library)


def test_empty(nothing):
    assert bpe.encode(nothing).collect() == []


def test_query_digests(spark, library):
    got = {r["doc_id"]: r for r in bpe.op10(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    for r in docs:
        ids = np.array(library(r["text"]), dtype="<u4").tobytes()
        row = got[r["doc_id"]]
        assert row["n_tokens"] * 4 == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(ids).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
