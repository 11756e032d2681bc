import re
from collections import Counter

import corpus_pipeline
from demandloom.llm import bpe, catalogue, packing, suffixes
from demandloom.session import materialize
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"


def without_passages(texts):
    """Each text without the whole words of repeated stretches that hold over 50, by the definition."""
    size = suffixes.PASSAGE_BYTES
    times = Counter(t[i : i + size] for t in texts for i in range(len(t) - size + 1))
    for text in texts:
        gone = bytearray(len(text))
        for i in range(len(text) - size + 1):
            if times[text[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        left = bytearray(text)
        for run in reversed(list(re.finditer(b"\1+", gone))):
            words = [
                w.span()
                for w in re.finditer(rb"[^\x20\x09-\x0D]+", text)
                if run.start() <= w.start() and w.end() <= run.end()
            ]
            if len(words) > 50:
                begin = words[0][0] if run.start() else 0
                end = words[-1][1] if run.end() < len(text) else len(text)
                del left[begin:end]
        yield bytes(left)


def test_stages_against_their_own_inputs(spark):
    """Each stage on what the last one kept, with the two exact ones against brute force."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns
        kept[name] = (before, docs)
    for name in ("quality rules", "quality classifier", "simhash near-dedup"):
        before, after = kept[name]
        assert after.exceptAll(before).isEmpty()
    assert kept["quality rules"][1].count() < kept["quality rules"][0].count()
    before, after = (x.orderBy("doc_id").collect() for x in kept["suffix-array dedup"])
    want = list(without_passages([r["text"].encode() for r in before]))
    assert any(body != r["text"].encode() for r, body in zip(before, want, strict=True))
    for r, s, body in zip(before, after, want, strict=True):
        assert s["text"] == body.decode("utf-8", "ignore") and s["doc_id"] == r["doc_id"]
        assert s["n_chars"] == (len(s["text"]) if s["text"] != r["text"] else r["n_chars"])
    rows = corpus_pipeline.run(spark, SF).collect()
    tokenizer = Tokenizer.from_file(packing.TOKENIZER)
    tokens = {r["doc_id"]: len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1 for r in after}
    length = {}
    for r in rows:
        length[r["doc_id"]] = length.get(r["doc_id"], 0) + r["length"]
        assert r["doc_tokens"] == tokens[r["doc_id"]]
    assert length == tokens


def test_stages_on_edges(spark, edges):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, edges, SF)
        assert done.columns == edges.columns
        assert done.schema.simpleString() == edges.schema.simpleString()
    assert corpus_pipeline.STAGES[-1][1](spark, edges, SF).count() >= edges.count()


def test_stages_on_nothing(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).collect() == []


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalogue.QUERIES)
    assert numbers == list(range(1, 14))
    assert bpe.op10 in catalogue.QUERIES.values()
