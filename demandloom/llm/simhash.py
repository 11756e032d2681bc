"""Near-duplicates by SimHash; candidate pairs by pigeonring filtering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import documents, map_rows
from demandloom.llm.components import connected_components
from demandloom.llm.suffixes import keyed
from demandloom.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
SEGMENTS = 4
WIDTH = 16


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles of UTF-8 text, repeats included; no word gives 0.

    ``bytes.lower`` lowers A-Z only and ``bytes.split`` cuts at the six ASCII blanks.
    """
    import numpy as np
    import xxhash

    words = data.lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, 42) for g in grams], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def with_fingerprint(docs: DataFrame, *carried: str) -> DataFrame:
    """``(doc_id, fp)``: the 64 bits as a signed long; a NULL text has no word.

    The longs ``carried`` stand between them.
    """
    names = ("doc_id", *carried)

    def make(columns):
        found = []
        for text in columns["text"]:
            value = fingerprint((text or "").encode())
            found.append(value - (1 << 64) if value >> 63 else value)
        return {**{n: columns[n] for n in names}, "fp": found}

    schema = ", ".join(f"{n} long" for n in (*names, "fp"))
    return map_rows(docs.select(*names, "text"), make, schema)


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, WIDTH * (i % SEGMENTS)).bitwiseAND(F.lit((1 << WIDTH) - 1))


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs ``(a, b)`` of distinct fingerprints ``fp`` at ``max_bits`` or fewer differing bits.

    Pigeonring: with the 64 bits as a ring of 4 segments and at most 3 differences,
    some segment starts a chain whose first ``n`` segments differ in at most
    ``n * 3 / 4`` bits for every ``n``: none in the first, one in the first two, two
    in the first three. The first two steps are the join key: the two segments, the
    second one also with each single bit flipped on the probing side. That is 68
    probes per fingerprint, whatever their number, and a key of 32 bits instead of
    the 16 of a plain pigeonhole. The third step and then the whole distance are
    checked on what the join finds.
    """
    if not 0 <= max_bits < SEGMENTS:
        raise ValueError("the chain budgets hold for 0 to 3 differing bits")
    fp = F.col("fp")
    keys = [
        F.struct(
            F.lit(i).alias("start"),
            F.shiftleft(_segment(fp, i), WIDTH).bitwiseOR(_segment(fp, i + 1)).alias("key"),
        )
        for i in range(SEGMENTS)
    ]
    index = fps.select(F.col("fp").alias("b"), F.inline(F.array(*keys)))
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << j).cast("long") for j in range(WIDTH)))
    probe = (
        fps.select(F.col("fp").alias("a"), F.inline(F.array(*keys)))
        .select("a", "start", "key", F.explode(flips).alias("flip"))
        .select("a", "start", F.col("key").bitwiseXOR(F.col("flip")).alias("key"))
    )
    differ = F.col("a").bitwiseXOR(F.col("b"))
    third = [F.when(F.col("start") == i, F.bit_count(_segment(differ, i + 2))) for i in range(SEGMENTS)]
    second = [F.when(F.col("start") == i, F.bit_count(_segment(differ, i + 1))) for i in range(SEGMENTS)]
    return (
        # The planner knows the sizes before the keys are exploded, and would broadcast them.
        probe.join(index.hint("merge"), ["start", "key"])
        .where(F.col("a") != F.col("b"))
        .where(F.coalesce(*second) + F.coalesce(*third) <= 2)
        .where(F.bit_count(differ) <= max_bits)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    )


def groups(found: DataFrame, least: Column, max_bits: int = MAX_BITS) -> DataFrame:
    """``(fp, first, component)`` per fingerprint of ``found``; ``first`` is its ``least``."""
    nodes = materialize(found.groupBy("fp").agg(least.alias("first")), "nodes")
    linked = connected_components(links(nodes.select("fp"), max_bits))
    return nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )


def near_duplicates(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest ``doc_id`` that a document reaches by links.

    Equal fingerprints are one node, so a group of copies costs one row however large.
    Documents without a word share fingerprint 0. A NULL ``doc_id`` counts as larger
    than any other; a component of such rows only has a NULL ``component_id``.
    Repeated rows give repeated results; an empty table gives none; further columns
    are ignored.
    """
    found = materialize(with_fingerprint(docs), "fingerprints")
    classes = groups(found, F.min("doc_id"), max_bits)
    smallest = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = materialize(classes.join(smallest, "component").select("fp", "component_id"), "classes")
    return found.join(named, "fp").select("doc_id", "fp", "component_id")


def op9(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def keep_one(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near-duplicates one row.

    That of the smallest ``doc_id``, NULL last, and among rows of one id that of the
    smallest text hash. Rows are told apart by id and text, so ids may repeat or be
    NULL; of rows equal in both one stays.
    """
    rows = keyed(docs).drop("_bytes")
    narrow = rows.select("_row.doc_id", "_row.text", "_a", "_b")
    found = materialize(with_fingerprint(narrow, "_a", "_b"), "near-duplicates")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_a", "_b"))
    kept = groups(found, least).groupBy("component").agg(F.min("first").alias("first"))
    kept = materialize(kept.select("first._a", "first._b"), "kept")
    keys = ["_a", "_b"]
    # Keys that occur on several rows. Usually there are none.
    often = found.groupBy(*keys).count().where("count > 1").select(*keys)
    often = materialize(often, "often")
    chosen = rows.join(kept, keys, "left_semi")
    if not often.isEmpty():
        once = chosen.join(often, keys, "left_anti")
        chosen = once.unionByName(chosen.join(often, keys, "left_semi").dropDuplicates(keys))
    return chosen.select("_row.*")
