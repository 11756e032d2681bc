"""Shards of near-equal bytes by histogram sort."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from demandloom.llm.common import documents, n_bytes
from demandloom.session import materialize

LOW, HIGH = -(1 << 63), 1 << 63
# Candidate boundaries per open splitter and round.
PROBES = 64
# Distance from the wanted byte count, as a share of a shard: within it a boundary is
# good enough if it cuts no group of equal texts, else refining goes on.
TOLERANCE = 0.002
# Bytes of a shard's part, which one task sorts.
RANGE_BYTES = 128 << 20

Key = tuple[int, int]


def counts_below(keyed: DataFrame, edges: list[Key]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows of keys ``(h, id)`` below each of the sorted ``edges``.

    A task bins its rows between the edges and sends one row per bin that it met.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        # Edges as one row of unsigned pairs; a structured search is slow, so search
        # h first and look at ids only where an edge has the same h.
        eh = np.array([h for h, _ in edges], dtype=np.int64)
        ed = np.array([d for _, d in edges], dtype=np.int64)
        size = np.zeros(len(edges) + 1, dtype=np.int64)
        rows = np.zeros(len(edges) + 1, dtype=np.int64)
        for batch in batches:
            h, d, s = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            at = np.searchsorted(eh, h, "left")
            same = np.searchsorted(eh, h, "right") - at
            for i in np.unique(at[same > 0]):
                mine = (at == i) & (same > 0)
                ids = ed[i : i + same[mine][0]]
                at[mine] += np.searchsorted(ids, d[mine], "right")
            np.add.at(size, at, s)
            np.add.at(rows, at, 1)
        met = np.flatnonzero(rows)
        yield pa.RecordBatch.from_pydict(
            {"bin": met.astype("int32"), "size": size[met], "rows": rows[met]}
        )

    # Bins are as many as edges: a few thousand rows reach the driver, whatever the input.
    parts = keyed.select("_h", "_id", "size").mapInArrow(run, "bin int, size long, rows long")
    found = parts.groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
    size, rows = [0] * (len(edges) + 1), [0] * (len(edges) + 1)
    for r in found.collect():
        size[r["bin"]], rows[r["bin"]] = r["size"], r["rows"]
    below = lambda xs: [sum(xs[: i + 1]) for i in range(len(edges))]
    return below(size), below(rows)


def _between(low: Key, high: Key, probes: int) -> Iterator[Key]:
    """Keys that cut the open interval evenly: by ``h``, and by ``id`` inside one ``h``."""
    if low[0] == high[0] or (high[0] == low[0] + 1 and high[1] == LOW):
        top = high[1] if low[0] == high[0] else HIGH
        step = max((top - low[1]) // probes, 1)
        yield from ((low[0], d) for d in range(low[1] + step, top, step))
    else:
        step = max((high[0] - low[0]) // probes, 1)
        yield from ((h, LOW) for h in range(low[0] + step, high[0] + 1, step) if (h, LOW) < high)


def splitters(
    keyed: DataFrame, wanted: list[int], slack: int, probes: int = PROBES
) -> list[tuple[Key, int, int]]:
    """For each wanted byte count a key with about so many bytes below, and bytes and rows there.

    Every round counts exactly at candidate keys inside the interval that still holds
    each open splitter. A splitter is done when a boundary between two groups lies
    within ``slack``, or when its interval holds no further key; then it is the end
    of the interval nearer to the wanted count.
    """
    total = keyed.agg(F.sum("size").alias("s"), F.count("*").alias("n")).first()
    ends = ((LOW, LOW), 0, 0), ((HIGH, LOW), total["s"] or 0, total["n"])
    spans = [ends for _ in wanted]
    done: list[tuple[Key, int, int] | None] = [None] * len(wanted)
    while None in done:
        edges = sorted(
            {
                key
                for (low, high), mark in zip(spans, done, strict=True)
                if mark is None
                for key in _between(low[0], high[0], probes)
                if key[0] < HIGH
            }
        )
        size, rows = counts_below(keyed, edges) if edges else ([], [])
        known = list(zip(edges, size, rows, strict=True))
        for i, (want, mark) in enumerate(zip(wanted, done, strict=True)):
            if mark is not None:
                continue
            low, high = spans[i]
            inside = known[bisect_left(edges, low[0]) : bisect_left(edges, high[0])]
            for point in inside:
                if point[1] <= want and point[0] > low[0]:
                    low = point
                elif point[1] > want:
                    high = point
                    break
            moved, spans[i] = (low, high) != spans[i], (low, high)
            near = min((low, high), key=lambda p: abs(p[1] - want))
            if near[0][1] == LOW and abs(near[1] - want) <= slack:
                done[i] = near
            elif high[2] - low[2] <= 1 or low[1] == want or not moved and not inside:
                done[i] = near
    return done


def _as_long(value: int) -> Column:
    return F.lit(value).cast("long")


def _reached(key: Key) -> Column:
    """Whether a row's key is at or above ``key``."""
    if key[0] >= HIGH:
        return F.lit(False)
    h, d = _as_long(key[0]), _as_long(key[1])
    return (F.col("_h") > h) | ((F.col("_h") == h) & (F.col("_id") >= d))


def shard_by_bytes(
    docs: DataFrame,
    shards: int,
    tolerance: float = TOLERANCE,
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot``, by the law ``bytes``.

    ``size`` is the UTF-8 bytes of the text plus 8; a NULL text has none and is a group
    of its own. Rows are ordered by a hash of the text, then ``doc_id`` (NULL first),
    so equal texts are neighbours: a splitter cuts a group only where no boundary
    between groups is within the tolerance, as for a group larger than a shard. For
    the slots each shard is dealt by a hash of the key into parts of about
    ``range_bytes``, which also spreads a hot group; the counts of the parts, one line
    each, give every part its first slot, so the rows are exchanged once, part by part,
    and no task holds a shard. Rows equal in text and ``doc_id`` stay in one part. An
    empty table gives none. Columns of ``docs`` that carry one of the added names are
    replaced.
    """
    size = (n_bytes(F.col("text")) + 8).alias("size")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32")
    h = F.when(F.col("text").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("text"))
    row_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(LOW + 1).cast("long"))
    added = ("size", "text_crc32", "_h", "_id", "_part", "_offset", "shard", "slot")
    named = docs.select(
        *(c for c in docs.columns if c.lower() not in added),
        size,
        crc,
        h.alias("_h"),
        row_id.alias("_id"),
    )
    keyed = materialize(named.select("_h", "_id", "size"), "shard-keys")
    total = keyed.agg(F.sum("size")).first()[0] or 0
    wanted = [total * i // shards for i in range(1, shards)]
    cuts = splitters(keyed, wanted, int(tolerance * total / shards))
    shard = F.lit(0)
    for key, _, _ in cuts:
        shard = shard + _reached(key).cast("int")
    parts = max(-(-total // (shards * range_bytes)), 1)
    part = F.pmod(F.xxhash64("_h", "_id"), F.lit(parts))
    before = (
        Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = materialize(
        keyed.groupBy(shard.alias("shard"), part.alias("_part"))
        .count()
        .withColumn("_offset", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .drop("count"),
        "first-slots",
    )
    in_part = Window.partitionBy("shard", "_part").orderBy("_h", "_id")
    return (
        named.withColumn("shard", shard)
        .withColumn("_part", part)
        .join(offsets, ["shard", "_part"])
        .withColumn("slot", F.col("_offset") + F.row_number().over(in_part) - 1)
        .select(*(c for c in named.columns if c not in added), "size", "text_crc32", "shard", "slot")
    )


def op5(spark, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(documents(spark, sf_dir), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
