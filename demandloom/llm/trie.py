"""Prefix trie of conversations, by truncation peeling.

1. A conversation is the sequence of its turns, each a 128-bit digest of role and text with
   the length of the text. The texts themselves stay where they are.
2. Conversations are dealt to tasks by ranges of their sequence and id, so that those
   under one node are neighbours and however many share a prefix are split.
3. A task peels its range: from the greatest depth down it merges the conversations that
   end there with the nodes that survive from below, strips the last turn of all and
   regroups them. Nodes are found and their figures complete in that one pass.
4. Only prefixes of the first and of the last sequence of a range can reach into another
   one. These few nodes come out open, as parts, and are merged and peeled once more.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, table
from demandloom.session import materialize

# Characters of a text by which turns of one number and role are put in order.
TIE_CHARS = 64
# Ids of one end that go to its hash together.
HASHED_IDS = 1 << 16
# Open nodes that may be sent to every task; more are joined.
SENT_NODES = 200_000

# What a task tells: closed nodes, parts of open ones, and the ids that end at open ones.
CLOSED, OPEN, IDS = 0, 1, 2
PEELED = (
    "kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, "
    "chars long, ids binary"
)
FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def sequences(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turns)``: turns as ``struct<a, b, chars>`` in order.

    The order is that of ``turn``, NULL first, then of role and of the text's first
    ``TIE_CHARS`` characters, then of its digest, so repeated rows are repeated turns.
    A NULL role or text is empty. Rows without a ``conv_id`` belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.struct(
        "turn",
        role.alias("role"),
        F.left(text, F.lit(TIE_CHARS)).alias("head"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), text, role).alias("b"),
        F.char_length(text).cast("long").alias("chars"),
    )
    ordered = F.array_sort(F.collect_list("_turn"))
    return (
        conversations.where(F.col("conv_id").isNotNull())
        .select(F.col("conv_id").cast("long"), turn.alias("_turn"))
        .groupBy("conv_id")
        .agg(ordered.alias("_turns"))
        .select(
            "conv_id",
            F.transform("_turns", lambda t: F.struct(t["a"], t["b"], t["chars"])).alias("turns"),
        )
    )


def rebuilt(found: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """Every conversation with its first ``h`` turns from the first one of its family.

    ``h`` is the CRC-32 of the id in decimal modulo ``most + 1``; the family of ``c`` is
    headed by ``c - c % family``. Fewer turns than ``h`` there are all taken, none if that
    conversation is absent; ``c`` goes on with its own turns after its first ``h``.
    """
    head = F.col("conv_id") - F.col("conv_id") % family
    heads = found.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_head"), F.slice("turns", 1, most).alias("_first")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (most + 1)).cast("int")
    none = F.slice("turns", 1, 0)
    own = F.slice("turns", F.col("_h") + 1, F.size("turns"))
    return (
        found.withColumns({"_head": head, "_h": h})
        .join(heads, "_head", "left")
        .select(
            "conv_id",
            F.concat(F.coalesce(F.slice("_first", F.lit(1), F.col("_h")), none), own).alias("turns"),
        )
    )


class Range:
    """Sorted conversations of a task: one entry per distinct sequence, with its ids."""

    def __init__(self):
        from array import array

        self.bodies: list[bytes] = []
        self.ids: list = []
        self.new = lambda: array("q")

    def add(self, conv_id: int, body: bytes) -> None:
        """``body`` holds three longs per turn; equal bodies come one after the other."""
        if not self.bodies or self.bodies[-1] != body:
            self.bodies.append(body)
            self.ids.append(self.new())
        self.ids[-1].append(conv_id)

    def common(self, flat, begins, sizes):
        """Turns that each sequence has in common with the one before."""
        import numpy as np

        shared = np.zeros(len(sizes), dtype=np.int64)
        alike = np.arange(1, len(sizes))
        depth = 0
        while len(alike):
            alike = alike[np.minimum(sizes[alike], sizes[alike - 1]) > depth]
            same = (flat[begins[alike] + depth, :2] == flat[begins[alike - 1] + depth, :2]).all(axis=1)
            alike = alike[same]
            depth += 1
            shared[alike] = depth
        return shared

    def peel(self):
        """Rows of ``PEELED``, a list per depth."""
        import numpy as np

        n = len(self.bodies)
        flat = np.frombuffer(b"".join(self.bodies), dtype="<i8").reshape(-1, 3)
        sizes = np.array([len(b) // 24 for b in self.bodies], dtype=np.int64)
        begins = np.cumsum(sizes) - sizes
        shared = self.common(flat, begins, sizes)
        n_ids = np.array([len(x) for x in self.ids], dtype=np.int64)
        least = np.array([x[0] for x in self.ids], dtype=np.int64)
        first_keys, last_keys = (prefix_keys(self.bodies[i]) for i in (0, n - 1))
        by_size = np.argsort(sizes, kind="stable")
        ends_at = np.searchsorted(sizes[by_size], np.arange(sizes.max() + 2))

        # Survivors: first and last sequence of each, and its figures so far.
        alive = {c: np.empty(0, dtype=np.int64) for c in ("first", "last", "convs", "least", "leaves", "saved")}
        alive["open"] = np.empty(0, dtype=bool)
        below = None
        for depth in range(int(sizes.max()), -1, -1):
            ended = by_size[ends_at[depth] : ends_at[depth + 1]]
            zero = np.zeros(len(ended), dtype=np.int64)
            fresh = {
                "first": ended,
                "last": ended,
                "convs": n_ids[ended],
                "least": least[ended],
                "leaves": zero,
                "saved": zero,
                "open": zero.astype(bool),
            }
            rows = {c: np.concatenate([alive[c], fresh[c]]) for c in alive}
            child = np.arange(len(rows["first"])) < len(alive["first"])
            order = np.argsort(rows["first"], kind="stable")
            rows, child = {c: x[order] for c, x in rows.items()}, child[order]
            # Neighbours are one node if no sequence lies between and they share so many turns.
            starts = np.ones(len(order), dtype=bool)
            starts[1:] = (rows["first"][1:] != rows["last"][:-1] + 1) | (shared[rows["first"][1:]] < depth)
            begin = np.flatnonzero(starts)
            group = np.cumsum(starts) - 1
            first, last = rows["first"][begin], np.append(rows["last"][begin[1:] - 1], rows["last"][-1])
            convs, leaves, saved = (np.add.reduceat(rows[c], begin) for c in ("convs", "leaves", "saved"))
            smallest = np.minimum.reduceat(rows["least"], begin)
            children = np.add.reduceat((child & ~rows["open"]).astype(np.int64), begin)
            opened = (first == 0) | (last == n - 1)
            chars = flat[begins[first] + depth - 1, 2] if depth else np.zeros(len(first), np.int64)
            closed = ~opened
            leaves = leaves + (closed & (children == 0))
            saved = saved + np.where(closed, (convs - 1) * chars, 0)
            if below is not None:
                above = group[np.argsort(order, kind="stable")][: len(below["least"])]
                yield from self._told(below, smallest[above], opened[above], first[above], first_keys, last_keys)
            ending = np.full(len(first), -1, dtype=np.int64)
            ending[group[~child]] = rows["first"][~child]
            below = {
                "depth": depth, "first": first, "least": smallest, "convs": convs, "children": children,
                "leaves": leaves, "saved": saved, "chars": chars, "open": opened, "ending": ending,
            }
            # An open node is counted where its parts meet; here it only holds its place.
            hold = lambda x, empty=0: np.where(opened, empty, x)
            alive = {
                "first": first, "last": last, "convs": hold(convs), "leaves": hold(leaves),
                "saved": hold(saved), "least": hold(smallest, np.iinfo(np.int64).max), "open": opened,
            }
        none = np.zeros(len(below["least"]), dtype=np.int64)
        yield from self._told(below, none, none == 0, none, first_keys, last_keys)

    def _told(self, nodes, parents, in_open, parent_first, first_keys, last_keys):
        import hashlib

        depth = nodes["depth"]
        nothing = hashlib.sha256().hexdigest()

        def key(first: int, at: int) -> bytes:
            return (first_keys if first == 0 else last_keys)[at]

        columns: list[tuple] = []
        for i in range(len(nodes["least"])):
            first, ending = int(nodes["first"][i]), int(nodes["ending"][i])
            opened = bool(nodes["open"][i])
            above = key(int(parent_first[i]), depth - 1) if depth and in_open[i] else None
            figures = [int(nodes[c][i]) for c in ("convs", "children", "leaves", "saved")]
            if opened:
                own = key(first, depth)
                columns.append((OPEN, own, above, int(nodes["least"][i]), depth, None, *figures, None, int(nodes["chars"][i]), None))
                if ending >= 0:
                    ids = self.ids[ending]
                    for at in range(0, len(ids), HASHED_IDS):
                        part = ids[at : at + HASHED_IDS]
                        listed = ",".join(map(str, part)).encode()
                        columns.append((IDS, own, None, part[0], depth, *[None] * 7, listed))
            else:
                sha = nothing
                if ending >= 0:
                    sha = hashlib.sha256(",".join(map(str, self.ids[ending])).encode()).hexdigest()
                parent = None if above is not None else int(parents[i])
                columns.append((CLOSED, None, above, int(nodes["least"][i]), depth, parent, *figures, sha, None, None))
        yield columns


def prefix_keys(body: bytes) -> list[bytes]:
    """128-bit keys of a sequence's prefixes, from the empty one on."""
    import hashlib

    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for at in range(0, len(body), 24):
        state.update(body[at : at + 16])
        keys.append(state.digest())
    return keys


def peeled(found: DataFrame) -> DataFrame:
    """``PEELED`` of every range of the sorted sequences."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = Range()
        for batch in batches:
            turns = batch.column("turns")
            flat = turns.flatten()
            three = np.stack([flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            raw = np.ascontiguousarray(three, dtype="<i8").tobytes()
            at = 0
            for conv_id, size in zip(
                batch.column("conv_id").to_pylist(), turns.value_lengths().to_pylist(), strict=True
            ):
                held.add(conv_id, raw[at : at + 24 * size])
                at += 24 * size
        if held.bodies:
            for rows in held.peel():
                for at in range(0, len(rows), 10_000):
                    part = zip(*rows[at : at + 10_000], strict=True)
                    arrays = [pa.array(c, t) for c, t in zip(part, schema.types, strict=True)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    schema = arrow_schema(PEELED)
    ranged = found.repartitionByRange("turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    return ranged.select("conv_id", "turns").mapInArrow(run, PEELED)


def merged(parts: DataFrame) -> DataFrame:
    """Open nodes from their parts, peeled from the greatest depth down.

    They are prefixes of the first or last sequence of a range: two per range and depth,
    whatever the number of conversations, so that one task takes them.
    """
    layout = (
        "key binary, conv_id long, depth long, parent_conv_id long, n_convs long, "
        "n_children long, n_leaves long, saved_tokens long"
    )

    def run(batches):
        import pyarrow as pa

        by_depth: dict[int, dict] = {}

        def put(depth, key, parent, conv_id, figures, chars):
            level = by_depth.setdefault(depth, {})
            node = level.setdefault(key, [parent, conv_id, [0] * 4, None])
            node[1] = min(node[1], conv_id)
            node[2] = [a + b for a, b in zip(node[2], figures, strict=True)]
            node[3] = chars if chars is not None else node[3]

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("depth", "key", "parent_key", "conv_id", *FIGURES, "chars")]
            for depth, key, parent, conv_id, *figures, chars in zip(*columns, strict=True):
                put(depth, key, parent, conv_id, figures, chars)
        for depth in range(max(by_depth, default=-1), -1, -1):
            for parent, conv_id, figures, chars in by_depth[depth].values():
                n_convs, children, leaves, saved = figures
                figures[2] = leaves + (children == 0)
                figures[3] = saved + (n_convs - 1) * chars
                if depth:
                    put(depth - 1, parent, None, conv_id, [n_convs, 1, figures[2], figures[3]], None)
        for depth, level in by_depth.items():
            above = by_depth.get(depth - 1, {})
            rows = [
                (key, conv_id, depth, above[parent][1] if depth else None, *figures)
                for key, (parent, conv_id, figures, _) in level.items()
            ]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    schema = arrow_schema(layout)
    return parts.coalesce(1).mapInArrow(run, layout)


def hashed_ids(parts: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of open nodes: their lists of ids, in order, as one stream each."""

    def run(batches):
        import hashlib

        import pyarrow as pa

        latest, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key == latest:
                    state.update(b"," + ids)
                    continue
                if state is not None:
                    done.append((latest, state.hexdigest()))
                latest, state = key, hashlib.sha256(ids)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([latest]), pa.array([state.hexdigest()])], schema=schema)

    layout = "key binary, ends_sha256 string"
    schema = arrow_schema(layout)
    dealt = parts.select("key", "conv_id", "ids").repartition("key").sortWithinPartitions("key", "conv_id")
    return dealt.select("key", "ids").mapInArrow(run, layout)


def prefix_trie(found: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the conversations ``(conv_id, turns)``.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent, NULL at the
    root; ``depth`` counts turns; ``n_convs`` members, ``n_children`` children and
    ``n_leaves`` childless nodes of the subtree, top included; ``saved_tokens`` sums each
    node's members but one times the characters of its last text over the subtree;
    ``ends_sha256`` hashes the ids of the members that end here, ascending, in decimal and
    with commas. Ids are unique and not NULL, as from ``sequences``. Equal conversations,
    however many, are one sequence of a task; a conversation without turns is a member of
    the root only; no conversation makes no node. The turns of one conversation are
    the unit of memory, 24 bytes each.
    """
    written = materialize(found.select("conv_id", "turns"), "sequences")
    told = materialize(peeled(written), "peeled")
    parts = told.where(F.col("kind") == OPEN)
    ends = hashed_ids(told.where(F.col("kind") == IDS))
    empty = F.sha2(F.lit("").cast("binary"), 256)
    nodes = merged(parts).join(ends, "key", "left")
    nodes = materialize(nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", empty)), "open-nodes")
    names = nodes.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_above"))
    if nodes.count() <= SENT_NODES:
        names = F.broadcast(names)
    closed = told.where(F.col("kind") == CLOSED).join(names, "parent_key", "left")
    closed = closed.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    columns = ("conv_id", "depth", "parent_conv_id", *FIGURES, "ends_sha256")
    return closed.select(*columns).unionByName(nodes.select(*columns))


def op13(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(sequences(table(spark, sf_dir, "conversations"))))
