"""Exact largest inner products of integer vectors, by columnar branch-and-bound.

Vectors lie in blocks, dimension by dimension. Products are accumulated some dimensions
at a time; what the remaining dimensions can add is at most the product of the remaining
lengths of query and vector. A vector that cannot reach the query's floor any more goes,
and the survivors are compacted. The floor is the score of the k-th best found so far, which
only rises: blocks are searched in waves, each much larger than all before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.llm.common import arrow_schema, table
from demandloom.session import materialize

# Vectors of one block and queries that meet it in one task, and the bytes of either.
BLOCK_ROWS = 8192
QUERY_ROWS = 16_384
BLOCK_BYTES = 64 << 20
# A wave has this many times the blocks of all waves before it.
WAVE = 16
# Dimensions accumulated between two looks at the bounds, and queries taken together.
STEP = 16
BATCH = 64
# Share of pairs left at which the survivors are compacted.
SPARSE = 0.25
# Vectors of a block scored in full where a query has no floor yet.
SEEDS = 1024

BLOCKS = "block int, dim int, width int, rows int, ids binary, floors binary, columns binary"
# The floor of a query with too few candidates so far.
NO_FLOOR = -(1 << 63)
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """``(vec_id, vector)``: every component, as a double, times ``scale``, rounded down.

    Rows without an id or vector, or with a component that is NULL or not finite, are
    left out. A zero vector stays. An empty vector has nothing to multiply and scores 0.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: F.coalesce(bad(x), F.lit(True)))
    ).select(
        F.col("vec_id").cast("long"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
    )


def vertical(vectors: DataFrame, rows_each: int, rows: int) -> DataFrame:
    """``vectors`` dealt evenly into blocks of about ``rows_each`` rows, as ``BLOCKS``.

    The number of a block is its partition's. ``columns`` holds the first component of all
    vectors, then the second and so on, as signed integers of ``width`` bytes, the least
    that fits. Vectors of another length, or beyond ``BLOCK_BYTES``, make rows of their own.
    ``floors`` holds a column ``floor`` of the vectors if there is one.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        block = TaskContext.get().partitionId()
        held: dict[int, list] = {}

        def release(dim):
            ids, floors, parts = map(np.concatenate, zip(*held.pop(dim), strict=True))
            low, high = int(parts.min(initial=0)), int(parts.max(initial=0))
            kinds = [np.dtype(k) for k in ("<i1", "<i2", "<i4", "<i8")]
            kind = next(k for k in kinds if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
            columns = np.ascontiguousarray(parts.T, dtype=kind).tobytes()
            row = [block, dim, kind.itemsize, len(ids), ids.tobytes(), floors.tobytes(), columns]
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip(row, schema.types, strict=True)], schema=schema
            )

        for batch in batches:
            lists = batch.column("vector")
            dims = lists.value_lengths().to_numpy()
            ids, floors = (batch.column(c).to_numpy().astype("<i8") for c in ("vec_id", "floor"))
            for dim in map(int, np.unique(dims)):
                mine = np.flatnonzero(dims == dim)
                flat = lists.take(pa.array(mine)).flatten().to_numpy(zero_copy_only=False)
                part = flat.astype("<i8").reshape(len(mine), dim)
                held.setdefault(dim, []).append((ids[mine], floors[mine], part))
                if sum(p.nbytes for _, _, p in held[dim]) > BLOCK_BYTES:
                    yield release(dim)
        for dim in list(held):
            yield release(dim)

    schema = arrow_schema(BLOCKS)
    floor = F.col("floor") if "floor" in vectors.columns else F.lit(NO_FLOOR)
    columns = ("vec_id", "vector", floor.cast("long").alias("floor"))
    parts = max(-(-rows // rows_each), 1)
    return vectors.select(*columns).repartition(parts).mapInArrow(run, BLOCKS)


class Block:
    """Vectors of one block by dimension, those of most mass first, with remaining lengths."""

    def __init__(self, ids, columns):
        import numpy as np

        self.ids = ids
        mass = (columns.astype(np.float64) ** 2).sum(axis=1)
        self.order = np.argsort(-mass, kind="stable")
        self.columns = columns[self.order]
        self.longest = float(np.sqrt((columns.astype(np.float64) ** 2).sum(axis=0).max(initial=0)))
        self.remaining = remaining(self.columns)

    def best(self, query_ids, queries, floors, top: int):
        """``(query, vector, score)`` arrays: the ``top`` best of each query that reach its floor.

        ``queries`` are rows, ``query`` and ``vector`` places in them and in the block. Rows
        with the query's own id do not count.
        """
        import numpy as np

        longest = float(np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
        # No sum, whole or partial, is larger than the product of the two lengths.
        kind, slack = number_kind(longest * self.longest)
        columns = self.columns.astype(kind)
        remain = self.remaining.astype(np.float32 if kind == np.float32 else np.float64)
        found = []
        for at in range(0, len(queries), BATCH):
            mine = slice(at, at + BATCH)
            q = queries[mine][:, self.order].astype(kind)
            row, col, score = self._batch(
                query_ids[mine], q, floors[mine].copy(), top, columns, remain, slack
            )
            found.append((row + at, col, score))
        return (np.concatenate(x) for x in zip(*found, strict=True))

    def _batch(self, query_ids, q, floors, top, columns, remain, slack):
        import numpy as np

        unknown = np.flatnonzero(floors == NO_FLOOR)
        if len(unknown) and len(self.ids) >= top:
            seeds = (q[unknown] @ columns[:, :SEEDS]).astype(np.int64)
            seeds[query_ids[unknown, None] == self.ids[:SEEDS]] = NO_FLOOR
            if seeds.shape[1] >= top:
                floors[unknown] = np.partition(seeds, -top, axis=1)[:, -top]
        low = floors.astype(remain.dtype) - remain.dtype.type(slack)
        mine = remaining(q.T).astype(remain.dtype)
        sums = np.zeros((len(q), columns.shape[1]), dtype=q.dtype)
        pairs = None
        for step, at in enumerate(range(0, len(columns), STEP)):
            dims = slice(at, at + STEP)
            if pairs is None:
                sums += q[:, dims] @ columns[dims]
                alive = sums + mine[step + 1][:, None] * remain[step + 1] >= low[:, None]
                if alive.mean() <= SPARSE or at + STEP >= len(columns):
                    pairs = np.nonzero(alive)
                    sums = sums[pairs]
            else:
                row, col = pairs
                sums = sums + np.einsum("ij,ji->i", q[row, dims], columns[dims, col])
                alive = sums + mine[step + 1][row] * remain[step + 1][col] >= low[row]
                pairs, sums = (row[alive], col[alive]), sums[alive]
        if pairs is None:  # vectors without components
            pairs = np.nonzero(np.ones(sums.shape, dtype=bool))
            sums = sums[pairs]
        row, col = pairs
        score = sums.astype(np.int64)
        fit = (self.ids[col] != query_ids[row]) & (score >= floors[row])
        row, col, score = row[fit], col[fit], score[fit]
        order = np.lexsort((self.ids[col], -score, row))
        row, col, score = row[order], col[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        first = rank < top
        return row[first], col[first], score[first]


def remaining(columns):
    """Lengths of what vectors have left after no step, the first step, ... and all steps."""
    import numpy as np

    squares = columns.astype(np.float64) ** 2
    steps = [squares[at : at + STEP].sum(axis=0) for at in range(0, len(columns), STEP)]
    left = np.zeros((len(steps) + 1, columns.shape[1]))
    for step in range(len(steps) - 1, -1, -1):
        left[step] = left[step + 1] + steps[step]
    return np.sqrt(left)


def number_kind(bound: float):
    """The fastest kind of number in which sums up to ``bound`` are exact, and the room that
    comparisons of rounded bounds need."""
    import numpy as np

    for kind, whole in ((np.float32, 2.0**24), (np.float64, 2.0**53)):
        if bound < whole:
            return kind, 2 + 16 * bound * float(np.finfo(kind).eps)
    # Products are summed modulo 2^64, so only what comes out in the end has to fit.
    if bound * 1.001 < 2.0**63:
        return np.int64, 2 + 16 * bound * float(np.finfo(np.float64).eps)
    raise OverflowError("inner products beyond 64 bits")


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    top: int,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: per query the ``top`` largest inner products.

    Both frames hold ``vec_id long`` and ``vector array<long>`` without NULLs, as from
    ``quantised``; scores are exact whole numbers, and one beyond 64 bits is an error.
    Ties go to the smaller id. Rows with the query's id are its own and no candidates;
    repeated rows are candidates each; a query id on several rows is searched with the
    least of its vectors. Vectors only meet queries of their length. Fewer candidates than
    ``top`` are all returned; an empty table gives none.

    Every block of queries meets every block of vectors, in a task of bounded size, so
    the work grows with their product; the bounds make it less, not of another kind.
    """
    rows = materialize(vectors.select("vec_id", "vector"), "vectors")
    asked = queries.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    asked = materialize(asked, "queries")
    n_rows, n_asked = rows.count(), asked.count()
    blocks, parts = (max(-(-n // each), 1) for n, each in ((n_rows, block_rows), (n_asked, query_rows)))
    held = materialize(vertical(rows, block_rows, n_rows), "blocks")
    found = _searched(vertical(asked, query_rows, n_asked), held, parts, 0, 1, top)
    best = materialize(_ranked(found, top), "best")
    first, end = 1, WAVE
    while first < blocks:
        floors = best.where(F.col("rank") == top).selectExpr("query_id AS vec_id", "score AS floor")
        raised = asked.join(floors, "vec_id", "left").withColumn(
            "floor", F.coalesce("floor", F.lit(NO_FLOOR))
        )
        asking = vertical(raised, query_rows, n_asked)
        found = _searched(asking, held, parts, first, min(end, blocks), top)
        best = materialize(_ranked(best.select(found.columns).unionByName(found), top), "best")
        first, end = end, end * WAVE
    return best


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searched(asking: DataFrame, held: DataFrame, parts: int, first: int, end: int, top: int) -> DataFrame:
    """Best pairs of every part of the queries with every block from ``first`` to before ``end``."""

    def each(begin, stop):
        return F.explode(F.sequence(F.lit(begin), F.lit(stop - 1)))

    left = asking.withColumnRenamed("block", "part").withColumn("block", each(first, end))
    right = held.where(F.col("block").between(first, end - 1)).withColumn("part", each(0, parts))

    def search(questions, answers):
        import numpy as np
        import pyarrow as pa

        def matrix(row):
            flat = np.frombuffer(row["columns"], dtype=f"<i{row['width']}")
            return flat.reshape(row["dim"], row["rows"])

        found: list[tuple] = [(np.empty(0, np.int64),) * 3]
        for answer in answers.to_pylist():
            block = Block(np.frombuffer(answer["ids"], "<i8"), matrix(answer))
            for question in questions.to_pylist():
                ids, floors = (np.frombuffer(question[c], "<i8") for c in ("ids", "floors"))
                row, col, score = block.best(ids, matrix(question).T, floors, top)
                found.append((ids[row], block.ids[col], score))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)]
        return pa.table(columns, names=["query_id", "vec_id", "score"])

    keys = ("part", "dim", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)


def op12(spark, sf_dir: str) -> DataFrame:
    vectors = quantised(table(spark, sf_dir, "embeddings"), 64)
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)
