"""Approximate nearest neighbours by collision counting over single projections."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandloom.llm.common import table
from demandloom.session import materialize

# Vectors whose sorted projections one task holds, and queries it answers with them.
BLOCK_ROWS = 16_384
BLOCK_QUERIES = 512
PROJECTIONS = 48
# Share of the projections in which a vector has to lie in the query's window, and
# share of a block that has to do so before the windows stop growing. The embeddings
# measured (64 dimensions, neighbours at 0.35 to 0.45) need wide windows.
COLLISIONS = 0.65
VERIFIED = 0.3
# Small blocks verify this many, as shares of a few vectors say little.
LEAST = 1000
# First half-width in standard deviations of the projections, and its growth.
RADIUS, GROWTH = 0.7, 1.1
SEED = 5


class Index:
    """Sorted arrays, one per random direction, over the vectors of one block.

    Vectors are lengthened by one component to the longest norm, queries by 0: then the
    largest inner product is the least distance, which close projections hint at.
    """

    def __init__(self, ids, vectors, projections=PROJECTIONS, seed=SEED):
        import numpy as np

        self.ids, self.vectors = ids, vectors
        squares = np.einsum("ij,ij->i", vectors, vectors)
        longer = np.sqrt(np.maximum(squares.max(initial=0.0) - squares, 0.0))
        directions = np.random.default_rng(seed).standard_normal(
            (vectors.shape[1] + 1, projections)
        )
        self.directions = directions[:-1]
        projected = vectors @ directions[:-1] + np.outer(longer, directions[-1])
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(projected.T, self.order, axis=1)
        self.spread = float(projected.std()) or 1.0

    def candidates(self, query, collisions=COLLISIONS, verified=VERIFIED, least=LEAST):
        """Vectors in the windows of enough projections, once enough vectors are.

        The windows around the query grow by virtual rehashing: each radius only adds
        the two ends by which it is wider than the last. If the windows hold everything
        everything is a candidate.
        """
        import math

        import numpy as np

        n, m = len(self.ids), len(self.sorted)
        needed = math.ceil(collisions * m)
        wanted = min(max(math.ceil(verified * n), least), n)
        count = np.zeros(n, dtype=np.int64)
        centre = query @ self.directions
        low = [int(s.searchsorted(c)) for s, c in zip(self.sorted, centre, strict=True)]
        high = list(low)
        radius = RADIUS * self.spread
        while True:
            added = []
            for j in range(m):
                line, order = self.sorted[j], self.order[j]
                left = min(int(line.searchsorted(centre[j] - radius)), low[j])
                right = max(int(line.searchsorted(centre[j] + radius, "right")), high[j])
                added += order[left : low[j]], order[high[j] : right]
                low[j], high[j] = left, right
            count += np.bincount(np.concatenate(added), minlength=n)
            found = np.flatnonzero(count >= needed)
            if len(found) >= wanted:
                return found
            radius *= GROWTH

    def nearest(self, query_id: int, query, top: int):
        """``(ids, scores)`` of the best candidates, by exact double inner product."""
        import numpy as np

        found = self.candidates(query, least=max(LEAST, top + 1))
        found = found[self.ids[found] != query_id]
        rough = self.vectors[found] @ query
        if len(found) > top:
            # The fast product rounds by position; anything near the last place stays.
            last = np.partition(rough, len(rough) - top)[len(rough) - top]
            found = found[rough >= last - 1e-9 * max(1.0, abs(last))]
        scores = (self.vectors[found] * query).sum(axis=1)
        best = np.lexsort((self.ids[found], -scores))[:top]
        return self.ids[found][best], scores[best]


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding, dim)`` of rows with an id and a finite vector other than zero."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.exists("embedding", lambda x: F.coalesce(bad(x), F.lit(True)))
        & F.exists("embedding", lambda x: F.coalesce(x != 0, F.lit(False)))
    ).select(F.col("vec_id").cast("long"), "embedding", F.size("embedding").alias("dim"))


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    top: int,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``top`` best of ``vectors`` found per query.

    Both frames hold ``vec_id`` and ``embedding``. Vectors are dealt into blocks by a hash
    of id and vector, so that every block is a fair sample whatever is common in the
    data; each block of queries meets each block of vectors in a task of its own, of
    bounded size, and the best of all blocks are merged. Ties go to the smaller id. Rows
    with the query's id are its own. Vectors that are NULL, zero, or hold NULL or
    numbers that are not finite take no part, nor do rows without an id; vectors only
    meet queries of their length. Repeated rows are candidates each; a query id on
    several rows is searched with the least of its vectors.
    """
    rows = materialize(usable(vectors), "vectors")
    asked = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = materialize(asked.withColumn("dim", F.size("embedding")), "queries")
    blocks = max(-(-rows.count() // block_rows), 1)
    asked_blocks = max(-(-asked.count() // block_queries), 1)
    spread = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(blocks)).cast("int")
    asked_spread = F.pmod(F.xxhash64("vec_id"), F.lit(asked_blocks)).cast("int")
    everywhere = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select("*", asked_spread.alias("part"), everywhere(blocks).alias("block"))
    right = rows.select("*", spread.alias("block"), everywhere(asked_blocks).alias("part"))

    def search(_, questions, answers):
        import numpy as np
        import pyarrow as pa

        def matrix(found):
            flat = found["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            return flat.astype(np.float64).reshape(found.num_rows, -1)

        columns: list[list] = [[], [], []]
        if questions.num_rows and answers.num_rows:
            index = Index(answers["vec_id"].to_numpy(), matrix(answers))
            ids = questions["vec_id"].to_pylist()
            for query_id, query in zip(ids, matrix(questions), strict=True):
                near, scores = index.nearest(query_id, query, top)
                for column, values in zip(columns, ([query_id] * len(near), near, scores), strict=True):
                    column.extend(values)
        names = ("query_id", "vec_id", "score")
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table(
            {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds, strict=True)}
        )

    keys = ("dim", "block", "part")
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(search, "query_id long, vec_id long, score double")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op2(spark, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)
