"""Cleaning of ingested rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demandloom.session import materialize

# Rows of a table up to which ``split_repeated`` tells them apart by one bit each, 256 MB in all.
TOLD_ROWS = 1 << 31


def drop_metadata(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop bookkeeping columns; names that are not there are ignored."""
    return df.drop(*columns)


def dedup_by_key(
    df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, the first in ``order`` (default: every other column).

    NULL keys form one group. With the default order the survivor does not
    depend on row order or partitioning. A shorter ``order`` is enough when the
    columns read downstream are all in it, and keeps the others out of the scan.

    The ``row_number() = 1`` filter is planned as a group limit before the
    exchange, so every task sends at most one row per key: a key that holds a
    third of all rows costs as many shuffled rows as there are tasks.
    """
    missing = [c for c in [*key, *(order or [])] if c not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")
    order = list(order) if order is not None else [c for c in df.columns if c not in key]
    if not order:
        return df.dropDuplicates(list(key))
    window = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def split_repeated(table: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of a table of parquet files whose key comes once, and those whose key may come again.

    Rows of the first part need no exchange to be told apart by key. Which they are is found
    from a hash of the key and the row's place in its file, and comes back to the files as one
    bit a row. Keys that share a hash are in the second part, as are all rows
    of a table larger than ``TOLD_ROWS``.
    """
    if table.count() > TOLD_ROWS:
        return table.where("false"), table
    # In blocks of 4096 rows of a file, each an array of 64 numbers of 64 bits.
    placed = _with_place(table)
    once = (
        placed.groupBy(F.xxhash64(*key).alias("_hash"))
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_place"))
        .where("_n = 1")
        .selectExpr("_place >> 12 as _block", "cast(_place & 4095 as int) as _row")
        .repartition("_block")
    )
    words = once.groupBy("_block", F.expr("_row >> 6").alias("_word")).agg(
        F.expr("bit_or(shiftleft(1L, _row & 63))").alias("_bits")
    )
    blocks = words.groupBy("_block").agg(
        F.expr("map_from_entries(collect_list(struct(_word, _bits)))").alias("_words")
    )
    every = "transform(sequence(0, 63), i -> coalesce(try_element_at(_words, i), 0L)) as _words"
    told = materialize(blocks.selectExpr("_block", every), "rows-told")
    marked = placed.withColumn("_block", F.expr("_place >> 12")).join(F.broadcast(told), "_block", "left")
    bit = "getbit(element_at(_words, cast((_place >> 6) & 63 as int) + 1), cast(_place & 63 as int))"
    marked = marked.withColumn("_once", F.expr(f"coalesce({bit}, 0) = 1"))
    return marked.where("_once").select(*table.columns), marked.where("not _once").select(*table.columns)


def _with_place(table: DataFrame) -> DataFrame:
    """``table``, read from parquet files, with ``_place``: the file in the upper 32 bits, the row in the lower ones."""
    path = F.col("_metadata.file_path")
    names = sorted(r[0] for r in table.select(path.alias("_file")).distinct().collect())
    # One row per file.
    files = table.sparkSession.createDataFrame(list(enumerate(names)), "_number bigint, _file string")
    here = table.select(*table.columns, path.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    numbered = here.join(F.broadcast(files), "_file")
    return numbered.select(*table.columns, F.expr("shiftleft(_number, 32) | _row").alias("_place"))


def drop_duplicates_any(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One arbitrary row per key, Spark's own ``dropDuplicates``."""
    return df.dropDuplicates(list(key))
