"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bounds of one Arrow batch: rows, and bytes where the session knows that setting.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on in a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def n_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text, none for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def map_rows(df: DataFrame, make: Callable[[dict], Iterator[dict] | dict], schema: str) -> DataFrame:
    """``mapInArrow`` over columns as Python lists: ``make(columns) -> columns`` per batch."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(make(batch.to_pydict()), schema=arrow)

    arrow = arrow_schema(schema)
    return df.mapInArrow(run, schema)


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a DDL schema; on the driver only."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def least_hashed(df: DataFrame, hash_column: str, bound: int, *ties: str) -> DataFrame:
    """At most ``bound`` rows: those of least hash, in full order with ``ties``.

    Rows far beyond the last one taken are left out before the sort, by the share that
    the bound is of all rows, so that no more than about twice the bound is sorted.
    Should the hashes be so uneven that this leaves fewer than ``bound``, fewer it is.
    """
    share = min(2 * bound / max(df.count(), 1), 1.0)
    if share < 1.0:
        df = df.where(F.col(hash_column) <= F.lit(int(-(1 << 63) + share * (1 << 64)) - 1))
    return df.orderBy(hash_column, *ties).limit(bound)


def per_worker(key: tuple, make: Callable):
    """``make()`` once per Python worker, which Spark keeps from task to task."""
    import sys
    import types

    home = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker"))
    kept = vars(home).setdefault("objects", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]
