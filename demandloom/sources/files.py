"""Delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructType

from demandloom.functions.exact import finite
from demandloom.session import ONE_USE, settings


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    sep: str = ",",
    header: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Typed scan without inference.

    Columns bind by position. An unparsable cell becomes NULL, a short row is
    padded with NULL, extra cells are dropped. A number that is NaN or infinite
    becomes NULL too: such a cell tells nothing, and would outrank every number. With ``corrupt_column`` the raw
    text of such rows is kept in that column.
    """
    if corrupt_column:
        schema = StructType(schema.fields).add(corrupt_column, StringType(), True)
    reader = (
        spark.read.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
    )
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    read = reader.csv(path)
    real = [f for f in schema.fields if isinstance(f.dataType, (DoubleType, FloatType))]
    return read.withColumns({f.name: finite(F.col(f.name)).cast(f.dataType) for f in real})


# Rows of a compressed file, which one task reads as a whole.
FILE_ROWS = 500_000


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Delimited files with a header, compressed: text is several times the size of its rows elsewhere."""
    writer = df.write.option("header", True).option("maxRecordsPerFile", FILE_ROWS)
    writer = writer.option("compression", "gzip").option("zlib.compress.level", "FOUR")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, ONE_USE):
        writer.csv(path)


def stamp_ingestion(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    """Add the time of the load, one value for the whole query."""
    return df.withColumn(name, F.current_timestamp())
