"""Tables by catalog name or by path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from demandloom.sources.snapshots import Snapshots, locate

# Formats of plain files, whose tables are replaced by a commit; others see to that themselves.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "text", "avro")


def is_path(ref: str) -> bool:
    return "/" in ref


def split_path(ref: str) -> tuple[str, str]:
    """Root folder and name of a table by path."""
    root, _, name = ref.rstrip("/").rpartition("/")
    return root, name


def beside(ref: str, name: str) -> str:
    """The table called ``name`` in the folder or database of another."""
    before, mark, _ = ref.rstrip("/").rpartition("/" if is_path(ref) else ".")
    return f"{before}{mark}{name}"


def committed(ref: str, fmt: str) -> bool:
    return is_path(ref) and fmt.lower() in FILE_FORMATS


def read_table(spark: SparkSession, ref: str, fmt: str = "parquet") -> DataFrame:
    """A table by catalog name or path; by path as of the last commit that covers it."""
    return read_tables(spark, [ref], fmt)[0]


def read_tables(spark: SparkSession, refs: Sequence[str], fmt: str = "parquet") -> list[DataFrame]:
    """Several tables; those below one root as one commit left them, whatever is written meanwhile."""
    paths = locate(spark, [ref for ref in refs if committed(ref, fmt)])
    return [
        spark.read.format(fmt).load(paths.get(ref, ref)) if is_path(ref) else spark.table(ref)
        for ref in refs
    ]


def write_table(
    df: DataFrame,
    ref: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    bucket_by: Sequence[str] = (),
    buckets: int | None = None,
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Full-refresh write; returns the table as read back.

    A table of plain files by path is replaced by a commit: until it is written as a whole
    readers see the one before, and a failed write changes nothing. Other tables below the
    same root stay. The files before the last commits go, see ``Snapshots.expire``.

    ``bucket_by`` (catalog tables only) shuffles once on write so that every
    later join or aggregate on those columns reads co-located files. Rows are
    brought together per bucket first, which leaves one file per bucket.
    """
    spark = df.sparkSession
    if bucket_by and is_path(ref):
        raise ValueError("bucketing needs a catalog table name")
    if committed(ref, fmt):
        root, name = split_path(ref)
        snapshots = Snapshots(spark, root)
        draft = snapshots.draft()
        try:
            draft.write(name, df, fmt, partition_by, options)
            snapshots.commit(draft)
        except BaseException:
            draft.discard()
            raise
        snapshots.expire()
        return draft.read(name, fmt)
    if bucket_by:
        buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(buckets, *bucket_by)
    writer = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    if is_path(ref):
        writer.save(ref)
    else:
        if path:
            writer = writer.option("path", path)
        writer.saveAsTable(ref)
    return read_table(spark, ref, fmt)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def describe_table(
    spark: SparkSession,
    name: str,
    key: Sequence[str] = (),
    description: str | None = None,
    tags: dict[str, str] | None = None,
) -> None:
    """Record key, description and tags as properties of a catalog table."""
    properties = {f"tag.{k}": v for k, v in (tags or {}).items()}
    if key:
        properties["primary_key"] = ",".join(key)
    if description:
        properties["comment"] = description
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def append_rows(df: DataFrame, ref: str, fmt: str = "parquet") -> None:
    writer = df.write.format(fmt).mode("append")
    if is_path(ref):
        writer.save(ref)
    else:
        writer.saveAsTable(ref)


def read_or_empty(
    spark: SparkSession, ref: str, schema: str, fmt: str = "parquet"
) -> DataFrame:
    """A log table, or no rows if nothing was ever appended to it.

    Only "does not exist" counts as empty; any other failure is raised.
    """
    try:
        if is_path(ref):
            return spark.read.format(fmt).schema(schema).load(ref)
        return spark.table(ref)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"):
            return spark.createDataFrame([], schema)
        raise


def row_count(table: DataFrame) -> int:
    """Rows of a written table. Parquet answers from file footers, without a data scan."""
    return table.count()


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this library wrote; False if it was not there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.delete(hadoop_path, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """A folder to read, without rows unless something was written there."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(hadoop_path)
