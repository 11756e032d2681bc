"""Categorical encoding: vocabulary, wide 0/1 columns, sparse vectors."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.operators.chrono import chrono_rank
from demandloom.session import materialize

Vocabulary = Mapping[str, Sequence[str]]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """An error before any job starts if a column is not there."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"no such column: {', '.join(missing)}; have {', '.join(df.columns)}")


def category_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-NULL ``(column, value)`` pairs of all ``columns`` with row counts, one scan."""
    require_columns(df, columns)
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def category_vocab(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The pairs with their 0-based position in sorted order within the column.

    Ranked over range partitions, so a column of very many values is not sorted
    by one task; the first rank of each column is subtracted.
    """
    ranked = chrono_rank(category_values(df, columns), ["column", "value"], "_rank")
    first = ranked.groupBy("column").agg(F.min("_rank").alias("_first"))
    # One row per encoded column.
    return (
        ranked.join(F.broadcast(first), "column")
        .withColumn("position", (F.col("_rank") - F.col("_first")).cast("int"))
        .drop("_rank", "_first")
    )


def fit_vocabulary(
    df: DataFrame, columns: Sequence[str], limit: int | None = None
) -> dict[str, list[str]]:
    """Sorted values per column, on the driver: one column of the wide form for each.

    Use ``category_vocab`` for the table and ``fit_encoder`` or ``fit_tree`` with column
    names for a model; neither needs this list. With a ``limit``, more values than
    that are an error, never a shortened vocabulary.
    """
    values = category_values(df, columns).select("column", "value")
    rows = (values if limit is None else values.limit(limit + 1)).collect()
    if limit is not None and len(rows) > limit:
        raise ValueError(f"more than {limit} categories in {', '.join(columns)}")
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}


def one_hot_names(vocabulary: Vocabulary) -> list[str]:
    """``<column>_<value>`` per category, in vocabulary order, to be read with ``quoted``."""
    return [f"{c}_{value}" for c, values in vocabulary.items() for value in values]


def quoted(names: Sequence[str]) -> list[Column]:
    """Columns by exact name, whatever it holds: a point is part of it, not an access."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in names]


def one_hot_wide(df: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One 0/1 column per category; all zeros for an unseen or NULL value.

    Two categories of one name, as ``a`` with ``b_c`` and ``a_b`` with ``c``, or a name that
    a column of ``df`` has, are an error. Names differ if their lower-case forms do,
    as in the session's own resolution.
    """
    require_columns(df, list(vocabulary))
    taken = {c.lower() for c in df.columns}
    for name in one_hot_names(vocabulary):
        if name.lower() in taken:
            raise ValueError(f"column name {name} is taken twice")
        taken.add(name.lower())
    flags: dict[str, Column] = {}
    for c, values in vocabulary.items():
        for value in values:
            flags[f"{c}_{value}"] = F.coalesce(F.col(c) == value, F.lit(False)).cast("int")
    return df.withColumns(flags) if flags else df


# Below every real value, so that a threshold can set missing values apart.
MISSING = "-1e300"


def known_numbers(numeric: Sequence[str]) -> SQLTransformer:
    """A stage adding ``<column>_known``: the number, or ``MISSING`` for NULL and NaN."""
    filled = ", ".join(
        f"coalesce(nanvl(cast(`{c}` AS double), cast(NULL AS double)), {MISSING}D) AS `{c}_known`"
        for c in numeric
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def encoding_stages(vocabulary: Vocabulary | Sequence[str], numeric: Sequence[str]) -> list:
    """Index, one-hot and assemble: numeric columns first, then one slot per category.

    With column names only, the fit finds the categories, in sorted order, however
    many. ``keep`` puts unseen and NULL values on an extra last index and ``dropLast``
    encodes exactly that index as the zero vector. A missing number goes to the
    low side of every threshold, and a threshold may set missing ones apart.
    """
    columns = list(vocabulary)
    indexed = [f"{c}_index" for c in columns]
    encoded = [f"{c}_onehot" for c in columns]
    # One indexer per column: the many-column constructor pads shorter vocabularies with NULL.
    indexers = [
        StringIndexerModel.from_labels(
            list(vocabulary[c]), inputCol=c, outputCol=out, handleInvalid="keep"
        )
        if isinstance(vocabulary, Mapping)
        else StringIndexer(
            inputCol=c, outputCol=out, handleInvalid="keep", stringOrderType="alphabetAsc"
        )
        for c, out in zip(columns, indexed, strict=True)
    ]
    one_hot = OneHotEncoder(inputCols=indexed, outputCols=encoded, dropLast=True)
    known = [known_numbers(numeric)] if numeric else []
    assembler = VectorAssembler(
        inputCols=[*[f"{c}_known" for c in numeric], *encoded], outputCol="features"
    )
    return [*indexers, one_hot, *known, assembler]


def fit_encoder(df: DataFrame, vocabulary: Vocabulary, numeric: Sequence[str]) -> PipelineModel:
    """The encoding stages as one fitted, saveable model. Reads no rows."""
    require_columns(df, [*vocabulary, *numeric])
    return Pipeline(stages=encoding_stages(vocabulary, numeric)).fit(df.limit(0))


@dataclass(frozen=True)
class SparseEncoder:
    """One-hot encoding by a table of categories, for more of them than a driver should hold.

    ``table`` has ``column, value, position`` and stays distributed; only the number of
    categories per column is known here.
    """

    table: DataFrame
    sizes: Mapping[str, int]

    def index(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_index``: the position, or the number of categories if unseen or NULL.

        One join per column. A category that holds much of ``df`` is split by the adaptive
        skew join, as each category is one row of the table.
        """
        require_columns(df, list(self.sizes))
        for c, size in self.sizes.items():
            known = self.table.where(F.col("column") == c).select(
                F.col("value").alias("_value"), F.col("position").cast("double").alias("_position")
            )
            df = df.join(known, F.col(f"`{c}`").cast("string") == F.col("_value"), "left")
            index = F.coalesce("_position", F.lit(float(size)))
            df = df.withColumn(f"{c}_index", index).drop("_value", "_position")
        return df

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``<column>_onehot``, a sparse vector with a slot per category, all zeros for the
        unseen. Columns ``<column>_index`` stay."""
        columns = list(self.sizes)
        fields = ", ".join(f"`{c}_index` double" for c in columns)
        # The last index, which the fit finds here, is the one that is encoded as no slot.
        last = df.sparkSession.createDataFrame([tuple(float(self.sizes[c]) for c in columns)], fields)
        model = OneHotEncoder(
            inputCols=[f"{c}_index" for c in columns],
            outputCols=[f"{c}_onehot" for c in columns],
            dropLast=True,
        ).fit(last)
        return model.transform(self.index(df))

    def save(self, path: str) -> None:
        self.table.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> SparseEncoder:
        table = spark.read.schema("column string, value string, position int").parquet(path)
        return cls(table, _sizes(table))


def fit_sparse_encoder(df: DataFrame, columns: Sequence[str]) -> SparseEncoder:
    """The categories of ``columns`` in sorted order, in a written table.

    Numbered over range partitions like ``category_vocab``; no category reaches the driver.
    A column without any value is an error.
    """
    table = materialize(category_vocab(df, columns).select("column", "value", "position"), "categories")
    sizes = _sizes(table)
    missing = [c for c in columns if c not in sizes]
    if missing:
        raise ValueError(f"no category in {', '.join(missing)}")
    return SparseEncoder(table, {c: sizes[c] for c in columns})


def _sizes(table: DataFrame) -> dict[str, int]:
    """Categories per column: one row each."""
    counted = table.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    return {r["column"]: r["n"] for r in counted.collect()}


def encoded_slots(encoder: Transformer, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column, how many ones its vector has and at which slot (NULL for all zeros)."""
    from pyspark.ml.functions import vector_to_array

    encoded = encoder.transform(df)
    added: dict[str, Column] = {}
    for c in columns:
        ones = vector_to_array(F.col(f"{c}_onehot"))
        added[f"{c}_ones"] = F.aggregate(ones, F.lit(0.0), lambda a, x: a + x).cast("int")
        slot = F.array_position(ones, F.lit(1.0)).cast("int")
        added[f"{c}_slot"] = F.when(slot > 0, slot - 1)
    return encoded.select(*df.columns, *[col.alias(name) for name, col in added.items()])
