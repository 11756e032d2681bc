"""Keyed feature and label tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.keys import composite_key, zero_filled
from demandloom.session import materialize


def fill_cold_start(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """0 for the lag and rolling values a series start cannot have."""
    return df.withColumns(zero_filled(columns))


def with_key(df: DataFrame, name: str, time: str, parts: Sequence[str]) -> DataFrame:
    return df.withColumn(name, composite_key(time, parts))


def split_xy(
    df: DataFrame, features: Sequence[str], labels: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """The feature frame and the label frame, sharing the key column."""
    return df.select(*features), df.select(*labels)


def key_audit(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: rows, rows with a NULL or empty key, keys held by several rows, and those rows.

    A key is usable when the last three are 0. Counts combine before the
    exchange, so a key that everything collapsed onto is not a hot task.
    """
    empty = F.lit(False)
    for c in key:
        empty = empty | F.col(c).isNull() | (F.col(c).cast("string") == "")
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.col("_n") > 1

    def total(value) -> Column:
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    return per_key.agg(
        total("_n").alias("n_rows"),
        total(F.when(empty, F.col("_n"))).alias("n_empty_keys"),
        total(F.when(repeated, 1)).alias("n_repeated_keys"),
        total(F.when(repeated, F.col("_n"))).alias("n_rows_repeated"),
    )


def composite_key_audit(
    df: DataFrame, name: str, time: str, parts: Sequence[str], sep: str = "-"
) -> DataFrame:
    """``key_audit`` of the composite key of rows unique in ``time`` and ``parts``, as facts are.

    A key of parts that are all there and hold no separator can be read back, so two such
    rows never share one: every repeated key has a row of the other kind. Only those rows,
    and plain ones whose key is among theirs, are grouped; all others are only counted.
    """
    plain = F.col(time).isNotNull() & F.year(time).between(0, 9999)
    for part in parts:
        plain = plain & F.col(part).isNotNull() & ~F.contains(F.col(part).cast("string"), F.lit(sep))
    rows = df.select(composite_key(time, parts, sep).alias(name), plain.alias("_plain"))
    odd = materialize(rows.where(~F.col("_plain")).select(name), "odd-keys")
    met = rows.where("_plain").select(name).join(odd.distinct(), name, "left_semi")
    repeated = key_audit(odd.unionByName(met), [name]).drop("n_rows", "n_empty_keys")
    counts = rows.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(name) == "").alias("n_empty_keys")
    )
    # One row each.
    return counts.join(F.broadcast(repeated)).select("n_rows", "n_empty_keys", "n_repeated_keys", "n_rows_repeated")


def require_composite_key(df: DataFrame, name: str, time: str, parts: Sequence[str]) -> DataFrame:
    """``df`` itself if its rows, unique in ``time`` and ``parts``, have keys of their own; an error if not."""
    audit = composite_key_audit(df, name, time, parts).first().asDict()
    if audit["n_repeated_keys"]:
        raise ValueError(f"{name} is not a key: {audit}")
    return df


def require_key(df: DataFrame, key: Sequence[str], allow_empty: bool = False) -> DataFrame:
    """``df`` itself if ``key`` is unique and never empty; an error with the counts if not.

    ``allow_empty`` accepts the empty text, which a composite key of NULL parts is.
    """
    audit = key_audit(df, key).first().asDict()
    if audit["n_repeated_keys"] or (audit["n_empty_keys"] and not allow_empty):
        raise ValueError(f"{', '.join(key)} is not a key: {audit}")
    return df


def lookup_features(
    labels: DataFrame, features: DataFrame, key: str, exclude: Sequence[str] = ()
) -> DataFrame:
    """Every label row with the features stored under its key, NULL where there are none.

    ``features`` must be unique on ``key`` (see ``require_key``), so the join
    never multiplies rows, and a hot label key is split by the adaptive
    skew join. Two tables bucketed on ``key`` join without an exchange.
    """
    return labels.join(features, key, "left").drop(*exclude)


def training_frame(
    looked_up: DataFrame, time: str, key: str, keep_key: bool = False
) -> DataFrame:
    """Model inputs and label only: the time column and the key are left out."""
    return looked_up.drop(time, *([] if keep_key else [key]))
