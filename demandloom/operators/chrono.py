"""Global time order, and splits along it, without a single-task stage.

``fit_chrono_split`` finds the last row of each part as a tuple of order values;
applying it is a comparison with literals on every row. The rows themselves are
neither sorted nor shuffled nor collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from demandloom.functions.keys import after, up_to
from demandloom.session import ONE_USE, materialize, settings

SPLITS = ("train", "validation", "test")
# Order tuples that the driver may fetch at the end of a search.
FETCH = 4096


def place_in_order(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """``df`` in a written table with ``_part`` and ``_pos``, ascending along ``order``.

    ``_part`` numbers range partitions that hold about the same number of rows
    each, ``_pos`` the rows inside one from 0. Ranges are cut on all of
    ``order``, so a series or a date that holds a third of the rows is spread
    over many of them; only rows equal in all of ``order`` stay together.
    Writing fixes the cut: a repeated task cannot see another one. Without
    ``parts`` there are as many as the session's shuffle partitions, which the
    adaptive planner merges on small data but never splits.
    """
    ranged = df.repartitionByRange(*([parts] if parts else []), *order)
    ordered = ranged.sortWithinPartitions(*order)
    placed = materialize(ordered.withColumn("_id", F.monotonically_increasing_id()), "placed")
    # Upper bits of the id: partition. Lower 33 bits: position inside it.
    return placed.withColumns(
        {
            "_part": F.shiftright("_id", 33),
            "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    ).drop("_id")


def chrono_rank(
    df: DataFrame, order: Sequence[str], name: str = "rn", parts: int | None = None
) -> DataFrame:
    """Add the 1-based position of each row in ``order``, without a single-task sort.

    One row count per range partition travels through the driver and comes back
    as the offset of that partition.
    """
    placed = place_in_order(df, order, parts)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, total = [], 0
    for part, n in sorted((row["_part"], row["n"]) for row in sizes):
        offsets.append((part, total))
        total += n
    offset_table = df.sparkSession.createDataFrame(offsets, "_part bigint, _offset bigint")
    # One row per range partition: the broadcast cannot outgrow their number.
    return (
        placed.join(F.broadcast(offset_table), "_part")
        .withColumn(name, (F.col("_offset") + F.col("_pos") + 1).cast("bigint"))
        .drop("_part", "_pos", "_offset")
    )


def split_sizes(n: int, held_out: Fraction = Fraction(1, 5)) -> tuple[int, int, int]:
    """Rows in train, validation, test: the held-out part is rounded up, twice."""
    test = ceil(n * held_out)
    validation = ceil((n - test) * held_out)
    return n - test - validation, validation, test


@dataclass(frozen=True)
class ChronoSplit:
    """Where each split ends, as order values in text form; None where it is empty."""

    order: tuple[str, ...]
    types: tuple[str, ...]
    sizes: tuple[int, int, int]
    train_last: tuple[str | None, ...] | None
    validation_last: tuple[str | None, ...] | None

    def _literals(self, values: Sequence[str | None]) -> list[Column | None]:
        return [
            None if v is None else F.lit(v).cast(t)
            for v, t in zip(values, self.types, strict=True)
        ]

    def _up_to(self, last: tuple[str | None, ...] | None) -> Column:
        return F.lit(False) if last is None else up_to(self.order, self._literals(last))

    def _after(self, last: tuple[str | None, ...] | None) -> Column:
        return F.lit(True) if last is None else after(self.order, self._literals(last))

    def label(self, df: DataFrame, name: str = "split") -> DataFrame:
        """Add the split name of every row."""
        return df.withColumn(
            name,
            F.when(self._up_to(self.train_last), "train")
            .when(self._up_to(self._validation_end()), "validation")
            .otherwise("test"),
        )

    def _validation_end(self) -> tuple[str | None, ...] | None:
        return self.validation_last or self.train_last

    def take(self, df: DataFrame, split: str) -> DataFrame:
        """The rows of one split, as a filter the scan can use."""
        if split == "train":
            return df.where(self._up_to(self.train_last))
        if split == "validation":
            return df.where(
                self._after(self.train_last) & self._up_to(self._validation_end())
            )
        if split == "test":
            return df.where(self._after(self._validation_end()))
        raise ValueError(f"split must be one of {SPLITS}, not {split!r}")


def rows_per_day(df: DataFrame, time: str) -> DataFrame:
    """``day, n_rows``, combined before the exchange: a row per day of the calendar."""
    return df.groupBy(F.to_date(F.col(time)).alias("day")).agg(F.count(F.lit(1)).alias("n_rows"))


def fit_chrono_split(
    df: DataFrame,
    order: Sequence[str],
    held_out: Fraction = Fraction(1, 5),
    per_day: DataFrame | None = None,
) -> ChronoSplit:
    """Find the exact 64 / 16 / 20 % cut points (for 1/5) in ascending ``order``.

    ``order`` starts with a date or timestamp and must be total. Rows before each day come
    from running sums over ``per_day``, a kept table ``day, n_rows`` of ``df``, or else from
    counting ``df``; at most the two days that hold a cut come back, and only their rows are
    looked into. Pass a written table: the days are scanned a few times, one or a few
    columns each. A ``per_day`` that does not fit the rows of its days is an error.
    """
    order = tuple(order)
    types = dict(df.dtypes)
    if per_day is None:
        per_day = materialize(rows_per_day(df, order[0]), "rows-per-day")
    total = per_day.agg(F.sum("n_rows")).first()[0] or 0
    sizes = split_sizes(total, held_out)
    train, validation = sizes[0], sizes[0] + sizes[1] if sizes[1] else 0
    # One row per day of the calendar: a running sum over all of them is small.
    along = Window.orderBy(F.col("day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    until = per_day.withColumn("until", F.sum("n_rows").over(along))
    ends = F.array(F.lit(train), F.lit(validation))
    cuts = (
        until.select("day", "n_rows", "until", F.explode(ends).alias("position"))
        .where((F.col("position") > F.col("until") - F.col("n_rows")) & (F.col("position") <= F.col("until")))
        .select(F.col("day").cast("string"), "n_rows", (F.col("until") - F.col("n_rows")).alias("before"), "position")
        .distinct()
        .collect()
    )
    found = {row["position"]: row for row in cuts}

    def row_at(position: int) -> tuple[str | None, ...] | None:
        if position == 0:
            return None
        cut = found[position]
        if cut["day"] is None:
            inside = df.where(F.col(order[0]).isNull())
        else:
            start = F.lit(cut["day"]).cast("date")
            column = F.col(order[0])
            inside = df.where((column >= start) & (column < F.date_add(start, 1)))
        return nth_row(inside, order, position - cut["before"], cut["n_rows"])

    train_last, validation_last = row_at(train), row_at(validation)
    return ChronoSplit(
        order, tuple(types[c] for c in order), sizes, train_last, validation_last
    )


def nth_row(
    df: DataFrame, order: Sequence[str], position: int, rows: int | None = None
) -> tuple[str | None, ...]:
    """Order values, as text, of the row at 1-based ``position`` in ascending ``order``.

    Narrows by fences: distinct order tuples are range-partitioned, one count
    and the end points per partition come back, and the search goes on inside
    the partition that holds the position, until it is counted to have at most
    ``FETCH`` of them; those are fetched.

    Raises if rows beyond ``position`` share its order values, since no
    comparison could then tell them apart, or if ``df`` does not have ``rows`` rows.
    """
    order = list(order)
    types = dict(df.dtypes)
    spark = df.sparkSession
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    weighted = df.groupBy(*order).agg(F.count(F.lit(1)).alias("_n"))

    def texts(row) -> tuple[str | None, ...]:
        return tuple(row[c] for c in order)

    def literals(values) -> list[Column | None]:
        return [
            None if v is None else F.lit(v).cast(types[c])
            for c, v in zip(order, values, strict=True)
        ]

    as_text = F.struct(*[F.col(c).cast("string").alias(c) for c in order])
    tuple_of = F.struct(*order)
    left = position
    tuples = None
    while tuples is None or tuples > FETCH:
        fences = (
            weighted.repartitionByRange(parts, *order)
            .groupBy(F.spark_partition_id().alias("p"))
            .agg(
                F.sum("_n").alias("n"),
                F.count(F.lit(1)).alias("tuples"),
                F.min_by(as_text, tuple_of).alias("first"),
                F.max_by(as_text, tuple_of).alias("last"),
            )
            .collect()
        )
        if tuples is None and rows not in (None, sum(fence["n"] for fence in fences)):
            raise ValueError(f"the kept rows per day do not fit the table: {rows} expected")
        for fence in sorted(fences, key=lambda row: row["p"]):
            if left <= fence["n"]:
                break
            left -= fence["n"]
        else:
            raise ValueError(f"position {position} is beyond the last row")
        first, last = texts(fence["first"]), texts(fence["last"])
        weighted = weighted.where(
            up_to(order, literals(last))
            & (after(order, literals(first)) | _equals(order, literals(first)))
        )
        tuples = fence["tuples"]
    for row in weighted.orderBy(*order).select(as_text.alias("t"), "_n").collect():
        if left <= row["_n"]:
            if left < row["_n"]:
                raise ValueError(
                    f"several rows share the values {texts(row['t'])} of {order}; "
                    "add a column to the order"
                )
            return texts(row["t"])
        left -= row["_n"]
    raise AssertionError("search left its range")


def _equals(columns: Sequence[str], values: Sequence[Column | None]) -> Column:
    test = F.lit(True)
    for name, value in zip(columns, values, strict=True):
        column = F.col(name)
        test = test & (column.isNull() if value is None else column == value)
    return test


def split_by_rank(
    ranked: DataFrame, n: int, rank: str = "rn", held_out: Fraction = Fraction(1, 5)
) -> DataFrame:
    """Split names from a rank column. Also right when the order has ties."""
    train, validation, _ = split_sizes(n, held_out)
    return ranked.withColumn(
        "split",
        F.when(F.col(rank) <= train, "train")
        .when(F.col(rank) <= train + validation, "validation")
        .otherwise("test"),
    )


def split_profile(df: DataFrame, columns: Sequence[str], split: str = "split") -> DataFrame:
    """Rows and NULLs per column, one row per split."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.sum(F.col(c).isNull().cast("int")).cast("bigint").alias(f"{c}_nulls")
            for c in columns
        ],
    )


def write_profiled(
    df: DataFrame, split: ChronoSplit, columns: Sequence[str], path: str
) -> tuple[DataFrame, DataFrame]:
    """Write ``df`` to ``path``; returns it as read back, and its ``split_profile``.

    Rows and NULLs are counted by the write itself, so the profile costs no scan.
    """
    spark, seen = df.sparkSession, Observation()
    labelled = split.label(df, "_split")
    counts = []
    for i, name in enumerate(SPLITS):
        inside = F.col("_split") == name
        counts.append(F.count_if(inside).alias(f"{i}_rows"))
        counts += [F.count_if(inside & F.col(c).isNull()).alias(f"{i}_{k}") for k, c in enumerate(columns)]
    with settings(spark, ONE_USE):
        labelled.observe(seen, *counts).drop("_split").write.parquet(path)
    found = seen.get
    rows = [
        (name, found[f"{i}_rows"], *[found[f"{i}_{k}"] for k in range(len(columns))])
        for i, name in enumerate(SPLITS)
        if found[f"{i}_rows"]
    ]
    names = ["split string", "n_rows bigint", *[f"`{c}_nulls` bigint" for c in columns]]
    profile = spark.createDataFrame(rows, ", ".join(names))
    return spark.read.schema(df.schema).parquet(path), profile
