"""Row-based window features over panel series.

A series is the rows sharing the ``series`` columns, ordered by ``order``. Lags
and frames count rows, not calendar days.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from demandloom.functions.exact import DOUBLES, hundredths, mean_of_hundredths
from demandloom.functions.keys import calendar
from demandloom.operators.chrono import place_in_order


def lag_columns(target: str, lags: Mapping[int, str], window: WindowSpec) -> dict[str, Column]:
    return {name: F.lag(target, rows).over(window) for rows, name in lags.items()}


def trailing_mean(
    target: str, rows: int, window: WindowSpec, exact: bool | str = False
) -> Column:
    """Mean of up to ``rows`` preceding rows without the current one, two decimals.

    NULL where there is no preceding value. A frame of doubles is added up in the order of
    the window, so it too is the same however rows are dealt: nothing more for ``"doubles"``.
    """
    frame = window.rowsBetween(-rows, -1)
    if not exact or exact == DOUBLES:
        return F.round(F.avg(target).over(frame), 2)
    total = F.sum(hundredths(F.col(target))).over(frame)
    return mean_of_hundredths(total, F.count(target).over(frame))


def series_features(
    df: DataFrame,
    target: str,
    series: Sequence[str],
    order: Sequence[str],
    lags: Mapping[int, str] | None = None,
    rolling: str | None = None,
    rolling_rows: int = 7,
    exact: bool | str = False,
) -> DataFrame:
    """Lags and trailing mean in one window pass: one exchange, one sort.

    A series goes to one task. That is bounded when the rows are facts with at
    most one row per series and date (the calendar is the bound); for raw rows
    use ``hot_series_features``.
    """
    window = Window.partitionBy(*series).orderBy(*order)
    columns = lag_columns(target, lags or {}, window)
    if rolling:
        columns[rolling] = trailing_mean(target, rolling_rows, window, exact)
    return df.withColumns(columns)


def hot_series_features(
    df: DataFrame,
    target: str,
    series: Sequence[str],
    order: Sequence[str],
    lags: Mapping[int, str] | None = None,
    rolling: str | None = None,
    rolling_rows: int = 7,
    exact: bool | str = False,
    parts: int | None = None,
) -> DataFrame:
    """Same result as ``series_features`` for series too long for one task.

    Rows are placed in ``(series, order)`` and cut into ranges of about equal
    size; the part of a series in one range is a window partition of its own.
    It is preceded by a halo: the rows, as many as the longest lag or frame,
    that come before it in the series. Halos are taken from the tails of the parts
    before, limited to that many rows before the exchange. Which tail goes where
    is worked out on one number per part, so no task holds more of a series than
    one range, or the sizes of its tails. ``order`` must be total within a series.
    """
    reach = max([*(lags or {}), rolling_rows if rolling else 0])
    carried = list(dict.fromkeys([*order, target]))
    placed = place_in_order(df, [*series, *order], parts).drop("_pos")

    halos = _halos(placed.select(*dict.fromkeys([*series, "_part", *carried])), series, order, reach)
    rows = placed.withColumn("_is_halo", F.lit(False)).unionByName(halos, allowMissingColumns=True)
    # Ranges of the part number keep the parts apart, where hashing could put several hot
    # ones on one task. They also satisfy the window, which adds no exchange of its own.
    featured = series_features(
        rows.repartitionByRange("_part"),
        target,
        [*series, "_part"],
        order,
        lags,
        rolling,
        rolling_rows,
        exact,
    )
    return featured.where(~F.col("_is_halo")).drop("_part", "_is_halo")


def _halos(
    rows: DataFrame, series: Sequence[str], order: Sequence[str], reach: int
) -> DataFrame:
    """For each part of a series the last ``reach`` rows before it, marked ``_is_halo``.

    Tail rows of a series count on from part to part: row ``t`` is in the halo of the
    parts that begin after it and less than ``reach`` rows later. Where tails are
    full that is the next part alone; short parts reach further.
    """
    newest_first = Window.partitionBy(*series, "_part").orderBy(*[F.desc(c) for c in order])
    tails = rows.withColumn("_back", F.row_number().over(newest_first)).where(
        F.col("_back") <= reach
    )
    along = Window.partitionBy(*series).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    near = Window.partitionBy(*series).orderBy("_start").rangeBetween(1, max(2 * reach - 1, 1))
    parts = (
        tails.groupBy(*series, "_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(along), F.lit(0)).cast("bigint"))
        .withColumn("_to", F.collect_list(F.struct("_part", "_start")).over(near))
    )
    renamed = parts.select(
        *[F.col(c).alias(f"_of_{c}") for c in series],
        F.col("_part").alias("_of_part"),
        F.explode("_to").alias("_to"),
        (F.col("_start") + F.col("_n")).alias("_end"),
    )
    same = F.col("_part") == F.col("_of_part")
    for c in series:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    ahead = F.col("_to._start") - (F.col("_end") - F.col("_back") + 1)
    return (
        tails.join(renamed, same)
        .where(ahead < reach)
        .withColumn("_part", F.col("_to._part"))
        .select(*rows.columns, F.lit(True).alias("_is_halo"))
    )


def with_calendar(df: DataFrame, time: str) -> DataFrame:
    """Add ``month`` and ``day_of_week``."""
    return df.withColumns(calendar(time))
