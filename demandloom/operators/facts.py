"""Group-by facts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exact import DOUBLES, from_hundredths, hundredths, mean_of_hundredths
from demandloom.operators.anysum import exact_sums

Measure = tuple[str, str, str | None]


def measure(kind: str, source: str | None, exact: bool) -> Column:
    """Aggregate of one kind: ``sum`` or ``mean`` rounded to two decimals, or ``count`` of rows.

    ``mean`` is over rows with a value, unweighted.
    """
    if kind == "count":
        return F.count(F.lit(1))
    if kind not in ("sum", "mean") or source is None:
        raise ValueError(f"unknown measure {kind!r} of {source!r}")
    if not exact:
        return F.round(F.sum(source) if kind == "sum" else F.avg(source), 2)
    total = F.sum(hundredths(F.col(source)))
    if kind == "sum":
        return from_hundredths(total)
    return mean_of_hundredths(total, F.count(source))


def daily_facts(
    df: DataFrame, keys: Sequence[str], measures: Sequence[Measure], exact: bool | str = False
) -> DataFrame:
    """One row per key combination with the given ``(name, kind, source)`` measures.

    Every measure combines before the exchange, so a hot group shuffles one
    partial row per task. ``exact`` computes in integer hundredths
    (two-decimal inputs), which makes results independent of partitioning. So does
    ``exact="doubles"`` for any doubles: sums are rounded once, then to two decimals.
    """
    if exact == DOUBLES:
        return _facts_of_doubles(df, keys, measures)
    return df.groupBy(*keys).agg(
        *[measure(kind, source, exact).alias(name) for name, kind, source in measures]
    )


def _facts_of_doubles(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    sources = {source: f"_sum_{i}" for i, (_, _, source) in enumerate(measures) if source}
    if not sources:
        return daily_facts(df, keys, measures)
    counts = {total: f"{total}_n" for total in sources.values()}
    columns = {total: source for source, total in sources.items()}
    summed = exact_sums(df, keys, columns, counts, "_rows")
    made = []
    for name, kind, source in measures:
        measure(kind, source, False)  # an unknown one is an error
        if kind == "count":
            value = F.col("_rows")
        else:
            total = sources[source]
            n = F.when(F.col(counts[total]) > 0, F.col(counts[total]))
            value = F.round(F.col(total) if kind == "sum" else F.col(total) / n, 2)
        made.append(value.alias(name))
    return summed.select(*keys, *made)
