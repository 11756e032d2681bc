"""Key, calendar and row-order expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def composite_key(time: str, parts: Sequence[str], sep: str = "-") -> Column:
    """``yyyyMMdd-part-part``. NULL parts are left out, so keys can collide: audit them."""
    return F.concat_ws(sep, F.date_format(F.col(time), "yyyyMMdd"), *[F.col(p) for p in parts])


def calendar(time: str) -> dict[str, Column]:
    """``month`` 1-12 and ``day_of_week`` 1 (Sunday) to 7 (Saturday)."""
    return {"month": F.month(time), "day_of_week": F.dayofweek(time)}


def zero_filled(columns: Sequence[str]) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c), F.lit(0)) for c in columns}


def after(columns: Sequence[str], values: Sequence[Column | None]) -> Column:
    """True for rows strictly after the tuple ``values`` in ascending, NULLs-first order.

    Plain comparisons joined by AND / OR, so a filter on it reaches the parquet
    scan. ``None`` stands for a NULL component. Other rows give false or NULL.
    """
    column, value = F.col(columns[0]), values[0]
    beyond = column.isNotNull() if value is None else column > value
    if len(columns) == 1:
        return beyond
    same = column.isNull() if value is None else column == value
    return beyond | (same & after(columns[1:], values[1:]))


def up_to(columns: Sequence[str], values: Sequence[Column | None]) -> Column:
    """True for rows at or before the tuple ``values``: the complement of ``after``."""
    column, value = F.col(columns[0]), values[0]
    if len(columns) == 1:
        return column.isNull() if value is None else column.isNull() | (column <= value)
    rest = up_to(columns[1:], values[1:])
    if value is None:
        return column.isNull() & rest
    return column.isNull() | (column < value) | ((column == value) & rest)
