"""Two-decimal arithmetic in integer hundredths.

Sums and means of doubles depend on the order rows arrive in, hence on the
partitioning; sums of integers do not. These expressions give the same value on
every run and every cluster size, for inputs with at most two decimals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Value of ``exact`` for sums of any doubles, see ``operators.anysum``.
DOUBLES = "doubles"


def finite(value: Column) -> Column:
    """The value as a double; NULL for NaN and the infinities, which Spark orders above all."""
    number = value.cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


# Hundredths of anything below are at most 1e18: nine of them fit a bigint sum.
LARGEST = 1e16


def hundredths(value: Column) -> Column:
    """The value as a bigint count of hundredths; an error from ``LARGEST`` on."""
    too_large = F.raise_error(F.lit(f"{LARGEST:g} or more has no exact hundredths")).cast("bigint")
    counted = F.round(value * F.lit(100)).cast("bigint")
    return F.when(F.abs(value) >= LARGEST, too_large).otherwise(counted)


def from_hundredths(count: Column) -> Column:
    return count.cast("double") / F.lit(100.0)


def integer_div(numerator: Column, denominator: Column) -> Column:
    return F.call_function("div", numerator, denominator)


def mean_of_hundredths(total: Column, n: Column) -> Column:
    """``total / n`` hundredths rounded half away from zero to two decimals; NULL for n = 0."""
    magnitude = integer_div(F.abs(total) * 2 + n, n * 2)
    signed = F.when(total < 0, -magnitude).otherwise(magnitude)
    return F.when(n > 0, from_hundredths(signed))


def exact_sum(whole: Column) -> Column:
    """Aggregate: exact sum of a bigint column as decimal(38,0), NULL without rows.

    Three limbs of 21 bits, the top one signed, each summed as bigint: no wrapping for
    4e12 rows, whether the session checks overflows or not.
    """
    mask = F.lit((1 << 21) - 1)
    total = F.sum(F.shiftright(whole, 42)).cast("decimal(19,0)") * F.lit(1 << 42).cast(
        "decimal(19,0)"
    )
    for shift in (0, 21):
        limb = F.sum(F.shiftright(whole, shift).bitwiseAND(mask)).cast("decimal(19,0)")
        total = total + limb * F.lit(1 << shift).cast("decimal(19,0)")
    return total.cast("decimal(38,0)")


def sum_of_squares(whole: Column) -> Column:
    """Aggregate: exact sum of squares of a bigint column, as decimal(38,0).

    Decimal arithmetic per row is slow, and a bigint sum of squares overflows
    early. A square that fits 62 bits is cut into three limbs of 21 bits, each
    summed as bigint, which holds for 4e12 rows; larger ones go through decimals.
    """
    small = F.abs(whole) < F.lit(1 << 31)
    square = F.when(small, whole * whole).otherwise(F.lit(0))
    mask = F.lit((1 << 21) - 1)
    wide = whole.cast("decimal(19,0)")
    total = F.sum(F.when(~small, wide * wide))
    total = F.coalesce(total, F.lit(0).cast("decimal(38,0)"))
    for shift in (0, 21, 42):
        limb = F.sum(F.shiftright(square, shift).bitwiseAND(mask)).cast("decimal(19,0)")
        total = total + limb * F.lit(1 << shift).cast("decimal(19,0)")
    return total.cast("decimal(38,0)")
