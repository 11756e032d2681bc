"""Sums of any doubles that come out the same, bit for bit, however rows are dealt and ordered.

A finite double is a whole number of ``2^-1074``. Its 53 bits are cut into limbs of 21 bits at
fixed places, whose sums are whole numbers too, so their order cannot matter. Per group
few limbs are in use; in the end they are carried into one number and rounded once. The result
is the double nearest to the true sum, ties to even.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIMB = 21  # bits; sums of limbs hold for 10^12 rows
LEAST = -1074  # exponent of the smallest double
LIMBS = 4  # that a double can reach into
# Values of the limbs' units; larger ones are beyond every double.
UNITS = [2.0 ** (LIMB * i + LEAST) for i in range((1023 - LEAST) // LIMB + 1)]
# The place of values that are not finite.
ODD = -1


def exact_sums(
    df: DataFrame,
    keys: Sequence[str],
    columns: Mapping[str, Column | str],
    counts: Mapping[str, str] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """One row per key combination: the exact sum of each column, rounded once.

    ``counts`` maps names of ``columns`` to columns for their numbers of values, ``rows`` names
    one for the number of rows.

    NULLs are skipped; a sum of no value is NULL. NaN, or infinities of both signs, make
    NaN; one kind of infinity makes that. A sum beyond the largest double is infinite.
    Every task sends at most some rows per group and magnitude, so a hot group is cheap.
    Without ``keys`` there is one row. NULL keys form groups.
    """
    names = list(columns)
    values = [F.col(c) if isinstance(c, str) else c for c in columns.values()]
    each = [
        F.struct(F.lit(i).alias("_of"), value.cast("double").alias("_value"))
        for i, value in enumerate(values)
    ]
    held = [f"_key{i}" for i in range(len(keys))]
    renamed = [F.col(k).alias(h) for k, h in zip(keys, held, strict=True)]
    limbs = [f"_{i}" for i in range(LIMBS)]
    # A NULL has no place, but its group is there.
    per_place = (
        _limbs(df.select(*renamed, F.inline(F.array(*each))))
        .groupBy(*held, "_of", "_place")
        .agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(c) for c in limbs])
    )
    entry, numbers = F.struct("_place", *limbs), []
    for i, name in enumerate(names):
        mine = (F.col("_of") == i) & F.col("_place").isNotNull()
        numbers.append(F.collect_list(F.when(mine, entry)).alias(f"_of{i}"))
        if counts and name in counts:
            numbers.append(F.coalesce(F.sum(F.when(mine, F.col("_n"))), F.lit(0)).alias(f"_n{i}"))
    n_rows = F.coalesce(F.sum(F.when(F.col("_of") == 0, F.col("_n"))), F.lit(0)).alias("_rows")
    gathered = per_place.groupBy(*held).agg(*numbers, n_rows)
    back = [F.col(h).alias(k) for k, h in zip(keys, held, strict=True)]
    rounded = _rounded(gathered, len(names))
    found = [F.col(f"_sum{i}").alias(name) for i, name in enumerate(names)]
    found += [F.col(f"_n{i}").alias(counts[n]) for i, n in enumerate(names) if counts and n in counts]
    return rounded.select(*back, *found, *([F.col("_rows").alias(rows)] if rows else []))


def _limbs(rows: DataFrame) -> DataFrame:
    """Add the place of the highest limb of ``_value`` and, with its sign, that limb and the three
    below; for values that are not finite, what they are. Step by step, as each is used often."""
    value, size, place = F.col("_value"), F.col("_size"), F.col("_place")
    units = F.array(*[F.lit(u) for u in UNITS])
    # One place more than the logarithm says, as it may be off by one at powers of two.
    highest = F.floor((F.floor(F.log2(size)) + 1 - LEAST) / LIMB).cast("int")
    found = F.when(size == 0, 0).when(size < float("inf"), F.least(highest, F.lit(len(UNITS) - 1)))
    rows = rows.withColumn("_size", F.abs(value))
    rows = rows.withColumn("_place", F.when(value.isNotNull(), F.coalesce(found, F.lit(ODD))))
    flags = [F.isnan(value), value == float("inf"), value == float("-inf"), F.lit(False)]
    rows = rows.withColumn("_left", size)
    for i in range(LIMBS):
        known = F.element_at(units, F.greatest(place - i, F.lit(0)) + 1)
        rows = rows.withColumn(f"_unit{i}", F.when(place >= i, known))
        whole = F.coalesce(F.floor(F.col("_left") / F.col(f"_unit{i}")), F.lit(0))
        rows = rows.withColumn(f"_limb{i}", whole)
        taken = F.col(f"_limb{i}").cast("double") * F.coalesce(F.col(f"_unit{i}"), F.lit(0.0))
        rows = rows.withColumn("_left", F.col("_left") - taken)
        signed = F.when(value < 0, -F.col(f"_limb{i}")).otherwise(F.col(f"_limb{i}"))
        told = F.when(place == ODD, flags[i].cast("long")).otherwise(signed)
        rows = rows.withColumn(f"_{i}", told)
    return rows


def _carried(totals: Column) -> Column:
    """Limbs from sums of limbs, lowest first, and what is carried beyond them: -1 if negative."""
    start = F.struct(F.lit(0).cast("long").alias("carry"), F.slice(totals, 1, 0).alias("limbs"))

    def step(done: Column, total: Column) -> Column:
        whole = total + done["carry"]
        limb = whole.bitwiseAND(F.lit((1 << LIMB) - 1))
        return F.struct(
            F.shiftright(whole, LIMB).alias("carry"), F.concat(done["limbs"], F.array(limb)).alias("limbs")
        )

    return F.aggregate(totals, start, step)


def _rounded(gathered: DataFrame, columns: int) -> DataFrame:
    """Add ``_sum0``, ... to the entries ``_of0``, ...: step by step, as each step is used often."""

    def col(name: str, i: int) -> Column:
        return F.col(f"_{name}{i}")

    def add(df: DataFrame, **made) -> DataFrame:
        new = {f"_{name}{i}": make(i) for i in range(columns) for name, make in made.items()}
        return df.withColumns(new)

    def total(finite: Column, at: Column) -> Column:
        def step(done: Column, e: Column) -> Column:
            for i in range(LIMBS):
                done = done + F.when(e["_place"] == at + i, e[f"_{i}"]).otherwise(F.lit(0))
            return done

        return F.aggregate(finite, F.lit(0).cast("long"), step)

    def places(i: int) -> Column:
        return F.transform(col("finite", i), lambda e: e["_place"])

    def limb(i: int, place: Column) -> Column:
        k = place - col("first", i) + 1
        inside = (k >= 1) & (k <= F.size(col("limbs", i)))
        known = F.element_at(col("limbs", i), F.when(inside, k).otherwise(F.lit(1)))
        return F.when(inside, known).otherwise(F.lit(0))

    def highest(i: int) -> Column:
        """The four highest limbs, from place ``low`` on, as one whole number.

        They hold more bits than a double; one bit more tells whether there is any below.
        """
        wide, low = "decimal(28,0)", col("low", i)
        number = F.lit(0).cast(wide)
        for k in reversed(range(LIMBS)):
            step = F.lit(1 << LIMB).cast("decimal(7,0)")
            number = (number * step + limb(i, low + k).cast("decimal(7,0)")).cast(wide)
        below = F.exists(col("used", i), lambda k: col("first", i) + k - 1 < low)
        rest = below.cast("int").cast("decimal(1,0)")
        return (number * F.lit(2).cast("decimal(1,0)") + rest).cast(wide).cast("double")

    def result(i: int) -> Column:
        low, units = col("low", i), F.array(*[F.lit(u) for u in UNITS])
        unit = F.element_at(units, F.least(low + 1, F.lit(len(UNITS))))
        unit = F.when(low < len(UNITS), unit).otherwise(F.lit(float("inf")))
        size = F.when(F.size(col("used", i)) == 0, 0.0).otherwise(col("number", i) * 0.5 * unit)
        signed = F.when(col("negative", i), -size).otherwise(size)
        nan, up, down = (F.coalesce(col("odd", i)[f"_{k}"] > 0, F.lit(False)) for k in range(3))
        return (
            F.when(F.size(col("of", i)) == 0, F.lit(None).cast("double"))
            .when(nan | (up & down), F.lit(float("nan")))
            .when(up, F.lit(float("inf")))
            .when(down, F.lit(float("-inf")))
            .when(F.size(col("finite", i)) > 0, signed)
        )

    df = add(
        gathered,
        finite=lambda i: F.filter(col("of", i), lambda e: e["_place"] != ODD),
        odd=lambda i: F.get(F.filter(col("of", i), lambda e: e["_place"] == ODD), F.lit(0)),
    )
    df = add(df, first=lambda i: F.greatest(F.array_min(places(i)) - (LIMBS - 1), F.lit(0)))
    # Room above for what is carried out of the highest limb.
    df = add(
        df,
        totals=lambda i: F.transform(
            F.sequence(col("first", i), F.array_max(places(i)) + 4),
            lambda at: total(col("finite", i), at),
        ),
    )
    df = add(df, negative=lambda i: _carried(col("totals", i))["carry"] < 0)
    df = add(
        df,
        size=lambda i: F.transform(
            col("totals", i), lambda t: F.when(col("negative", i), -t).otherwise(t)
        ),
    )
    df = add(df, limbs=lambda i: _carried(col("size", i))["limbs"])
    df = add(
        df,
        used=lambda i: F.filter(
            F.sequence(F.lit(1), F.size(col("limbs", i))),
            lambda k: F.element_at(col("limbs", i), k) != 0,
        ),
    )
    df = add(
        df, low=lambda i: F.greatest(col("first", i) + F.array_max(col("used", i)) - LIMBS, F.lit(0))
    )
    return add(add(df, number=highest), sum=result)
