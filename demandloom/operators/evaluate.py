"""Regression metrics as one aggregate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.functions.exact import DOUBLES, exact_sum, finite, hundredths, sum_of_squares
from demandloom.operators.anysum import exact_sums
from demandloom.session import materialize


def long_predictions(
    df: DataFrame, label: str, predictions: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """One row per model and input row: ``model, label, prediction`` and the ``keep`` columns."""
    pairs = F.array(
        *[
            F.struct(F.lit(model).alias("model"), F.col(c).cast("double").alias("prediction"))
            for model, c in predictions.items()
        ]
    )
    return df.select(*keep, F.col(label).cast("double").alias("label"), F.inline(pairs))


def regression_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    by: Sequence[str] = (),
    exact: bool | str = False,
) -> DataFrame:
    """``n_rows, mae, rmse, r2`` over rows with both values, per ``by`` group, in one pass.

    NaN and infinite values count as missing; a group without any row is left out.
    r2 is 1 - SSE / SST; for a constant label 1 if every prediction is right
    and 0 if not; NULL below two rows. Group state is a few numbers and combines
    before the exchange. ``exact`` computes in integer hundredths, for values
    with two decimals.
    """
    found = model_metrics(df, label, {"": prediction}, by, exact, "_model").drop("_model")
    return found.where("n_rows > 0") if by else found


def model_metrics(
    df: DataFrame,
    label: str,
    predictions: Mapping[str, str],
    by: Sequence[str] = (),
    exact: bool | str = False,
    name: str = "model",
) -> DataFrame:
    """The same for several prediction columns: one aggregate over the rows as they are.

    One row per model and group; the few results are turned into rows, not the input.
    A model without a scored row has ``n_rows`` 0 and no scores. ``exact="doubles"`` adds up
    any doubles exactly, in a second pass the squares around the mean label.
    """
    if exact == DOUBLES:
        return _metrics_of_doubles(df, label, predictions, by, name)
    y = finite(F.col(label))
    sums, scores = [], []
    for i, (model, column) in enumerate(predictions.items()):
        p = finite(F.col(column))
        both = y.isNotNull() & p.isNotNull()
        own, result = _metrics(F.when(both, y), F.when(both, p), f"_{i}", exact)
        sums += own
        scores.append(F.struct(F.lit(model).alias(name), *result))
    return df.groupBy(*by).agg(*sums).select(*by, F.inline(F.array(*scores)))


def _metrics(y: Column, p: Column, tag: str, exact: bool) -> tuple[list[Column], list[Column]]:
    """Aggregates over rows, and the metrics as expressions over them."""

    def of(name: str) -> Column:
        return F.col(f"{tag}_{name}")

    if exact:
        y, p = hundredths(y), hundredths(p)
        error = y - p
        parts = {
            "n": F.count(y),
            "abs": exact_sum(F.abs(error)),
            "sse": sum_of_squares(error),
            "y": exact_sum(y),
            "yy": sum_of_squares(y),
        }
        n = of("n")
        # n times the sums of squares; one division at the end.
        big_n = n.cast("decimal(19,0)")
        # Sums hold for any labels below 1e16; what outgrows 38 digits is an error here
        # whether the session raises overflows or makes them NULL.
        sse = _fits(big_n * of("sse"), n)
        sst = _fits(big_n * of("yy") - of("y") * of("y"), n)
        mae = of("abs").cast("double") / (n * 100).cast("double")
        rmse = F.sqrt(of("sse").cast("double") / n.cast("double")) / F.lit(100.0)
        mae, rmse = (F.when(n > 0, x) for x in (mae, rmse))
    else:
        error = y - p
        parts = {
            "n": F.count(y),
            "abs": F.avg(F.abs(error)),
            "sse": F.avg(error * error),
            "var": F.var_pop(y),
        }
        n, sse, sst = of("n"), of("sse"), of("var")
        mae, rmse = of("abs"), F.sqrt(of("sse"))
    sums = [part.alias(f"{tag}_{name}") for name, part in parts.items()]
    r2 = _r2(n, sse, sst)
    return sums, [n.alias("n_rows"), mae.alias("mae"), rmse.alias("rmse"), r2.alias("r2")]


def _metrics_of_doubles(
    df: DataFrame, label: str, predictions: Mapping[str, str], by: Sequence[str], name: str
) -> DataFrame:
    y, groups = finite(F.col(label)), [f"_by{i}" for i in range(len(by))]
    columns = [F.col(c).alias(g) for c, g in zip(by, groups, strict=True)]
    for i, column in enumerate(predictions.values()):
        p = finite(F.col(column))
        both = y.isNotNull() & p.isNotNull()
        columns += [F.when(both, y).alias(f"_y{i}"), F.when(both, p).alias(f"_p{i}")]
    rows, of = df.select(*columns), range(len(predictions))
    sums: dict[str, Column] = {}
    for i in of:
        error = F.col(f"_y{i}") - F.col(f"_p{i}")
        sums |= {f"_sum{i}": F.col(f"_y{i}"), f"_abs{i}": F.abs(error), f"_sse{i}": error * error}
    first = exact_sums(rows, groups, sums, {f"_sum{i}": f"_n{i}" for i in of})
    first = materialize(first, "metric-sums")
    held = [F.col(g).alias(f"_of{g}") for g in groups]
    means = first.select(*held, *[(F.col(f"_sum{i}") / _some(f"_n{i}")).alias(f"_mean{i}") for i in of])
    apart = [F.col(f"_y{i}") - F.col(f"_mean{i}") for i in of]
    around = {f"_sst{i}": d * d for i, d in enumerate(apart)}
    second = exact_sums(rows.join(means, _same(groups)), groups, around).select(
        *held, *[f"_sst{i}" for i in of]
    )
    scores = []
    for i, model in enumerate(predictions):
        n, big = F.col(f"_n{i}"), _some(f"_n{i}")
        mae, rmse = F.col(f"_abs{i}") / big, F.sqrt(F.col(f"_sse{i}") / big)
        r2 = _r2(n, F.col(f"_sse{i}"), F.col(f"_sst{i}"))
        named = {name: F.lit(model), "n_rows": n, "mae": mae, "rmse": rmse, "r2": r2}
        scores.append(F.struct(*[c.alias(k) for k, c in named.items()]))
    back = [F.col(g).alias(c) for c, g in zip(by, groups, strict=True)]
    return first.join(second, _same(groups)).select(*back, F.inline(F.array(*scores)))


def _some(count: str) -> Column:
    return F.when(F.col(count) > 0, F.col(count))


def _same(groups: Sequence[str]) -> Column:
    same = F.lit(True)
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_of{g}"))
    return same


def _fits(value: Column, n: Column) -> Column:
    too_large = F.raise_error(F.lit("labels too large for exact metrics"))
    return F.when(n > 0, F.coalesce(value, too_large))


def _r2(n: Column, sse: Column, sst: Column) -> Column:
    return F.when(
        n >= 2,
        F.when(sst == 0, F.when(sse == 0, 1.0).otherwise(0.0)).otherwise(
            F.lit(1.0) - sse.cast("double") / sst.cast("double")
        ),
    )
