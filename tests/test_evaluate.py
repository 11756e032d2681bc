import random
from fractions import Fraction

import pytest
from conftest import rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from demandloom.functions.exact import sum_of_squares
from demandloom.operators import evaluate

SCHEMA = "y double, p double"
NAN = float("nan")


def metrics(spark, data, exact):
    df = spark.createDataFrame(data, SCHEMA)
    return evaluate.regression_metrics(df, "y", "p", exact=exact).first()


@pytest.mark.parametrize("exact", [False, True])
def test_equal_the_library_evaluator(spark, exact):
    rng = random.Random(3)
    data = [(round(rng.uniform(0, 90), 2), round(rng.uniform(0, 90), 2)) for _ in range(500)]
    df = spark.createDataFrame(data, SCHEMA)
    got = metrics(spark, data, exact)
    for name in ("mae", "rmse", "r2"):
        evaluator = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name)
        assert got[name] == pytest.approx(evaluator.evaluate(df), rel=1e-12)


@pytest.mark.parametrize("exact", [False, True])
@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_values_that_are_not_finite_count_as_missing(spark, odd, exact):
    data = [(1.0, 2.0), (3.0, 3.0), (4.0, 2.0)]
    with_odd = metrics(spark, [*data, (odd, 1.0), (1.0, odd), (odd, odd)], exact)
    assert tuple(with_odd) == pytest.approx(tuple(metrics(spark, data, exact)))


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("data", [[(9e15, 1.0)] * 11, [(9e15, 1.0)] * 400, [(4e16, 1.0)] * 4])
def test_large_labels_are_right_or_an_error(spark, ansi, data):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        if len(data) == 11:
            got = metrics(spark, data, True)
            assert got["mae"] == pytest.approx(9e15) and got["r2"] == 0.0
        else:
            with pytest.raises(Exception, match="no exact hundredths|too large for exact|Decimal"):
                metrics(spark, data, True)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


@pytest.mark.parametrize("exact", [False, True])
def test_constant_label(spark, exact):
    assert metrics(spark, [(2.0, 2.0), (2.0, 2.0)], exact)["r2"] == 1.0
    assert metrics(spark, [(2.0, 2.0), (2.0, 3.0)], exact)["r2"] == 0.0


@pytest.mark.parametrize("exact", [False, True])
def test_fewer_than_two_rows_and_nulls(spark, exact):
    one = metrics(spark, [(2.0, 3.0), (None, 1.0), (1.0, None)], exact)
    assert (one["n_rows"], one["mae"], one["rmse"], one["r2"]) == (1, 1.0, 1.0, None)
    none = metrics(spark, [(None, 3.0)], exact)
    assert (none["n_rows"], none["mae"], none["rmse"], none["r2"]) == (0, None, None, None)


def test_groups_and_long_form(spark):
    df = spark.createDataFrame(
        [("test", 1.0, 1.0, 2.0), ("test", 3.0, 3.0, 5.0), ("train", 1.0, 0.0, 1.0)],
        "split string, y double, a double, b double",
    )
    long = evaluate.long_predictions(df, "y", {"A": "a", "B": "b"}, ["split"])
    assert long.count() == 6
    got = evaluate.regression_metrics(long, "label", "prediction", ["model", "split"])
    assert rows(got, "model", "split", "n_rows", "mae") == [
        ("A", "test", 2, 0.0),
        ("A", "train", 1, 1.0),
        ("B", "test", 2, 1.5),
        ("B", "train", 1, 0.0),
    ]


@pytest.mark.parametrize("exact", [False, True])
def test_wide_form_equals_the_long_one_and_keeps_models_without_scores(spark, exact):
    df = spark.createDataFrame(
        [("test", 1.0, 1.0, 2.0, None), ("test", 3.0, None, 5.0, NAN), ("train", 1.5, 0.0, 1.0, None)],
        "split string, y double, a double, b double, c double",
    )
    models = {"A": "a", "B": "b", "C": "c"}
    long = evaluate.long_predictions(df, "y", models, ["split"])
    want = evaluate.regression_metrics(long, "label", "prediction", ["model", "split"], exact)
    got = evaluate.model_metrics(df, "y", models, ["split"], exact)
    names = ("model", "split", "n_rows", "mae", "rmse", "r2")
    assert rows(got.where("n_rows > 0"), *names) == rows(want, *names)
    none = rows(got.where("n_rows = 0"), *names)
    assert none == [("C", split, 0, None, None, None) for split in ("test", "train")]


def test_squares_of_any_size_sum_exactly(spark):
    values = [0, 1, -3, 2**21, -(2**31) + 1, 2**31, -(2**31), 10**12, 2**53 + 1]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v bigint")
    total = df.agg(sum_of_squares(F.col("v")).alias("t")).first()["t"]
    assert int(total) == sum(v * v for v in values)


def test_exact_r2_of_large_values(spark):
    data = [(1e10 + i, 1e10 + i + (i % 3)) for i in range(50)]
    got = metrics(spark, data, True)["r2"]
    y = [Fraction(a) for a, _ in data]
    mean = sum(y) / len(y)
    sse = sum((Fraction(a) - Fraction(b)) ** 2 for a, b in data)
    assert got == pytest.approx(float(1 - sse / sum((v - mean) ** 2 for v in y)), rel=1e-12)
    assert metrics(spark, data, False)["r2"] == pytest.approx(got, rel=1e-9)
