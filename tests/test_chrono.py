import random
from fractions import Fraction

import pytest
from conftest import plan_of, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from demandloom.operators import chrono
from demandloom.session import materialize


def days(spark, n, kind="date"):
    return spark.range(1, n + 1).selectExpr(
        "cast(id as int) as id",
        f"cast(date_add(date'2023-11-24', cast(id as int) * 3) as {kind}) as d",
    )


def ids(df):
    return [r["id"] for r in df.orderBy("id").collect()]


def test_ten_days_split_six_two_two(spark):
    df = days(spark, 10)
    split = chrono.fit_chrono_split(df, ["d", "id"])
    assert split.sizes == (6, 2, 2)
    assert ids(split.take(df, "train")) == [1, 2, 3, 4, 5, 6]
    assert ids(split.take(df, "validation")) == [7, 8]
    assert ids(split.take(df, "test")) == [9, 10]


def test_dates_as_text(spark):
    df = days(spark, 10, "string")
    assert ids(chrono.fit_chrono_split(df, ["d", "id"]).take(df, "test")) == [9, 10]


def test_known_sizes():
    assert chrono.split_sizes(74900) == (47936, 11984, 14980)
    for n in range(0, 200):
        train, validation, test = chrono.split_sizes(n)
        assert train + validation + test == n
        assert test == (n + 4) // 5
        assert validation == (n - test + 4) // 5
    assert chrono.split_sizes(10, Fraction(1, 10)) == (8, 1, 1)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 7, 13, 50])
def test_small_inputs(spark, n):
    df = days(spark, n)
    split = chrono.fit_chrono_split(df, ["d", "id"])
    labelled = split.label(df)
    got = {r["split"]: r["count"] for r in labelled.groupBy("split").count().collect()}
    assert tuple(got.get(name, 0) for name in chrono.SPLITS) == chrono.split_sizes(n)


def shuffled(spark, n, dates, seed=1, nulls=False):
    rng = random.Random(seed)
    choices = [f"2026-01-{d:02d}" for d in range(1, dates + 1)] + ([None] if nulls else [])
    data = [(rng.choice(choices), f"k{i:05d}", i) for i in range(n)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "day string, k string, id int").repartition(3)
    return df.selectExpr("cast(day as date) as d", "k", "id")


def brute(df, order):
    n = df.count()
    ranked = df.withColumn("rn", F.row_number().over(Window.orderBy(*order)))
    return rows(chrono.split_by_rank(ranked, n), "id", "split")


@pytest.mark.parametrize("fetch", [4096, 3])
@pytest.mark.parametrize(
    "shape",
    [
        dict(n=97, dates=1),
        dict(n=200, dates=3),
        dict(n=150, dates=9, nulls=True),
        dict(n=60, dates=1, nulls=True),
    ],
)
def test_cut_points_equal_a_global_row_number(spark, monkeypatch, shape, fetch):
    monkeypatch.setattr(chrono, "FETCH", fetch)
    df = materialize(shuffled(spark, **shape), "shuffled")
    split = chrono.fit_chrono_split(df, ["d", "k"])
    assert rows(split.label(df), "id", "split") == brute(df, ["d", "k"])
    for name in chrono.SPLITS:
        taken = rows(split.take(df, name), "id")
        assert taken == rows(split.label(df).where(F.col("split") == name), "id")


def test_timestamps_are_cut_within_the_day(spark):
    df = spark.range(100).selectExpr(
        "cast(id as int) as id",
        "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id * 7.25) as t",
    )
    split = chrono.fit_chrono_split(df, ["t"])
    assert rows(split.label(df), "id", "split") == brute(df, ["t"])


def test_indistinguishable_rows_at_a_cut_are_an_error(spark):
    df = spark.range(10).selectExpr("date'2026-01-01' as d", "'k' as k", "cast(id as int) as id")
    with pytest.raises(ValueError, match="add a column to the order"):
        chrono.fit_chrono_split(df, ["d", "k"])
    assert chrono.fit_chrono_split(df, ["d", "k", "id"]).sizes == (6, 2, 2)


def test_nth_row_narrows_without_knowing_the_size(spark, monkeypatch):
    monkeypatch.setattr(chrono, "FETCH", 2)
    df = shuffled(spark, 120, 1)
    expected = [r["k"] for r in df.orderBy("k").collect()]
    for position in (1, 37, 120):
        assert chrono.nth_row(df, ["d", "k"], position) == ("2026-01-01", expected[position - 1])
    with pytest.raises(ValueError, match="beyond the last row"):
        chrono.nth_row(df, ["d", "k"], 121)


def test_a_hot_tuple_does_not_stall_the_search(spark, monkeypatch):
    monkeypatch.setattr(chrono, "FETCH", 2)
    df = spark.range(300).selectExpr("if(id < 290, 5, cast(id as int)) as v")
    assert chrono.nth_row(df, ["v"], 290) == ("5",)
    assert chrono.nth_row(df, ["v"], 291) == ("290",)
    with pytest.raises(ValueError, match="several rows share"):
        chrono.nth_row(df, ["v"], 100)


@pytest.mark.parametrize("parts", [1, 4, 11])
def test_rank_equals_a_global_row_number(spark, parts):
    df = shuffled(spark, 300, 2, nulls=True)
    expected = rows(df.withColumn("rn", F.row_number().over(Window.orderBy("d", "k"))), "id", "rn")
    assert rows(chrono.chrono_rank(df, ["d", "k"], parts=parts), "id", "rn") == expected


def test_rank_spreads_one_hot_date(spark):
    df = shuffled(spark, 400, 1)
    placed = chrono.place_in_order(df, ["d", "k"], 8)
    sizes = [r["count"] for r in placed.groupBy("_part").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 200


def test_taking_a_split_filters_in_the_scan(spark):
    df = materialize(days(spark, 10), "days")
    plan = plan_of(chrono.fit_chrono_split(df, ["d", "id"]).take(df, "test"))
    assert "PushedFilters: [Or(" in plan
    assert "Exchange" not in plan


def test_profile(spark):
    df = spark.createDataFrame(
        [("train", 1.0, None), ("train", None, None), ("test", 1.0, 2.0)],
        "split string, a double, b double",
    )
    assert rows(chrono.split_profile(df, ["a", "b"])) == [("test", 1, 0, 0), ("train", 2, 1, 2)]


def test_unknown_split(spark):
    df = days(spark, 10)
    with pytest.raises(ValueError, match="split must be"):
        chrono.fit_chrono_split(df, ["d", "id"]).take(df, "holdout")
