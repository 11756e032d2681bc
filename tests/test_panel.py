import random

import pytest
from conftest import plan_of, rows

from demandloom import settings as s
from demandloom.operators.panel import hot_series_features, series_features, with_calendar


def panel(spark, data):
    df = spark.createDataFrame(data, "product_name string, day string, total_demand double")
    return df.selectExpr("product_name", "cast(day as date) as transaction_date", "total_demand")


def featured(df, exact=True):
    return series_features(
        df, s.TARGET, ["product_name"], [s.TIME], s.LAGS, s.ROLLING, s.ROLLING_ROWS, exact
    )


@pytest.mark.parametrize("exact", [False, True])
def test_short_series_and_partial_frames(spark, exact):
    data = [("one", "2026-01-01", 5.0)]
    data += [("two", f"2026-01-0{d}", float(d)) for d in (1, 2)]
    data += [("nine", f"2026-01-0{d}", float(d * 10)) for d in range(1, 10)]
    out = featured(panel(spark, data), exact)
    got = rows(out.selectExpr("product_name", "day(transaction_date) as d", *s.COLD_START))
    expected = [
        ("nine", 1, None, None, None),
        ("nine", 2, 10.0, None, 10.0),
        ("nine", 3, 20.0, None, 15.0),
        ("nine", 4, 30.0, None, 20.0),
        ("nine", 5, 40.0, None, 25.0),
        ("nine", 6, 50.0, None, 30.0),
        ("nine", 7, 60.0, None, 35.0),
        ("nine", 8, 70.0, 10.0, 40.0),
        ("nine", 9, 80.0, 20.0, 50.0),
        ("one", 1, None, None, None),
        ("two", 1, None, None, None),
        ("two", 2, 1.0, None, 1.0),
    ]
    assert got == expected


def test_lags_count_rows_not_days(spark):
    data = [("a", "2026-01-01", 1.0), ("a", "2026-01-05", 2.0), ("a", "2026-03-06", 3.0)]
    got = rows(featured(panel(spark, data)), s.TIME, "demand_1", s.ROLLING)
    assert [g[1:] for g in got] == [(None, None), (1.0, 1.0), (2.0, 1.5)]


def test_no_feature_uses_the_target_of_its_own_row(spark):
    data = [("a", f"2026-01-{d:02d}", float(d)) for d in range(1, 21)]
    changed = data[:-1] + [("a", "2026-01-20", 1e6)]
    names = [s.TIME, *s.COLD_START]
    before, after = (rows(featured(panel(spark, d)), *names) for d in (data, changed))
    assert before == after


def test_null_targets_are_skipped_by_the_mean(spark):
    data = [("a", "2026-01-01", None), ("a", "2026-01-02", 4.0), ("a", "2026-01-03", 1.0)]
    got = rows(featured(panel(spark, data)), s.TIME, "demand_1", s.ROLLING)
    assert [g[1:] for g in got] == [(None, None), (None, None), (4.0, 4.0)]


def test_one_exchange_and_one_window(spark):
    plan = plan_of(featured(panel(spark, [("a", "2026-01-01", 1.0)]), exact=False))
    assert plan.count("Exchange") == 1
    assert plan.count("Window [") == 1


def test_calendar(spark):
    df = panel(spark, [("a", "2026-01-04", 1.0), ("a", "2026-02-07", 1.0)])
    assert rows(with_calendar(df, s.TIME), "month", "day_of_week") == [(1, 1), (2, 7)]


def events(spark, n, kinds, seed, repartition=5):
    rng = random.Random(seed)
    data = [
        (i, kinds(rng), rng.choice([None, *range(n // 10 + 1)]), round(rng.uniform(-5, 5), 2))
        for i in range(n)
    ]
    return spark.createDataFrame(data, "id int, kind string, t int, v double").repartition(
        repartition
    )


CASES = {
    "one series": lambda rng: "a",
    "a third in one series": lambda rng: "a" if rng.random() < 0.33 else f"s{rng.randrange(40)}",
    "tiny series": lambda rng: f"s{rng.randrange(300)}",
    "with NULL": lambda rng: rng.choice([None, "a", "b"]),
}


@pytest.mark.parametrize("case", CASES)
def test_hot_series_equal_plain_windows(spark, case):
    df = events(spark, 600, CASES[case], seed=len(case))
    arguments = ("v", ["kind"], ["t", "id"], {1: "v1", 7: "v7"}, "mean", 7, True)
    names = ["id", "v1", "v7", "mean"]
    plain = rows(series_features(df, *arguments), *names)
    for parts in (1, 4, 50):
        assert rows(hot_series_features(df, *arguments, parts=parts), *names) == plain


def test_hot_series_with_one_instant_for_all(spark):
    df = spark.range(500).selectExpr("'a' as kind", "0 as t", "cast(id as int) as id", "1.5D as v")
    out = hot_series_features(df, "v", ["kind"], ["t", "id"], {7: "v7"}, parts=20)
    assert out.where("v7 is null").count() == 7
    assert out.count() == 500
    assert out.columns == ["kind", "t", "id", "v", "v7"]


def test_hot_series_rows_are_exchanged_once_after_placing(spark):
    df = events(spark, 50, CASES["one series"], seed=1)
    plan = plan_of(hot_series_features(df, "v", ["kind"], ["t", "id"], {1: "v1"}, parts=4))
    windows = plan[: plan.index("Union")]
    assert windows.count("Exchange") == 1
    assert "Exchange rangepartitioning(_part" in windows


def test_tails_of_a_hot_series_never_meet_in_one_task(spark):
    """With a long lag over many parts, only one line per part is exchanged by series."""
    df = spark.range(3000).selectExpr(
        "'a' as kind", "cast(id as int) as t", "cast(id as int) as id", "cast(id % 7 as double) as v"
    )
    arguments = ("v", ["kind"], ["t", "id"], {1: "v1", 90: "v90"}, "mean", 60, True)
    hot = hot_series_features(df, *arguments, parts=50)
    names = ["id", "v1", "v90", "mean"]
    assert rows(hot, *names) == rows(series_features(df, *arguments), *names)
    lines = plan_of(hot).splitlines()
    by_series = [i for i, line in enumerate(lines) if "hashpartitioning(kind" in line and "_part" not in line]
    assert by_series
    for at in by_series:
        below = next(line for line in lines[at + 1 :] if "Aggregate" in line or "Exchange" in line)
        assert "HashAggregate(keys=[kind" in below and "_part" in below
