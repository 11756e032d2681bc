from conftest import plan_of, rows
import pytest

from demandloom import settings as s
from demandloom.operators.facts import daily_facts
from demandloom.operators.refine import dedup_by_key, drop_duplicates_any, drop_metadata

def test_one_row_of_each_id_remains(spark):
    data = [("k9", 0.5, "late"), ("k3", 2.0, "first"), ("k9", 0.25, "early"), ("k9", None, "none")]
    df = spark.createDataFrame(data, "id string, litres double, note string")
    assert rows(dedup_by_key(df, ["id"], ["note"])) == [("k3", 2.0, "first"), ("k9", 0.25, "early")]
    kept = rows(drop_duplicates_any(df, ["id"]))
    assert [r[0] for r in kept] == ["k3", "k9"] and set(kept) <= set(data)


def test_null_ids_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "id string, v int")
    assert rows(dedup_by_key(df, ["id"])) == [(None, 1), ("a", 3)]


def test_survivor_does_not_depend_on_row_order(spark):
    data = [(1, None, 5.0), (1, "x", 1.0), (1, "x", 0.5), (2, "y", 9.0), (2, "y", 8.0)]
    forward = spark.createDataFrame(data, "id int, a string, b double")
    backward = spark.createDataFrame(data[::-1], "id int, a string, b double").repartition(3)
    assert rows(dedup_by_key(forward, ["id"])) == rows(dedup_by_key(backward, ["id"]))
    assert rows(dedup_by_key(forward, ["id"], ["b"])) == [(1, "x", 0.5), (2, "y", 8.0)]


def test_only_key_columns(spark):
    assert dedup_by_key(spark.range(5).union(spark.range(3)), ["id"]).count() == 5


def test_rows_of_a_hot_key_are_cut_before_the_exchange(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v")
    plan = plan_of(dedup_by_key(df, ["k"]))
    lines = [line for line in plan.splitlines() if "Exchange" in line or "GroupLimit" in line]
    assert "Final" in lines[0] and "Exchange" in lines[1] and "Partial" in lines[2]


def test_unknown_key_is_an_error_before_any_job(spark):
    with pytest.raises(ValueError, match="nope"):
        dedup_by_key(spark.range(3), ["nope"])


def test_dropping_absent_columns_is_fine(spark):
    df = spark.range(1).selectExpr("id", "'x' as source_system")
    assert drop_metadata(df, s.METADATA).columns == ["id"]


SILVER = (
    "transaction_date date, product_name string, destination_city string, "
    "demand_quantity double, unit_price_usd double, available_inventory double"
)


def facts(spark, data, exact):
    df = spark.createDataFrame(data, "d string, " + SILVER.split(", ", 1)[1])
    df = df.selectExpr("cast(d as date) as transaction_date", *df.columns[1:])
    return daily_facts(df, [s.TIME, *s.SERIES], s.MEASURES, exact)


@pytest.mark.parametrize("exact", [False, True])
def test_null_is_a_group_and_measures_skip_null(spark, exact):
    data = [
        ("2026-01-01", "A", "X", 1.25, 10.0, 5.0),
        ("2026-01-01", "A", "X", None, 20.0, None),
        ("2026-01-01", None, "X", 3.0, None, 1.0),
        ("2026-01-01", None, "X", 4.0, None, 1.0),
    ]
    columns = ["product_name", s.TARGET, "avg_unit_price", "total_inventory", "transaction_count"]
    assert rows(facts(spark, data, exact), *columns) == [
        (None, 7.0, None, 2.0, 2),
        ("A", 1.25, 15.0, 5.0, 2),
    ]


@pytest.mark.parametrize("exact", [False, True])
def test_mean_price_is_unweighted(spark, exact):
    data = [
        ("2026-01-01", "A", "X", 99.0, 1.0, 0.0),
        ("2026-01-01", "A", "X", 1.0, 2.0, 0.0),
        ("2026-01-01", "A", "X", 1.0, 2.0, 0.0),
    ]
    assert facts(spark, data, exact).first()["avg_unit_price"] == 1.67


def test_exact_rounds_half_away_from_zero(spark):
    def mean(*prices):
        data = [("2026-01-01", "A", "X", 1.0, p, 0.0) for p in prices]
        return facts(spark, data, True).first()["avg_unit_price"]

    assert mean(1.0, 1.01) == 1.01
    assert mean(-1.0, -1.01) == -1.01
    assert mean(-1.0, -1.0, -1.01) == -1.0


def test_exact_sum_does_not_depend_on_partitioning(spark):
    df = spark.range(30000).selectExpr(
        "date'2026-01-01' as transaction_date", "'A' as product_name", "'X' as destination_city",
        "id % 97 / 100.0D as demand_quantity", "id % 89 / 100.0D as unit_price_usd",
        "0.1D as available_inventory",
    )
    results = {
        tuple(daily_facts(df.repartition(n), [s.TIME, *s.SERIES], s.MEASURES, True).first())
        for n in (1, 3, 7)
    }
    assert len(results) == 1
    assert results.pop()[5] == 3000.0


def test_facts_combine_before_the_exchange(spark):
    data = [("2026-01-01", "A", "X", 1.0, 1.0, 1.0)]
    plan = plan_of(facts(spark, data, False))
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("partial_sum")


def test_unknown_measure(spark):
    with pytest.raises(ValueError, match="median"):
        daily_facts(spark.range(1), ["id"], [("m", "median", "id")])
