import pytest
from conftest import plan_of, rows

from demandloom.operators import lifecycle as lc

METRIC = "validation_r2"
NAN, INF = float("nan"), float("inf")


def runs(spark, *data):
    df = spark.createDataFrame(
        list(data),
        "run_id string, run_name string, status string, validation_r2 double, day string",
    )
    return df.selectExpr("*", "cast(day as timestamp) as started_at").drop("day")


def test_best_run_ignores_unfinished_and_other_names(spark):
    df = runs(
        spark,
        ("a", "x", "FINISHED", 0.5, "2026-01-01"),
        ("b", "x", "RUNNING", 0.9, "2026-01-01"),
        ("c", "y", "FINISHED", 0.8, "2026-01-01"),
        ("d", "x", "FINISHED", None, "2026-01-09"),
        ("e", "x", "FINISHED", NAN, "2026-01-09"),
        ("f", "x", "FINISHED", INF, "2026-01-09"),
    )
    assert lc.best_run(df, METRIC, "x").first()["run_id"] == "a"
    assert lc.best_run(df, METRIC).first()["run_id"] == "c"
    assert "TakeOrderedAndProject" in plan_of(lc.best_run(df, METRIC, "x"))


def test_tie_goes_to_the_latest_start_and_null_is_last(spark):
    df = runs(
        spark,
        ("a", "x", "FINISHED", 0.5, "2026-01-01"),
        ("b", "x", "FINISHED", 0.5, "2026-01-02"),
        ("c", "x", "FINISHED", None, "2026-01-03"),
    )
    assert lc.best_run(df, METRIC, "x").first()["run_id"] == "b"


def test_no_run_is_an_error(spark):
    df = runs(spark, ("a", "x", "FAILED", 0.5, "2026-01-01"))
    with pytest.raises(ValueError, match="nothing finished"):
        lc.require_row(lc.best_run(df, METRIC, "x"), "nothing finished")


def test_gate_is_strict(spark):
    odd = spark.createDataFrame([(NAN,), (INF,), (-INF,)], "r2 double")
    assert not any(r["passed"] for r in lc.quality_gate(odd, "r2", float("-inf")).collect())
    df = spark.createDataFrame([(0.8,), (0.9,), (0.91,), (None,)], "r2 double")
    got = rows(lc.quality_gate(df, "r2", 0.9), "r2", "threshold", "passed")
    assert got == [
        (None, 0.9, False),
        (0.8, 0.9, False),
        (0.9, 0.9, False),
        (0.91, 0.9, True),
    ]


def test_versions_go_on_from_the_last(spark):
    accepted = spark.createDataFrame(
        [("m", "r2"), ("m", "r1"), ("other", "r9")], "model_name string, run_id string"
    )
    versions = spark.createDataFrame([("m", 3), ("m", 7)], "model_name string, version bigint")
    got = rows(lc.next_versions(accepted, versions), "model_name", "run_id", "version")
    assert got == [("m", "r1", 8), ("m", "r2", 9), ("other", "r9", 1)]


def test_newest_assignment_holds_the_alias(spark):
    log = spark.createDataFrame(
        [("m", "Champion", 1, 10), ("m", "Champion", 2, 20), ("m", "Champion", 1, 30)]
        + [("m", "Challenger", 5, 5), ("n", "Champion", 9, 1)],
        "model_name string, alias string, version bigint, assigned_at int",
    )
    got = rows(lc.current_aliases(log), "model_name", "alias", "version")
    assert got == [("m", "Challenger", 5), ("m", "Champion", 1), ("n", "Champion", 9)]


@pytest.mark.parametrize(
    "scores, status, passed",
    [
        ([("Challenger", -3.0)], "promoted", True),
        ([("Champion", 0.8), ("Challenger", 0.7)], "kept", False),
        ([("Champion", 0.8), ("Challenger", 0.8)], "kept", False),
        ([("Champion", 0.8), ("Challenger", 0.9)], "promoted", True),
        ([("Champion", 0.8)], "no_challenger", False),
        ([("Champion", None), ("Challenger", 0.9)], "kept", False),
        ([("Champion", 0.8), ("Challenger", None)], "kept", False),
        ([("Champion", 0.8), ("Challenger", NAN)], "kept", False),
        ([("Champion", 0.8), ("Challenger", INF)], "kept", False),
        ([("Champion", NAN), ("Challenger", 0.9)], "kept", False),
        ([("Challenger", NAN)], "kept", False),
        ([("Challenger", None)], "kept", False),
        ([], "no_challenger", False),
    ],
)
def test_promotion(spark, scores, status, passed):
    df = spark.createDataFrame(scores, "role string, r2 double")
    row = lc.promotion_decision(df).first()
    assert (row["status"], row["metric_r2_passed"]) == (status, passed)
