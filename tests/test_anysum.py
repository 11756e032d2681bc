"""Sums of any doubles: equal bits however rows are dealt, and the nearest double."""

import math
import random
import struct

import pytest

from demandloom.operators.anysum import exact_sums
from demandloom.operators.evaluate import model_metrics, regression_metrics
from demandloom.operators.facts import daily_facts


def bits(value):
    return None if value is None else struct.pack(">d", value)


def values_of(kind, n=700, seed=1):
    draw = random.Random(f"{kind}{seed}")
    make = {
        "mixed": lambda: draw.choice([-1, 1]) * draw.random() * 2.0 ** draw.randrange(-900, 900),
        "near": lambda: draw.choice([-1, 1]) * draw.random() * 10.0 ** draw.randrange(-3, 6),
        "cancel": lambda: draw.choice([1e16, -1e16, 1.0, 2.0**-40, 0.1]),
        "tiny": lambda: draw.choice([-1, 1]) * draw.randrange(1 << 20) * 5e-324,
        "powers": lambda: draw.choice([-1, 1]) * 2.0 ** draw.randrange(-1074, 1000),
        "two decimals": lambda: draw.randrange(100_000) / 100,
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["mixed", "near", "cancel", "tiny", "powers", "two decimals"])
def test_nearest_double_over_any_partitions(spark, kind):
    values = values_of(kind)
    groups = [(k % 3, v) for k, v in enumerate(values)]
    want = {k: math.fsum(v for g, v in groups if g == k) for k in range(3)}
    frame = spark.createDataFrame(groups, "k int, v double")
    for parts in (1, 7, 50):
        random.Random(parts).shuffle(groups)
        dealt = spark.createDataFrame(groups, frame.schema).repartition(parts)
        found = {r["k"]: r["s"] for r in exact_sums(dealt, ["k"], {"s": "v"}).collect()}
        assert {k: bits(v) for k, v in found.items()} == {k: bits(v) for k, v in want.items()}


def test_halfway_cases_round_to_even(spark):
    one = 2.0**53
    for values in ([one, 1.0], [one + 2, 1.0], [one, 1.0, 2.0**-1074], [-one, -1.0], [one + 2, 1.0, -(2.0**-60)]):
        frame = spark.createDataFrame([(v,) for v in values], "v double")
        assert exact_sums(frame, [], {"s": "v"}).first()["s"] == math.fsum(values)


def test_odd_values_nulls_and_keys(spark):
    nan, inf, big = float("nan"), float("inf"), 1.7976931348623157e308
    rows = [
        ("null", None), ("nan", nan), ("nan", 1.0), ("up", inf), ("up", 3.0), ("down", -inf),
        ("both", inf), ("both", -inf), ("zero", 0.0), ("zero", -0.0), ("over", big), ("over", big),
        ("back", big), ("back", big), ("back", -big), ("some", None), ("some", 2.5), (None, 4.0),
        ("least", 5e-324), ("least", 5e-324),
    ]
    frame = spark.createDataFrame(rows, "k string, v double")
    found = exact_sums(frame, ["k"], {"s": "v"}, {"s": "n"}, "rows")
    got = {r["k"]: (r["s"], r["n"], r["rows"]) for r in found.collect()}
    assert math.isnan(got.pop("nan")[0]) and math.isnan(got.pop("both")[0])
    assert got == {
        "null": (None, 0, 1), "up": (inf, 2, 2), "down": (-inf, 1, 1), "zero": (0.0, 2, 2),
        "over": (inf, 2, 2), "back": (big, 3, 3), "some": (2.5, 1, 2), None: (4.0, 1, 1),
        "least": (1e-323, 2, 2),
    }
    empty = frame.limit(0)
    assert exact_sums(empty, ["k"], {"s": "v"}).count() == 0
    assert exact_sums(empty, [], {"s": "v"}, {"s": "n"}, "rows").first().asDict() == {"s": None, "n": 0, "rows": 0}


def test_facts_of_doubles(spark):
    values = [(k % 2, v, None if k % 5 == 0 else v / 3) for k, v in enumerate(values_of("near"))]
    measures = [("total", "sum", "v"), ("mean", "mean", "w"), ("n", "count", None)]
    frame = spark.createDataFrame(values, "k int, v double, w double")
    one, other = (
        {r["k"]: tuple(r) for r in daily_facts(frame.repartition(n), ["k"], measures, "doubles").collect()}
        for n in (1, 30)
    )
    assert one == other
    for k, (_, total, mean, n) in one.items():
        mine = [(v, w) for g, v, w in values if g == k]
        known = [w for _, w in mine if w is not None]
        assert n == len(mine) and total == pytest.approx(math.fsum(v for v, _ in mine), abs=0.006)
        assert mean == pytest.approx(math.fsum(known) / len(known), abs=0.006)
    with pytest.raises(ValueError, match="unknown"):
        daily_facts(frame, ["k"], [("x", "median", "v")], "doubles")


def test_metrics_of_doubles(spark):
    draw = random.Random(3)
    rows = [(f"s{k % 2}", draw.gauss(1e6, 3), draw.gauss(1e6, 3), draw.random()) for k in range(400)]
    rows += [("s0", float("nan"), 1.0, 1.0), ("s1", None, 1.0, 1.0), (None, 2.0, 3.0, 4.0)]
    rows += [("c", 5.0, 5.0, 1.0), ("c", 5.0, 5.0, 2.0)]
    frame = spark.createDataFrame(rows, "split string, y double, p double, q double")
    models = {"one": "p", "other": "q"}

    def scores(parts, exact):
        found = model_metrics(frame.repartition(parts), "y", models, ["split"], exact)
        return {(r["split"], r["model"]): (r["n_rows"], r["mae"], r["rmse"], r["r2"]) for r in found.collect()}

    exact = scores(1, "doubles")
    assert exact == scores(25, "doubles")
    plain = scores(3, False)
    assert set(exact) == set(plain)
    for key, (n, *values) in exact.items():
        assert n == plain[key][0]
        for one, other in zip(values, plain[key][1:], strict=True):
            assert one == other or one == pytest.approx(other, rel=1e-9)
    assert exact["c", "one"][3] == 1.0 and exact["c", "other"][3] == 0.0 and exact[None, "one"][3] is None
    alone = regression_metrics(frame, "y", "p", exact="doubles").first()
    assert alone["n_rows"] == 403
