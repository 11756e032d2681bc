import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from demandloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        4,
        {
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """All rows as tuples, sorted in Python with None first."""
    names = order or df.columns
    return sorted(
        (tuple(r[c] for c in names) for r in df.collect()),
        key=lambda t: tuple((x is not None, x) for x in t),
    )


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
