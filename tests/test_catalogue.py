"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]
SPARK_TO_SQL = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((x is not None, str(x)) for x in row))


def test_only_the_learned_model_has_no_sql():
    assert set(driver.oracle_sql()) < set(driver.queries())
    assert set(driver.QUERIES) - set(driver.ORACLE) == {"tree_fit_score"}


def test_the_corpus_queries_come_together_or_not_at_all():
    added = set(driver.queries()) - set(driver.QUERIES)
    assert len(added) in (0, 14) and ("pipeline" in added) == bool(added)


@pytest.mark.parametrize("name", sorted(driver.ORACLE))
def test_query_equals_sql(spark, sql, name):
    got = driver.queries()[name](spark, SF_DIR)
    expected = sql.sql(driver.ORACLE[name])
    types = {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in got.schema}
    assert types == dict(zip(expected.columns, map(str, expected.types), strict=True))
    names = sorted(types)
    places = [expected.columns.index(n) for n in names]
    ours = [tuple(row[n] for n in names) for row in got.collect()]
    theirs = [tuple(row[i] for i in places) for row in expected.fetchall()]
    assert ordered(ours) == ordered(theirs)
    assert ours


def test_tree_predictions_are_means_of_training_labels(spark):
    got = driver.queries()["tree_fit_score"](spark, SF_DIR)
    low, high, nulls, n = got.selectExpr(
        "min(predicted_demand)", "max(predicted_demand)",
        "count_if(predicted_demand is null)", "count(*)",
    ).first()
    assert (nulls, n) == (0, 865)
    assert 0 < low < high


def test_entry(spark):
    df = driver.entry(spark)
    assert df.count() == 4323
    assert "primary_key" in df.columns
