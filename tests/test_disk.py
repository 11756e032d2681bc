"""What a refresh and the feeds of the queries leave on disk, and what they exchange."""

import glob
import random
import time

import pytest
from conftest import plan_of, rows
from test_daily import line, write

from demandloom import settings as s
from demandloom.catalogue import inputs
from demandloom.catalogue.queries import QUERIES
from demandloom.operators import refine
from demandloom.operators.chrono import ChronoSplit, write_profiled
from demandloom.plans import refresh as module
from demandloom.plans.refresh import refresh
from demandloom.session import materialize, settings, shared_dir
from demandloom.sources.files import write_csv
from demandloom.sources.snapshots import Snapshots
from demandloom.sources.tables import read_table

THRESHOLD = "spark.sql.autoBroadcastJoinThreshold"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("tables")
    given = {
        "nation": ["(0, 'N0', 0)", "(1, 'N1', 0)", "(1, 'again', 0)"],
        "customer": [f"({i}, 'c', {i % 3}, 1.0, 'S{i % 2}')" for i in range(6)],
        "supplier": [f"({i}, 's{i}', {i % 2}, {i}.5)" for i in range(4)] + ["(null, 's', 0, 1.0)"],
        "part": [f"({i}, 'p', 'B{i % 2}', 'T', {i}, 9.5)" for i in range(5)],
        "orders": [f"({i}, {i % 7}, 'O', 1.0, '1995-01-{1 + i % 9:02d}', 'P')" for i in range(40)],
        "lineitem": [
            f"({i % 45}, {i % 6}, {i % 5}, {i % 3}, {i}.0, 1.0, 0.0, 0.0, 'R', 'F', '1995-02-01')" for i in range(200)
        ],
    }
    for name, values in given.items():
        columns = inputs.TABLES[name].split(", ")
        cast = ", ".join(f"cast(col{i} as {c.split()[1]}) {c.split()[0]}" for i, c in enumerate(columns, 1))
        spark.sql(f"select {cast} from values {', '.join(values)}").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_feed_exchanges_no_lines_for_tables_that_fit_a_broadcast(spark, tables):
    """Each table is below the limit, the product of two of them is not."""
    with settings(spark, {THRESHOLD: "20000"}):
        plan = plan_of(inputs.bronze_wide(spark, tables))
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(l_partkey" not in plan


def test_feed_rows_are_those_of_any_order_of_joins(spark, tables):
    for name in inputs.TABLES:
        if name not in ("region", "events"):
            inputs.table(spark, tables, name).createOrReplaceTempView(f"disk_{name}")
    wanted = spark.sql("""
        select concat_ws('-', l_orderkey, l_linenumber) transaction_id, n.n_name destination_city,
               m.n_name supplier_country, s_name supplier_name, p_brand product_name, c_mktsegment refinery_name
        from disk_nation n, disk_nation m, disk_customer, disk_supplier, disk_part, disk_orders, disk_lineitem
        where l_orderkey = o_orderkey and o_custkey = c_custkey and c_nationkey = n.n_nationkey
          and l_partkey = p_partkey and l_suppkey = s_suppkey and s_nationkey = m.n_nationkey
    """)
    for threshold in ("-1", "20000"):
        with settings(spark, {THRESHOLD: threshold}):
            got = inputs.bronze_wide(spark, tables).select(*wanted.columns)
            assert rows(got) == rows(wanted) and wanted.count() > 100


def test_feed_has_orders_joined_last_of_what_is_exchanged(spark, tables):
    with settings(spark, {THRESHOLD: "-1"}):
        plan = plan_of(inputs.bronze_wide(spark, tables)).splitlines()
    depth = {
        key: min(x.index("Exchange") for x in plan if f"Exchange hashpartitioning({key}#" in x)
        for key in ("l_partkey", "l_orderkey")
    }
    assert depth["l_orderkey"] < depth["l_partkey"]


def exchanged_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in str(manager.getAllFiles().mkString("\n")).splitlines() if "/shuffle_" in f}


def test_exchanged_files_go_with_the_write(spark, tmp_path):
    def spread():
        return spark.range(1000).repartition(3, "id")

    split = ChronoSplit(("id",), ("bigint",), (0, 0, 1000), None, None)
    writes = {
        "text": lambda: write_csv(spread(), str(tmp_path / "text")),
        "draft": lambda: Snapshots(spark, str(tmp_path / "root")).draft().write("t", spread()),
        "scratch": lambda: materialize(spread(), "spread"),
        "training set": lambda: write_profiled(spread(), split, ["id"], str(tmp_path / "rows")),
    }
    for name, run in writes.items():
        before = exchanged_files(spark)
        run()
        until = time.time() + 20
        while (left := exchanged_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        assert not left, name


def repeated(spark, folder, files=3):
    """Keys that come once, in one file or in several; NULL keys; equal rows; some keys very often."""
    draw = random.Random(3)
    made = [(f"k{i}", draw.randrange(5), None) for i in range(9000)]
    made += [(f"k{i % 40}", draw.randrange(3), draw.choice([None, 1.5, 2.5])) for i in range(900)]
    made += [(None, draw.randrange(4), 1.0) for _ in range(30)] + [("hot", i % 7, None) for i in range(300)]
    draw.shuffle(made)
    df = spark.createDataFrame(made, "k string, a int, b double")
    df.repartition(files).write.option("maxRecordsPerFile", 4200).parquet(folder)
    return spark.read.parquet(folder)


def test_rows_of_keys_that_come_once_are_told(spark, tmp_path, monkeypatch):
    table = repeated(spark, str(tmp_path / "t"))
    alone, again = refine.split_repeated(table, ["k"])
    assert alone.columns == again.columns == table.columns
    assert rows(alone.unionByName(again)) == rows(table)
    assert again.count() == 40 + 900 + 30 + 300
    assert alone.join(again, alone.k.eqNullSafe(again.k)).count() == 0
    for key, order in ((["k"], None), (["k"], ["a", "b"]), (["a", "k"], None)):
        alone, again = refine.split_repeated(table, key)
        whole = alone.unionByName(refine.dedup_by_key(again, key, order))
        assert rows(whole) == rows(refine.dedup_by_key(table, key, order))
    none = spark.read.schema(table.schema).parquet(str(tmp_path / "t")).where("a > 10")
    assert [part.count() for part in refine.split_repeated(none, ["k"])] == [0, 0]
    monkeypatch.setattr(refine, "TOLD_ROWS", 100)
    assert [part.count() for part in refine.split_repeated(table, ["k"])] == [0, table.count()]


def test_refresh_exchanges_repeated_transactions_only(spark, tmp_path, monkeypatch):
    lines = [line(i, i % 9, "A", "Rome", i) for i in range(200)]
    again = [line(i, i % 9, "A", "Rome", i + 0.5) for i in range(5)]
    met, by_key = [], refine.dedup_by_key
    monkeypatch.setattr(module, "dedup_by_key", lambda df, *rest: met.append(df.count()) or by_key(df, *rest))
    tables = s.Tables.under(str(tmp_path / "tables"))
    counts = refresh(spark, write(tmp_path / "feed.csv", [*lines, *again]), tables, exact=True)
    assert (counts["bronze"], counts["silver"], met) == (205, 200, [10])
    kept, bronze = read_table(spark, tables.silver), read_table(spark, tables.bronze)
    assert rows(kept.select(bronze.columns[:6])) == rows(module.silver(bronze).select(bronze.columns[:6]))
    assert kept.where("demand_quantity % 1 > 0").count() == 0 and set(kept.columns) < set(bronze.columns)


@pytest.mark.parametrize("name", ["refresh_features", "refresh_daily", "lifecycle_round"])
def test_feed_goes_when_it_is_refreshed(spark, tables, name):
    def feeds():
        return {f for f in glob.glob(f"{shared_dir(spark)}/**/*.csv.gz", recursive=True)}

    before = feeds()
    got = QUERIES[name](spark, tables)
    assert not feeds() - before and got.count() > 0
