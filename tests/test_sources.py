import pytest
from conftest import plan_of, rows

from demandloom import session as session_module
from demandloom.operators.keyed import lookup_features
from demandloom.session import settings
from demandloom.sources.files import read_csv, stamp_ingestion, write_csv
from demandloom.sources.schemas import transactions_schema
from demandloom.sources.tables import (
    append_rows,
    read_or_empty,
    read_table,
    row_count,
    write_table,
)


def test_transactions_schema(spark):
    schema = transactions_schema()
    types = [f.dataType.simpleString() for f in schema]
    assert len(schema) == 33
    assert all(f.nullable for f in schema)
    assert (types.count("string"), types.count("date")) == (15, 1)
    assert (types.count("int"), types.count("double")) == (8, 9)
    assert schema.fieldNames()[0] == "transaction_id"
    assert schema.fieldNames()[-1] == "operation_type"


DIRTY = """wrong,names,here
a,2026-01-05,1.5
b,05/01/2026,2.5
c,2026-01-07,abc
d,2026-01-08
e,2026-01-09,4.5,extra
"""


def dirty_file(tmp_path):
    file = tmp_path / "dirty.csv"
    file.write_text(DIRTY)
    return str(file)


def test_csv_binds_by_position_and_nulls_bad_cells(spark, tmp_path):
    import datetime as dt

    schema = spark.createDataFrame([], "id string, day date, amount double").schema
    df = read_csv(spark, dirty_file(tmp_path), schema)
    assert rows(df) == [
        ("a", dt.date(2026, 1, 5), 1.5),
        ("b", None, 2.5),
        ("c", dt.date(2026, 1, 7), None),
        ("d", dt.date(2026, 1, 8), None),
        ("e", dt.date(2026, 1, 9), 4.5),
    ]


def test_csv_keeps_the_text_of_corrupt_rows(spark, tmp_path):
    schema = spark.createDataFrame([], "id string, day date, amount double").schema
    df = read_csv(spark, dirty_file(tmp_path), schema, corrupt_column="_bad")
    bad = {r["id"]: r["_bad"] for r in df.cache().collect()}
    assert bad["a"] is None
    assert bad["c"] == "c,2026-01-07,abc"
    assert "_bad" not in schema.fieldNames()


def test_ingestion_stamp_is_one_value(spark):
    stamped = stamp_ingestion(spark.range(100).repartition(4))
    assert stamped.select("ingested_at").distinct().count() == 1
    assert stamped.where("ingested_at is null").count() == 0


def test_overwrite_by_path_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    write_table(spark.range(10), path)
    again = write_table(spark.range(3).selectExpr("id as other"), path)
    assert rows(again) == [(0,), (1,), (2,)]
    assert again.columns == ["other"]
    assert row_count(again) == 3


def test_overwrite_by_name(spark):
    write_table(spark.range(10), "full_refresh")
    write_table(spark.range(4), "full_refresh")
    assert read_table(spark, "full_refresh").count() == 4


def test_partitioned_write_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20).selectExpr("id", "id % 4 as month")
    back = write_table(df, path, partition_by=["month"])
    assert back.where("month = 1").count() == 5
    assert "PartitionFilters: [isnotnull(month" in plan_of(back.where("month = 1"))


def test_tables_bucketed_on_the_key_join_without_exchange(spark):
    keys = spark.range(50).selectExpr("concat('k', id) as primary_key", "id * 2.0 as v")
    x = write_table(keys, "bucketed_x", bucket_by=["primary_key"], buckets=4)
    y = write_table(
        keys.selectExpr("primary_key", "v as total_demand"),
        "bucketed_y",
        bucket_by=["primary_key"],
        buckets=4,
    )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = lookup_features(y, x, "primary_key")
        plan = plan_of(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_bucketing_needs_a_name(spark, tmp_path):
    with pytest.raises(ValueError, match="catalog table name"):
        write_table(spark.range(1), str(tmp_path / "t"), bucket_by=["id"])


def test_log_table_is_empty_before_the_first_append(spark, tmp_path):
    path = str(tmp_path / "log")
    assert read_or_empty(spark, path, "id bigint").count() == 0
    append_rows(spark.range(2), path)
    append_rows(spark.range(3), path)
    assert read_or_empty(spark, path, "id bigint").count() == 5
    assert read_or_empty(spark, "never_written", "id bigint").count() == 0


def test_unreadable_log_is_not_taken_for_empty(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_or_empty(spark, str(tmp_path / "log"), "id bigint").collect()


def test_scratch_is_below_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session_module.scratch_path(spark, "x").startswith(configured)
    one, two = (session_module.scratch_path(spark, "x") for _ in range(2))
    assert one != two


def test_materialize_round_trip(spark):
    df = spark.range(7).selectExpr("id", "cast(null as string) as s")
    back = session_module.materialize(df, "round-trip")
    assert back.schema.fieldNames() == ["id", "s"]
    assert rows(back, "id") == [(i,) for i in range(7)]


class _Session:
    """As much of a session as ``shared_dir`` looks at, without spark.checkpoint.dir."""

    def __init__(self, master, current=None):
        self.master, self.current = master, current
        self.conf = self.sparkContext = self

    def get(self, key, default):
        return default

    def getCheckpointDir(self):
        return self.current

    def setCheckpointDir(self, path):
        self.current = path


def test_a_cluster_without_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session_module.shared_dir(_Session("yarn"))
    assert session_module.shared_dir(_Session("yarn", "hdfs:///c/")) == "hdfs:///c"
    assert session_module.shared_dir(_Session("local[2]")).split("/")[-1].startswith("demandloom-")


def test_feed_is_compressed_text_that_reads_back(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "concat('name of ', id) name", "if(id = 3, null, id / 4) x")
    path = tmp_path / "feed"
    write_csv(df, str(path))
    files = [f for f in path.iterdir() if f.name.startswith("part-")]
    assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert rows(read_csv(spark, str(path), df.schema)) == rows(df)


def test_feeds_of_the_queries_are_compressed(spark):
    from demandloom.catalogue import queries as q

    frame = q.QUERIES["csv_typed_scan"](spark, "/root/testdata/sf0.001")
    assert frame.count() > 0
    assert all(f.endswith(".csv.gz") for f in frame.inputFiles())


def test_settings_end_with_the_write(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64m")
    given = {"spark.sql.files.maxPartitionBytes": "1m", "demandloom.of.nobody": "x"}
    with pytest.raises(ZeroDivisionError), settings(spark, given):
        assert spark.conf.get("demandloom.of.nobody") == "x"
        1 / 0
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "64m"
    assert spark.conf.get("demandloom.of.nobody", None) is None
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
