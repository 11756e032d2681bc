"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Queries over the learned tree fit it eagerly, and plans that read a layer more
than once write it first; everything else is one lazy plan.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from demandloom import settings as s
from demandloom.catalogue import inputs as i
from demandloom.operators import chrono, encode, evaluate, keyed, lifecycle, panel, trees
from demandloom.functions.exact import finite
from demandloom.operators.publish import prediction_table as publish
from demandloom.operators.refine import dedup_by_key as dedup
from demandloom.operators.refine import drop_metadata as without_metadata
from demandloom.operators.anysum import exact_sums
from demandloom.plans.daily import refresh_daily as daily_refresh
from demandloom.plans.dataset import ORDER, Dataset, build_dataset, split_dataset
from demandloom.plans.modelbook import ModelBook
from demandloom.plans.refresh import gold, gold_features, refresh
from demandloom.plans.select import select
from demandloom.plans.serve import serve
from demandloom.plans.train import train
from demandloom.session import materialize, prepare, scratch_path, settings
from demandloom.sources.files import read_csv, stamp_ingestion, write_csv
from demandloom.sources.schemas import transactions_schema
from demandloom.sources.snapshots import Snapshots
from demandloom.sources.tables import make_folder, read_table, read_tables, remove_path, write_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Forecasters that need no fit: their predictions are feature columns.
NAIVE = {"last_value": "demand_1", "seventh_last": "demand_7", "rolling_mean": s.ROLLING}
GATES = (-2.0, -0.5, 0.9)
GRAIN = [s.TIME, *s.SERIES]


def query(run: Query) -> Query:
    @wraps(run)
    def prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(prepare(spark), sf_dir)

    QUERIES[run.__name__] = prepared
    return prepared


# Ingest


@query
def csv_typed_scan(spark, sf_dir):
    path = scratch_path(spark, "feed")
    write_csv(i.bronze_wide(spark, sf_dir), path)
    return read_csv(spark, path, transactions_schema())


@query
def csv_permissive_nulls(spark, sf_dir):
    """A feed with wrong header names, unparsable cells, short rows and long rows."""
    line = F.col("l_linenumber")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    cells = [
        i.transaction_id(),
        F.when(line == 1, F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise(day),
        F.when(line == 5, F.lit("12.5")).otherwise(F.year("l_shipdate").cast("string")),
        F.col("l_returnflag"),
        F.when(line == 2, F.lit("abc")).otherwise(F.col("l_quantity").cast("string")),
    ]
    text = (
        F.when(line == 3, F.concat_ws(",", *cells[:2]))
        .when(line == 4, F.concat_ws(",", *cells, F.lit("extra"), F.lit("cells")))
        .otherwise(F.concat_ws(",", *cells))
    )
    path = scratch_path(spark, "dirty-feed")
    (
        i.table(spark, sf_dir, "lineitem")
        .select(text.alias("a,b,c,d,e"))
        .write.option("header", True)
        .option("sep", "\u0001")
        .csv(path)
    )
    schema = (
        "transaction_id string, transaction_date date, transaction_year int, "
        "product_name string, demand_quantity double"
    )
    return read_csv(spark, path, StructType.fromDDL(schema))


@query
def ingest_stamp(spark, sf_dir):
    stamped = stamp_ingestion(i.bronze_slim(spark, sf_dir))
    return stamped.groupBy(s.TIME).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ingested_at").alias("n_stamped"),
        (F.min("ingested_at") == F.max("ingested_at")).alias("one_stamp"),
    )


def _refreshed(spark, sf_dir, lean: bool) -> DataFrame:
    """The feature table that a refresh writes from a CSV feed, with the label."""
    root = scratch_path(spark, "refresh")
    write_csv(i.bronze_wide(spark, sf_dir), f"{root}/feed")
    tables = s.Tables.under(root)
    refresh(spark, f"{root}/feed", tables, lean=lean, exact=True)
    remove_path(spark, f"{root}/feed")
    labels, features = (read_table(spark, t) for t in (tables.labels, tables.features))
    return keyed.lookup_features(labels, features, s.KEY)


@query
def refresh_features(spark, sf_dir):
    return _refreshed(spark, sf_dir, lean=False)


@query
def refresh_features_lean(spark, sf_dir):
    return _refreshed(spark, sf_dir, lean=True)


@query
def refresh_daily(spark, sf_dir):
    """Features after four daily refreshes: the first days, half a year without the rows that
    come late, more days with those, and the rest with rows that were sent before."""
    root = scratch_path(spark, "daily")
    feed = i.bronze_wide(spark, sf_dir)
    day = F.col("transaction_date")
    cuts = [F.lit(c).cast("date") for c in ("1998-01-01", "1998-07-01", "2000-01-01")]
    drawn = F.pmod(F.xxhash64(*feed.columns), F.lit(10))
    late = (day >= F.date_sub(cuts[1], 40)) & (day < cuts[1]) & (drawn == 0)
    again = (day >= F.date_sub(cuts[2], 30)) & (day < cuts[2]) & (drawn == 1)
    feeds = [
        day < cuts[0],
        (day >= cuts[0]) & (day < cuts[1]) & ~late,
        ((day >= cuts[1]) & (day < cuts[2])) | late,
        (day >= cuts[2]) | again,
    ]
    # All feeds by one pass over the joins: a row is written to each feed that has it.
    of = F.array_compact(F.array(*[F.when(rows, F.lit(n)) for n, rows in enumerate(feeds)]))
    sent = feed.withColumn("feed", F.explode(of))
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(len(feeds))}):
        write_csv(sent, f"{root}/feeds", ["feed"])
    tables = s.Tables.under(f"{root}/tables")
    for number in range(len(feeds)):
        path = f"{root}/feeds/feed={number}"
        make_folder(spark, path)
        daily_refresh(spark, path, tables, exact=True)
        remove_path(spark, path)
    labels, features = read_tables(spark, [tables.labels, tables.features])
    return keyed.lookup_features(labels, features, s.KEY)


@query
def feature_table_properties(spark, sf_dir):
    """Key, description and tags of a feature table in the catalog, and the rows it has."""
    root = scratch_path(spark, "catalog")
    write_csv(i.bronze_wide(spark, sf_dir), f"{root}/feed")
    database = f"features_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{root}/database'")
    tables = s.Tables.in_database(database)
    tags = {"owner": "planning", "layer": "features"}
    try:
        refresh(spark, f"{root}/feed", tables, lean=True, exact=True, tags=tags, description="Daily demand")
        found = spark.sql(f"SHOW TBLPROPERTIES {tables.features}").collect()
        rows = [(r["key"], r["value"]) for r in found if r["key"] == "primary_key" or r["key"].startswith("tag.")]
        rows.append(("comment", spark.catalog.getTable(tables.features).description))
        rows.append(("rows", str(read_table(spark, tables.features).count())))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
    return spark.createDataFrame(rows, "property string, value string")


# Clean


@query
def drop_metadata(spark, sf_dir):
    return without_metadata(i.bronze_wide(spark, sf_dir), [*s.METADATA, "not_a_column"])


@query
def dedup_by_key(spark, sf_dir):
    lines = i.table(spark, sf_dir, "lineitem").select(
        i.transaction_id().alias("transaction_id"),
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("l_shipdate"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )
    return dedup(lines, ["transaction_id"])


@query
def layer_row_counts(spark, sf_dir):
    """Each layer written from the one before, and its rows counted by that write."""
    draft = Snapshots(spark, scratch_path(spark, "layers")).draft()
    bronze = draft.write("bronze", i.bronze_slim(spark, sf_dir))
    silver = draft.write("silver", dedup(bronze, [s.SOURCE_KEY]))
    facts = draft.write("gold", gold(silver, exact=True))
    draft.write("gold_features", gold_features(facts, exact=True))
    return spark.createDataFrame(list(draft.rows().items()), "layer string, n_rows bigint")


# Facts and features


@query
def gold_fact(spark, sf_dir):
    return i.gold_slim(spark, sf_dir)


@query
def lag_features(spark, sf_dir):
    facts = i.gold_slim(spark, sf_dir).select(*GRAIN, s.TARGET)
    return panel.series_features(facts, s.TARGET, s.SERIES, [s.TIME], s.LAGS)


@query
def rolling_mean(spark, sf_dir):
    facts = i.gold_slim(spark, sf_dir).select(*GRAIN, s.TARGET)
    return panel.series_features(
        facts, s.TARGET, s.SERIES, [s.TIME], None, s.ROLLING, s.ROLLING_ROWS, exact=True
    )


@query
def hot_series_features(spark, sf_dir):
    """Lags and trailing mean over raw events, where one event type is a large part of all rows."""
    events = i.table(spark, sf_dir, "events").select("event_id", "event_type", "ts", "value")
    featured = panel.hot_series_features(
        events,
        "value",
        ["event_type"],
        ["ts", "event_id"],
        {1: "value_1", 7: "value_7"},
        "rolling_value",
        7,
        exact=True,
    )
    return featured.select("event_id", "event_type", "value_1", "value_7", "rolling_value")


@query
def default_rounding(spark, sf_dir):
    """How often the default double arithmetic is off the exact one, per measure.

    Sums, means and trailing means by more than a hundredth, metrics by more than a
    billionth of their value.
    """
    silver = materialize(i.silver_slim(spark, sf_dir), "silver")
    measures = [name for name, kind, _ in s.MEASURES if kind != "count"]

    def facts(exact: bool) -> DataFrame:
        return gold_features(gold(silver, exact), exact).select(*GRAIN, *measures, s.ROLLING)

    names = [*measures, s.ROLLING]
    default = facts(False).select(*GRAIN, *[F.col(n).alias(f"default_{n}") for n in names])
    both = default.join(facts(True), GRAIN)

    def off(name: str, most) -> F.Column:
        apart = F.abs(F.col(f"default_{name}") - F.col(name)) > most
        one_missing = F.col(f"default_{name}").isNull() != F.col(name).isNull()
        return F.sum(F.coalesce(apart, one_missing).cast("bigint")).alias(name)

    counted = both.agg(
        F.count(F.lit(1)).alias("n_rows"), *[off(n, F.lit(0.01 + 1e-9)) for n in names]
    )
    data = _naive_dataset(spark, sf_dir)
    scores = ["mae", "rmse", "r2"]
    plain = _naive_metrics(data, exact=False)
    plain = plain.select("model", "split", *[F.col(n).alias(f"default_{n}") for n in scores])
    compared = plain.join(_naive_metrics(data), ["model", "split"])
    metrics = compared.agg(
        F.count(F.lit(1)).alias("n_rows"), *[off(n, F.abs(F.col(n)) * 1e-9) for n in scores]
    )
    listed = [
        df.select("n_rows", F.expr(f"stack({len(of)}, {stacked}) as (measure, n_off)"))
        for df, of in ((counted, names), (metrics, scores))
        for stacked in [", ".join(f"'{n}', {n}" for n in of)]
    ]
    return reduce(DataFrame.unionByName, listed)


@query
def calendar_features(spark, sf_dir):
    facts = i.gold_slim(spark, sf_dir).select(*GRAIN)
    return panel.with_calendar(facts, s.TIME)


@query
def fill_cold_start(spark, sf_dir):
    featured = i.features_slim(spark, sf_dir).select(*GRAIN, *s.COLD_START)
    return keyed.fill_cold_start(featured, s.COLD_START)


@query
def composite_key(spark, sf_dir):
    facts = i.gold_slim(spark, sf_dir).select(*GRAIN)
    return keyed.with_key(facts, s.KEY, s.TIME, s.SERIES)


@query
def feature_table(spark, sf_dir):
    return keyed.split_xy(i.keyed_slim(spark, sf_dir), s.FEATURES, s.LABELS)[0]


@query
def label_table(spark, sf_dir):
    return keyed.split_xy(i.keyed_slim(spark, sf_dir), s.FEATURES, s.LABELS)[1]


@query
def key_audit(spark, sf_dir):
    """The raw transaction id, which repeats, and the feature key, which must not."""
    raw = i.table(spark, sf_dir, "lineitem").select(i.transaction_id().alias("transaction_id"))
    feature_keys = keyed.with_key(i.gold_slim(spark, sf_dir), s.KEY, s.TIME, s.SERIES)
    audits = [
        keyed.key_audit(raw, ["transaction_id"]).withColumn("audited", F.lit("transaction_id")),
        keyed.key_audit(feature_keys, [s.KEY]).withColumn("audited", F.lit(s.KEY)),
    ]
    return reduce(DataFrame.unionByName, audits)


@query
def composite_key_audit(spark, sf_dir):
    """The feature key, and one over customer names and order priorities, which hold hyphens."""
    facts = i.gold_slim(spark, sf_dir).select(*GRAIN)
    orders = i.orders_with_place(spark, sf_dir).select(
        F.to_date("o_orderdate").alias(s.TIME),
        F.when(F.col("c_custkey") % 3 > 0, F.col("o_orderpriority")).alias("priority"),
        F.when(F.col("c_custkey") % 5 > 0, F.concat_ws("-", "o_orderstatus", "n_name")).alias("place"),
    )
    parts = ["priority", "place"]
    audits = [
        keyed.composite_key_audit(facts, s.KEY, s.TIME, s.SERIES).withColumn("audited", F.lit("facts")),
        keyed.composite_key_audit(orders.distinct(), s.KEY, s.TIME, parts).withColumn("audited", F.lit("orders")),
    ]
    return reduce(DataFrame.unionByName, audits)


@query
def exact_double_sums(spark, sf_dir):
    """Sums of doubles of very different size and both signs, as if added without rounding."""
    lines = i.table(spark, sf_dir, "lineitem")
    sign = F.when(F.col("l_linestatus") == "F", -1.0).otherwise(1.0)
    mixed = F.col("l_extendedprice") * sign * F.pow(F.lit(2.0), F.col("l_linenumber") * 3)
    return exact_sums(
        lines,
        ["l_returnflag"],
        {"sum_mixed": mixed, "sum_price": "l_extendedprice"},
        {"sum_price": "n_prices"},
        "n_rows",
    )


# Training set


def _looked_up(spark, sf_dir) -> DataFrame:
    x, y = keyed.split_xy(i.written_keyed(spark, sf_dir), s.FEATURES, s.LABELS)
    return keyed.lookup_features(y, x, s.KEY)


@query
def training_set_join(spark, sf_dir):
    return _looked_up(spark, sf_dir)


@query
def training_frame(spark, sf_dir):
    return keyed.training_frame(_looked_up(spark, sf_dir), s.TIME, s.KEY)


def _dataset(spark, sf_dir, product="p_brand", place="n_name", columns=None) -> Dataset:
    columns = [*ORDER, *columns] if columns is not None else None
    return split_dataset(i.written_keyed(spark, sf_dir, product, place, columns))


@query
def chrono_rank(spark, sf_dir):
    rows = i.keyed_slim(spark, sf_dir).select(*ORDER)
    return chrono.chrono_rank(rows, ORDER).select(s.KEY, s.TIME, "rn")


@query
def chrono_split(spark, sf_dir):
    data = _dataset(spark, sf_dir, columns=[])
    return data.split.label(data.rows).select(s.KEY, s.TIME, "split")


@query
def split_sizes(spark, sf_dir):
    data = _dataset(spark, sf_dir, columns=[])
    return data.split.label(data.rows).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def null_profile(spark, sf_dir):
    """Before the cold start is filled, so that there are NULLs, which the write counts."""
    unfilled = keyed.with_key(i.features_slim(spark, sf_dir), s.KEY, s.TIME, s.SERIES)
    profiled = [s.TARGET, *s.COLD_START]
    features = materialize(unfilled.select(*ORDER, *profiled), "unfilled")
    split = split_dataset(features).split
    path = scratch_path(spark, "training-set")
    return chrono.write_profiled(features, split, profiled, path)[1]


# Encoding


@query
def category_vocab(spark, sf_dir):
    return encode.category_vocab(
        _dataset(spark, sf_dir, columns=[]).part("train"), s.CATEGORICAL
    )


@query
def one_hot_wide(spark, sf_dir):
    data = _dataset(spark, sf_dir, "p_type", "r_name")
    vocabulary = encode.fit_vocabulary(data.part("train"), s.CATEGORICAL)
    wide = encode.one_hot_wide(data.rows, vocabulary)
    return wide.select(s.KEY, *s.NUMERIC, *encode.one_hot_names(vocabulary))


@query
def one_hot_unseen(spark, sf_dir):
    """Vocabulary from the Asian orders, applied to all: other nations encode to zeros."""
    asian = i.orders_with_place(spark, sf_dir, "r_name").where("r_name = 'ASIA'")
    vocabulary = encode.fit_vocabulary(asian, ["n_name", "o_orderpriority"])
    everything = (
        i.orders_with_place(spark, sf_dir)
        .groupBy("n_name", "o_orderpriority")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    encoder = encode.fit_encoder(everything, vocabulary, [])
    return encode.encoded_slots(encoder, everything, list(vocabulary))


@query
def one_hot_sparse(spark, sf_dir):
    """Customers and priorities as sparse vectors; customers of finished orders are known."""
    orders = i.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_orderpriority")
    encoded = ["o_custkey", "o_orderpriority"]
    encoder = encode.fit_sparse_encoder(orders.where("o_orderstatus = 'F'"), encoded)
    columns = [F.col("o_orderkey")]
    for c in encoded:
        # As text a sparse vector is (size,[slots],[values]).
        text = F.col(f"{c}_onehot").cast("string")
        for k, name in enumerate(("size", "slot", "value")):
            part = F.regexp_extract(text, r"^\((\d+),\[(.*)\],\[(.*)\]\)$", k + 1)
            part = F.when(part != "", part)
            columns.append(part.cast("double" if name == "value" else "int").alias(f"{c}_{name}"))
    return encoder.transform(orders).select(*columns)


# Metrics and lifecycle


def _naive_dataset(spark, sf_dir) -> Dataset:
    return _dataset(spark, sf_dir, columns=[s.TARGET, *NAIVE.values()])


def _naive_metrics(
    data: Dataset, split: str | None = None, models=NAIVE, exact: bool = True
) -> DataFrame:
    rows = data.split.label(data.rows) if split is None else data.part(split)
    by = [] if split else ["split"]
    return evaluate.model_metrics(rows, s.TARGET, models, by, exact)


def _naive_runs(data: Dataset) -> DataFrame:
    metrics = _naive_metrics(data, "validation")
    return metrics.select(
        F.col("model").alias("run_id"),
        F.lit("naive").alias("run_name"),
        F.when(F.col("n_rows") > 0, lifecycle.FINISHED).otherwise("FAILED").alias("status"),
        F.col("mae").alias("validation_mae"),
        F.col("rmse").alias("validation_rmse"),
        F.col("r2").alias("validation_r2"),
    )


@query
def regression_metrics(spark, sf_dir):
    return _naive_metrics(_naive_dataset(spark, sf_dir))


@query
def run_metrics(spark, sf_dir):
    return _naive_runs(_naive_dataset(spark, sf_dir))


@query
def best_run(spark, sf_dir):
    """Among the forecasters and a run whose score is no number."""
    runs = _naive_runs(_naive_dataset(spark, sf_dir))
    nan = F.lit(float("nan"))
    broken = runs.limit(1).select(
        F.lit("broken").alias("run_id"),
        "run_name",
        "status",
        *[nan.alias(f"validation_{n}") for n in ("mae", "rmse", "r2")],
    )
    runs = runs.unionByName(broken)
    return lifecycle.best_run(runs, s.SELECTION_METRIC, "naive", recency=())


@query
def quality_gate(spark, sf_dir):
    """Every naive forecaster on the test split against three thresholds, one registry each.

    A fourth one has a score that is no number; it is shown as NULL.
    """
    tested = _naive_metrics(_naive_dataset(spark, sf_dir), "test").select("model", "r2")
    broken = spark.createDataFrame([("broken", float("nan"))], "model string, r2 double")
    scores = tested.unionByName(broken).select(
        F.col("model").alias("run_id"),
        F.col("r2").alias("test_r2"),
        F.explode(F.array(*[F.lit(g) for g in GATES])).alias("gate"),
    )
    gated = lifecycle.quality_gate(scores, "test_r2", F.col("gate")).drop("gate")
    named = gated.withColumn("model_name", F.concat(F.lit("naive>"), F.col("threshold")))
    registered = lifecycle.next_versions(
        named.where("passed").select("model_name", "run_id"),
        spark.createDataFrame([], lifecycle.VERSIONS),
    )
    return named.join(registered, ["model_name", "run_id"], "left").select(
        "model_name",
        "run_id",
        finite(F.col("test_r2")).alias("test_r2"),
        "threshold",
        "passed",
        "version",
    )


def _decisions(data: Dataset) -> DataFrame:
    """The forecasters in both roles, and the rolling mean without a champion."""
    scenarios = {
        "rolling_challenges": {"last_value": s.CHAMPION, "rolling_mean": s.CHALLENGER},
        "last_value_challenges": {"rolling_mean": s.CHAMPION, "last_value": s.CHALLENGER},
        "no_champion": {"rolling_mean": s.CHALLENGER},
        "no_challenger": {"rolling_mean": s.CHAMPION},
        "broken_challenges": {"rolling_mean": s.CHAMPION, "broken": s.CHALLENGER},
        "broken_alone": {"broken": s.CHALLENGER},
    }
    roles = F.array(
        *[
            F.struct(
                F.lit(scenario).alias("scenario"),
                F.lit(model).alias("of_model"),
                F.lit(role).alias("role"),
            )
            for scenario, members in scenarios.items()
            for model, role in members.items()
        ]
    )
    tested = _naive_metrics(data, "test").select("model", "r2")
    broken = tested.limit(1).select(F.lit("broken").alias("model"), F.lit(float("nan")).alias("r2"))
    scores = tested.unionByName(broken).select("model", "r2", F.inline(roles))
    decided = lifecycle.promotion_decision(scores.where("model = of_model"), by=["scenario"])
    return decided.drop("champion_present", "challenger_present")


@query
def champion_challenger(spark, sf_dir):
    return _decisions(_naive_dataset(spark, sf_dir))


@query
def alias_current(spark, sf_dir):
    """Events read as a promotion log: user = model, event type = alias, event = version."""
    log = i.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("model_id"),
        F.col("event_type").alias("alias"),
        F.col("event_id").alias("version"),
        F.col("ts").alias("assigned_at"),
    )
    return lifecycle.current_aliases(log, ["model_id", "alias"])


@query
def alias_by_commit(spark, sf_dir):
    """The same log by the number of each entry, as where clocks of drivers may differ."""
    log = i.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("model_id"),
        F.col("event_type").alias("alias"),
        F.hash("ts").alias("version"),
        F.col("event_id").alias("commit"),
    )
    current = lifecycle.current_aliases(log, ["model_id", "alias"], newest=["commit"])
    return current.select("model_id", "alias", "commit")


@query
def prediction_table(spark, sf_dir):
    """Test rows with the winner's predictions, without the scoring time."""
    data = _dataset(spark, sf_dir)
    roles = F.when(F.col("model") == "last_value", s.CHAMPION).otherwise(s.CHALLENGER)
    scores = _naive_metrics(
        data, "test", {m: NAIVE[m] for m in ("last_value", "rolling_mean")}
    ).withColumn("role", roles)
    # One row, joined as it is.
    decided = lifecycle.promotion_decision(scores).select("metric_r2_passed")
    scored = data.part("test").join(F.broadcast(decided)).withColumn(
        "_prediction",
        F.when(F.col("metric_r2_passed"), F.col(NAIVE["rolling_mean"])).otherwise(
            F.col(NAIVE["last_value"])
        ),
    )
    return publish(scored, s.FEATURES, s.TARGET, "_prediction", stamp=None)


# Sinks


@query
def overwrite_roundtrip(spark, sf_dir):
    """A table written twice holds only the second content, with its schema."""
    path = f"{scratch_path(spark, 'overwritten')}/table"
    write_table(i.bronze_slim(spark, sf_dir), path)
    return write_table(i.gold_slim(spark, sf_dir), path)


# Tree


def _fit(data: Dataset):
    return trees.fit_tree(data.part("train"), s.TARGET, s.CATEGORICAL, s.NUMERIC)


@query
def tree_fit_score(spark, sf_dir):
    data = _dataset(spark, sf_dir)
    return trees.score(_fit(data), data.part("test")).select(
        s.KEY, F.col(s.TARGET).alias("actual_demand"), "predicted_demand"
    )


@query
def tree_known_means(spark, sf_dir):
    """A tree deep enough to tell every category apart must predict the category's train mean."""
    data = _dataset(spark, sf_dir, "p_type", "r_name", [s.TARGET])
    train = data.part("train")
    vocabulary = encode.fit_vocabulary(train, ["product_name"])
    spec = s.TreeSpec(max_depth=len(vocabulary["product_name"]), min_leaf=1)
    model = trees.fit_tree(train, s.TARGET, vocabulary, [], spec)
    return trees.score(model, data.rows).select(s.KEY, s.TARGET, "predicted_demand")


@query
def tree_score_reload(spark, sf_dir):
    """Rows per split that the saved and reloaded pipeline scores as the fitted one does."""
    data = _dataset(spark, sf_dir)
    model = _fit(data)
    reloaded = trees.load_model(trees.save_model(model, scratch_path(spark, "model")))
    scored = trees.score(model, data.split.label(data.rows))
    again = reloaded.copy({reloaded.stages[-1].predictionCol: "again"})
    both = trees.score(again, scored, "again")
    return both.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum((F.col("predicted_demand") == F.col("again")).cast("bigint")).alias("n_same"),
    )


@query
def tree_leaves(spark, sf_dir):
    """Leaves of the full tree that break its rules, of which there must be none.

    Each predicts the mean label of its train rows and has as many as asked for.
    """
    data = _dataset(spark, sf_dir)
    spec = s.TreeSpec()
    model = _fit(data)
    model.stages[-1].setLeafCol("leaf")
    leaves = (
        model.transform(data.part("train"))
        .groupBy("leaf")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(s.TARGET).alias("mean"),
            F.min("predicted_demand").alias("low"),
            F.max("predicted_demand").alias("high"),
        )
    )
    apart = F.greatest(F.abs(F.col("high") - F.col("mean")), F.abs(F.col("low") - F.col("mean")))
    return leaves.agg(
        F.sum("n").cast("bigint").alias("n_rows"),
        F.count_if(F.col("n") < spec.min_leaf).alias("n_small"),
        F.count_if(apart > 1e-6).alias("n_off"),
        (F.count(F.lit(1)) > 1).alias("has_splits"),
    )


def _stump(data: Dataset):
    spec = s.TreeSpec(max_depth=1)
    return trees.fit_tree(data.part("train"), s.TARGET, {}, ["month", "day_of_week"], spec)


@query
def tree_stump(spark, sf_dir):
    """One split on two columns of few values, where the thresholds are exact."""
    data = _dataset(spark, sf_dir, columns=[s.TARGET, "month", "day_of_week"])
    scored = trees.score(_stump(data), data.rows)
    return scored.groupBy("month", "day_of_week").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("predicted_demand").alias("predicted_demand")
    )


def _book_with_a_run(spark, data: Dataset) -> tuple[ModelBook, object]:
    """A run logged with the scores of the trailing mean, so that SQL can tell them."""
    book = ModelBook(spark, scratch_path(spark, "book"))
    model = _stump(data)
    scores = _naive_metrics(data, "validation", {"rolling_mean": s.ROLLING}).first().asDict()
    params = s.TreeSpec(max_depth=1).as_params()
    book.log_run(model, "stump", params, {"team": "demand"}, scores, datetime.now(timezone.utc))
    return book, model


@query
def run_record(spark, sf_dir):
    """A recorded run without its id, path and time."""
    columns = [s.TARGET, s.ROLLING, "month", "day_of_week"]
    book, _ = _book_with_a_run(spark, _dataset(spark, sf_dir, columns=columns))
    return book.runs().select(
        "run_name",
        "status",
        F.col("params")["max_depth"].alias("max_depth"),
        F.col("params")["max_bins"].alias("max_bins"),
        F.col("tags")["team"].alias("team"),
        "validation_mae",
        "validation_rmse",
        "validation_r2",
    )


@query
def alias_model_score(spark, sf_dir):
    """Run, version, alias, and back to a model: rows it scores as the fitted one does."""
    columns = [s.TARGET, s.ROLLING, "month", "day_of_week"]
    data = _dataset(spark, sf_dir, columns=columns)
    book, model = _book_with_a_run(spark, data)
    version = book.register("demand", book.runs().first())
    book.assign("demand", s.CHALLENGER, version, {"test_r2_status": "cleared", "by": "first"})
    book.assign("demand", s.CHALLENGER, version, {"by": "second"})
    held = book.holder("demand", s.CHALLENGER)
    loaded = book.load(held)
    both = trees.score(
        loaded.copy({loaded.stages[-1].predictionCol: "again"}),
        trees.score(model, data.split.label(data.rows)),
        "again",
    )
    tags = book.tags("demand").where(F.col("version") == held["version"]).select(
        F.col("tags")["test_r2_status"].alias("kept_tag"), F.col("tags")["by"].alias("new_tag")
    )
    return (
        both.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum((F.col("predicted_demand") == F.col("again")).cast("bigint")).alias("n_same"),
        )
        .join(F.broadcast(tags))
        .withColumn("version", F.lit(held["version"]).cast("bigint"))
    )


@query
def lifecycle_round(spark, sf_dir):
    """Refresh, train, select and serve: the published predictions of a stump."""
    root = scratch_path(spark, "round")
    write_csv(i.bronze_wide(spark, sf_dir), f"{root}/feed")
    tables = s.Tables.under(f"{root}/tables")
    refresh(spark, f"{root}/feed", tables, lean=True, exact=True)
    remove_path(spark, f"{root}/feed")
    book = ModelBook(spark, tables.models)
    rules = s.Lifecycle(threshold=float("-inf"))
    with build_dataset(spark, tables) as data:
        columns = {"categorical": (), "numeric": ("month", "day_of_week")}
        train(data, book, rules, s.TreeSpec(max_depth=1), exact=True, **columns)
        select(data, book, rules, exact=True)
        outcome = serve(data, book, tables, rules, exact=True)
    status = F.lit(outcome.status)
    published = read_table(spark, tables.predictions).drop("timestamp")
    return published.withColumns({"status": status, "version": F.lit(outcome.challenger_version).cast("bigint")})
