"""The test tables seen as a transaction feed.

transaction = order line, date = order date, product = part brand, city = nation
of the customer, demand = line quantity, price = retail price of the part,
inventory = part size times quantity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom.operators.refine import dedup_by_key
from demandloom.plans.refresh import gold, gold_features, keyed
from demandloom.session import materialize
from demandloom.sources.schemas import transactions_schema

LINE_KEY = ["l_orderkey", "l_linenumber"]

# Declared table schemas, so that no job runs to infer them.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def transaction_id():
    return F.concat_ws("-", "l_orderkey", "l_linenumber")


def orders_with_place(spark: SparkSession, sf_dir: str, place: str = "n_name") -> DataFrame:
    """Orders with the customer's nation or region; joined before the lines, which are far more."""
    geography = table(spark, sf_dir, "nation")
    if place == "r_name":
        geography = geography.join(
            table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
    customers = table(spark, sf_dir, "customer").join(
        geography, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return table(spark, sf_dir, "orders").join(
        customers, F.col("o_custkey") == F.col("c_custkey")
    )


def transactions(
    spark: SparkSession,
    sf_dir: str,
    lines: DataFrame,
    product: str = "p_brand",
    place: str = "n_name",
) -> DataFrame:
    """The seven feed columns that results depend on, for the given order lines."""
    return (
        lines.join(
            orders_with_place(spark, sf_dir, place), F.col("l_orderkey") == F.col("o_orderkey")
        )
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            transaction_id().alias("transaction_id"),
            F.to_date("o_orderdate").alias("transaction_date"),
            F.col(product).alias("product_name"),
            F.col(place).alias("destination_city"),
            F.col("l_quantity").alias("demand_quantity"),
            F.col("p_retailprice").alias("unit_price_usd"),
            (F.col("p_size") * F.col("l_quantity")).alias("available_inventory"),
        )
    )


def bronze_slim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed with repeated transactions, as ingested."""
    return transactions(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def silver_slim(
    spark: SparkSession, sf_dir: str, product: str = "p_brand", place: str = "n_name"
) -> DataFrame:
    """Feed with one row per transaction.

    Lines are cut to one per key before any join. Only part and quantity of a
    line are read downstream, so ordering by those two fixes the result and
    keeps the other line columns out of the scan.
    """
    lines = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_quantity")
    survivors = dedup_by_key(lines, LINE_KEY, ["l_partkey", "l_quantity"])
    return transactions(spark, sf_dir, survivors, product, place)


def gold_slim(
    spark: SparkSession, sf_dir: str, product: str = "p_brand", place: str = "n_name"
) -> DataFrame:
    return gold(silver_slim(spark, sf_dir, product, place), exact=True)


def features_slim(
    spark: SparkSession, sf_dir: str, product: str = "p_brand", place: str = "n_name"
) -> DataFrame:
    return gold_features(gold_slim(spark, sf_dir, product, place), exact=True)


def keyed_slim(
    spark: SparkSession, sf_dir: str, product: str = "p_brand", place: str = "n_name"
) -> DataFrame:
    return keyed(features_slim(spark, sf_dir, product, place))


def written_keyed(
    spark: SparkSession,
    sf_dir: str,
    product: str = "p_brand",
    place: str = "n_name",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Keyed features with label, or some ``columns`` of them, in a written table.

    For plans that read them more than once. What computes the other columns is
    pruned from the plan.
    """
    keyed_df = keyed_slim(spark, sf_dir, product, place)
    if columns:
        keyed_df = keyed_df.select(*dict.fromkeys(columns))
    return materialize(keyed_df, "keyed")


def bronze_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 33 feed columns, with repeated transactions.

    Lines meet the narrow parts first and the orders next, so that no exchange has the columns
    of both, and the rows leave the last one order by order: text of neighbours that have much
    in common compresses better. Suppliers and nations come last, each as it is stored: of a
    join Catalyst takes the product of the sizes, and would exchange all rows for a small table.
    """
    supplier_nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("sn_nationkey"), F.col("n_name").alias("sn_name")
    )
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    delay = F.datediff("l_shipdate", "o_orderdate") - F.col("p_size")
    columns = {
        "transaction_id": transaction_id(),
        "transaction_date": F.to_date("o_orderdate"),
        "transaction_year": F.year("o_orderdate"),
        "transaction_quarter": F.quarter("o_orderdate"),
        "transaction_month": F.month("o_orderdate"),
        "product_name": F.col("p_brand"),
        "product_category": F.col("p_type"),
        "quantity_unit": F.lit("EA"),
        "supplier_name": F.col("s_name"),
        "supplier_country": F.col("sn_name"),
        "supplier_reliability_score": F.col("s_acctbal"),
        "refinery_name": F.col("c_mktsegment"),
        "destination_city": F.col("n_name"),
        "transportation_mode": F.col("o_orderpriority"),
        "ordered_quantity": F.col("l_quantity"),
        "demand_quantity": F.col("l_quantity"),
        "available_inventory": F.col("p_size") * F.col("l_quantity"),
        "unit_price_usd": F.col("p_retailprice"),
        "product_cost_usd": F.col("l_extendedprice"),
        "transportation_cost_usd": F.col("l_tax"),
        "total_cost_usd": F.col("o_totalprice"),
        "expected_lead_time_days": F.col("p_size"),
        "actual_lead_time_days": F.datediff("l_shipdate", "o_orderdate"),
        "delay_days": delay,
        "is_delayed": (delay > 0).cast("int"),
        "is_stockout": (F.col("l_returnflag") == "R").cast("int"),
        "quality_status": F.col("l_linestatus"),
        "quality_score": F.col("l_discount"),
        "disruption_type": F.when(delay > 0, F.col("c_mktsegment")),
        "delivery_status": F.col("o_orderstatus"),
        "ingestion_timestamp": F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        "source_system": F.lit("tables"),
        "operation_type": F.lit("I"),
    }
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(supplier_nation, F.col("s_nationkey") == F.col("sn_nationkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    schema = transactions_schema()
    return joined.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in schema])
