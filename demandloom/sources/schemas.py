"""Source schema of the transaction feed."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Column names and types in file order (CSV binding is positional).
TRANSACTIONS_DDL = """
transaction_id string,
transaction_date date,
transaction_year int,
transaction_quarter int,
transaction_month int,
product_name string,
product_category string,
quantity_unit string,
supplier_name string,
supplier_country string,
supplier_reliability_score double,
refinery_name string,
destination_city string,
transportation_mode string,
ordered_quantity double,
demand_quantity double,
available_inventory double,
unit_price_usd double,
product_cost_usd double,
transportation_cost_usd double,
total_cost_usd double,
expected_lead_time_days int,
actual_lead_time_days int,
delay_days int,
is_delayed int,
is_stockout int,
quality_status string,
quality_score double,
disruption_type string,
delivery_status string,
ingestion_timestamp string,
source_system string,
operation_type string
"""


def transactions_schema() -> StructType:
    return StructType.fromDDL(TRANSACTIONS_DDL)
