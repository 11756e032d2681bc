"""Plain SQL for every registered query with a deterministic answer.

Written against the raw tables, independently of the operators: a global
``row_number`` instead of cut points, plain windows instead of chunks.
"""

from __future__ import annotations


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _silver(product: str = "p_brand", place: str = "n_name") -> str:
    return f"""silver AS (
  SELECT CAST(o_orderdate AS DATE) AS transaction_date,
         {product} AS product_name, {place} AS destination_city,
         l_quantity AS demand_quantity, p_retailprice AS unit_price_usd,
         p_size * l_quantity AS available_inventory
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_partkey, l_quantity) AS line_rank
        FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  WHERE line_rank = 1)"""


BRONZE_SLIM = """bronze AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         p_brand AS product_name, n_name AS destination_city,
         l_quantity AS demand_quantity, p_retailprice AS unit_price_usd,
         p_size * l_quantity AS available_inventory
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey)"""

BRONZE_WIDE = """bronze AS (
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
         CAST(o_orderdate AS DATE) AS transaction_date,
         CAST(year(o_orderdate) AS INTEGER) AS transaction_year,
         CAST(quarter(o_orderdate) AS INTEGER) AS transaction_quarter,
         CAST(month(o_orderdate) AS INTEGER) AS transaction_month,
         p_brand AS product_name, p_type AS product_category, 'EA' AS quantity_unit,
         s_name AS supplier_name, sn.n_name AS supplier_country,
         s_acctbal AS supplier_reliability_score, c_mktsegment AS refinery_name,
         cn.n_name AS destination_city, o_orderpriority AS transportation_mode,
         l_quantity AS ordered_quantity, l_quantity AS demand_quantity,
         p_size * l_quantity AS available_inventory, p_retailprice AS unit_price_usd,
         l_extendedprice AS product_cost_usd, l_tax AS transportation_cost_usd,
         o_totalprice AS total_cost_usd,
         CAST(p_size AS INTEGER) AS expected_lead_time_days,
         CAST(date_diff('day', o_orderdate, l_shipdate) AS INTEGER) AS actual_lead_time_days,
         CAST(date_diff('day', o_orderdate, l_shipdate) - p_size AS INTEGER) AS delay_days,
         CAST(date_diff('day', o_orderdate, l_shipdate) > p_size AS INTEGER) AS is_delayed,
         CAST(l_returnflag = 'R' AS INTEGER) AS is_stockout,
         l_linestatus AS quality_status, l_discount AS quality_score,
         CASE WHEN date_diff('day', o_orderdate, l_shipdate) > p_size
              THEN c_mktsegment END AS disruption_type,
         o_orderstatus AS delivery_status,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS ingestion_timestamp,
         'tables' AS source_system, 'I' AS operation_type
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey)"""


def _cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def _gold(source: str = "silver") -> str:
    return f"""gold AS (
  SELECT transaction_date, product_name, destination_city,
         CAST(sum({_cents('demand_quantity')}) AS DOUBLE) / 100 AS total_demand,
         CAST((2 * sum({_cents('unit_price_usd')}) + count(unit_price_usd))
              // (2 * count(unit_price_usd)) AS DOUBLE) / 100 AS avg_unit_price,
         CAST(sum({_cents('available_inventory')}) AS DOUBLE) / 100 AS total_inventory,
         CAST(count(*) AS BIGINT) AS transaction_count
  FROM {source}
  GROUP BY transaction_date, product_name, destination_city)"""


FEATURES = f"""features AS (
  SELECT *,
         lag(total_demand, 1) OVER w AS demand_1,
         lag(total_demand, 7) OVER w AS demand_7,
         CASE WHEN count(total_demand) OVER f > 0 THEN
           CAST((2 * sum({_cents('total_demand')}) OVER f + count(total_demand) OVER f)
                // (2 * count(total_demand) OVER f) AS DOUBLE) / 100 END AS rolling_7_day_avg,
         CAST(month(transaction_date) AS INTEGER) AS month,
         CAST(dayofweek(transaction_date) + 1 AS INTEGER) AS day_of_week
  FROM gold
  WINDOW w AS (PARTITION BY product_name, destination_city ORDER BY transaction_date),
         f AS (PARTITION BY product_name, destination_city ORDER BY transaction_date
               ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))"""

KEY_SQL = (
    "concat_ws('-', strftime(transaction_date, '%Y%m%d'), product_name, destination_city)"
)

KEYED = f"""keyed AS (
  SELECT {KEY_SQL} AS primary_key, transaction_date, product_name, destination_city,
         total_demand, avg_unit_price, total_inventory, transaction_count,
         coalesce(demand_1, 0) AS demand_1, coalesce(demand_7, 0) AS demand_7,
         coalesce(rolling_7_day_avg, 0) AS rolling_7_day_avg, month, day_of_week
  FROM features)"""

UNFILLED = f"unfilled AS (SELECT {KEY_SQL} AS primary_key, * FROM features)"


def _split(source: str = "keyed") -> str:
    return f"""ranked AS (
  SELECT *, CAST(row_number() OVER (ORDER BY transaction_date, primary_key) AS BIGINT) AS rn,
         count(*) OVER () AS n
  FROM {source}),
sized AS (SELECT *, (n + 4) // 5 AS n_test, (n - (n + 4) // 5 + 4) // 5 AS n_val FROM ranked),
split AS (
  SELECT *, CASE WHEN rn <= n - n_test - n_val THEN 'train'
                 WHEN rn <= n - n_test THEN 'validation' ELSE 'test' END AS split
  FROM sized)"""


LONG = """long AS (
  SELECT split, 'last_value' AS model, total_demand AS y, demand_1 AS p FROM split
  UNION ALL
  SELECT split, 'seventh_last' AS model, total_demand AS y, demand_7 AS p FROM split
  UNION ALL
  SELECT split, 'rolling_mean' AS model, total_demand AS y, rolling_7_day_avg AS p FROM split)"""

METRICS = f"""sums AS (
  SELECT model, split, count(*) AS n,
         sum(abs({_cents('y')} - {_cents('p')})) AS sae,
         sum(CAST({_cents('y')} - {_cents('p')} AS HUGEINT)
             * ({_cents('y')} - {_cents('p')})) AS sse,
         sum(CAST({_cents('y')} AS HUGEINT)) AS sy,
         sum(CAST({_cents('y')} AS HUGEINT) * {_cents('y')}) AS syy
  FROM long GROUP BY model, split),
metrics AS (
  SELECT model, split, CAST(n AS BIGINT) AS n_rows,
         CAST(sae AS DOUBLE) / CAST(n * 100 AS DOUBLE) AS mae,
         sqrt(CAST(sse AS DOUBLE) / CAST(n AS DOUBLE)) / 100 AS rmse,
         CASE WHEN n < 2 THEN NULL
              WHEN n * syy - sy * sy = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END
              ELSE 1.0 - CAST(n * sse AS DOUBLE) / CAST(n * syy - sy * sy AS DOUBLE)
         END AS r2
  FROM sums)"""

BASE = (_silver(), _gold())
FEATURED = (*BASE, FEATURES)
ALL_KEYED = (*FEATURED, KEYED)
SPLIT = (*ALL_KEYED, _split())
SCORED = (*SPLIT, LONG, METRICS)

FEATURE_COLUMNS = """primary_key, transaction_date, product_name, destination_city,
       avg_unit_price, total_inventory, transaction_count, demand_1, demand_7,
       rolling_7_day_avg, month, day_of_week"""

LINE_ORDER = """l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount,
         l_tax, l_returnflag, l_linestatus"""

# The categories of the small encoding, in sorted order.
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


def _audit(source: str, key: str, name: str) -> str:
    return f"""SELECT '{name}' AS audited,
       CAST(sum(k) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(CASE WHEN key IS NULL OR key = '' THEN k END), 0) AS BIGINT)
         AS n_empty_keys,
       CAST(sum(CASE WHEN k > 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_repeated_keys,
       CAST(sum(CASE WHEN k > 1 THEN k ELSE 0 END) AS BIGINT) AS n_rows_repeated
  FROM (SELECT {key} AS key, count(*) AS k FROM {source} GROUP BY 1)"""


def _one_hot() -> str:
    flags = [
        f"CAST(product_name = '{v}' AS INTEGER) AS \"product_name_{v}\"" for v in TYPES
    ] + [f"CAST(destination_city = '{v}' AS INTEGER) AS \"destination_city_{v}\"" for v in REGIONS]
    return (
        _with(_silver("p_type", "r_name"), _gold(), FEATURES, KEYED)
        + """SELECT primary_key, avg_unit_price, total_inventory, transaction_count, demand_1,
       demand_7, rolling_7_day_avg, month, day_of_week, """
        + ", ".join(flags)
        + " FROM keyed"
    )


def _scenario(name: str, champion: str | None, challenger: str | None) -> str:
    def r2(model: str | None) -> str:
        if model is None:
            return "CAST(NULL AS DOUBLE)"
        return f"(SELECT r2 FROM metrics WHERE split = 'test' AND model = '{model}')"

    if challenger is None:
        passed, status = "false", "'no_challenger'"
    elif champion is None:
        passed, status = "true", "'promoted'"
    else:
        passed = f"{r2(challenger)} > {r2(champion)}"
        status = f"CASE WHEN {passed} THEN 'promoted' ELSE 'kept' END"
    return (
        f"SELECT '{name}' AS scenario, {r2(champion)} AS champion_r2, "
        f"{r2(challenger)} AS challenger_r2, {passed} AS metric_r2_passed, {status} AS status"
    )


RUNS = """SELECT model AS run_id, 'naive' AS run_name, 'FINISHED' AS status,
       mae AS validation_mae, rmse AS validation_rmse, r2 AS validation_r2
FROM metrics WHERE split = 'validation'"""

WINNER = """(SELECT r2 FROM metrics WHERE split = 'test' AND model = 'rolling_mean')
            > (SELECT r2 FROM metrics WHERE split = 'test' AND model = 'last_value')"""

# The feed's own order of the rows of one id: by the columns that reach the facts.
SILVER_OF_FEED = """silver AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
                                 ORDER BY transaction_date, product_name, destination_city,
                                          demand_quantity, unit_price_usd, available_inventory)
              AS line_rank
    FROM bronze) WHERE line_rank = 1)"""

FED = (BRONZE_WIDE, SILVER_OF_FEED, _gold(), FEATURES, KEYED)
REFRESHED = _with(*FED) + (
    f"SELECT total_demand, {FEATURE_COLUMNS} FROM keyed"
)


def _none_off(names: tuple[str, ...], source: str) -> list[str]:
    return [
        f"SELECT CAST(count(*) AS BIGINT) AS n_rows, '{n}' AS measure, CAST(0 AS BIGINT) AS n_off "
        f"FROM {source}"
        for n in names
    ]


# Every way to cut two columns of few values in two, at least 15 train rows a side.
STUMP = """train AS (SELECT * FROM split WHERE split = 'train'),
cells AS (
  SELECT 'month' AS f, month AS v, total_demand AS y FROM train
  UNION ALL SELECT 'day_of_week', day_of_week, total_demand FROM train),
cuts AS (
  SELECT DISTINCT a.f, a.v, count(*) FILTER (b.v <= a.v) AS n_low,
         count(*) FILTER (b.v > a.v) AS n_high, sum(b.y) FILTER (b.v <= a.v) AS y_low,
         sum(b.y) FILTER (b.v > a.v) AS y_high
  FROM (SELECT DISTINCT f, v FROM cells) a JOIN cells b ON a.f = b.f GROUP BY a.f, a.v),
best AS (
  SELECT *, y_low / n_low AS low, y_high / n_high AS high FROM cuts
  WHERE n_low >= 15 AND n_high >= 15
  ORDER BY y_low * y_low / n_low + y_high * y_high / n_high DESC LIMIT 1)"""

EXACT = 2**41  # every price times 8 or more is a whole number of its parts


def _exact(total: str) -> str:
    """A whole number of parts as a double: two halves that fit one, added with one rounding."""
    halves = [f"CAST(abs({total}) {op} CAST({2**53} AS HUGEINT) AS DOUBLE)" for op in ("//", "%")]
    return f"sign({total}) * ({halves[0]} * {2**53}.0 + {halves[1]}) / {EXACT}.0"


ORACLE: dict[str, str] = {
    "refresh_features": REFRESHED,
    "refresh_daily": REFRESHED,
    "feature_table_properties": _with(*FED)
    + """SELECT 'primary_key' AS property, 'primary_key' AS value
UNION ALL SELECT 'tag.owner', 'planning' UNION ALL SELECT 'tag.layer', 'features'
UNION ALL SELECT 'comment', 'Daily demand'
UNION ALL SELECT 'rows', CAST(count(*) AS VARCHAR) FROM keyed""",
    "composite_key_audit": _with(
        *BASE,
        """parts AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS d,
         CASE WHEN c_custkey % 3 > 0 THEN o_orderpriority END AS priority,
         CASE WHEN c_custkey % 5 > 0 THEN concat_ws('-', o_orderstatus, n_name) END AS place
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
    )
    + _audit("gold", KEY_SQL, "facts")
    + "\nUNION ALL\n"
    + _audit("parts", "concat_ws('-', strftime(d, '%Y%m%d'), priority, place)", "orders"),
    "exact_double_sums": f"""
SELECT l_returnflag, {_exact('mixed')} AS sum_mixed, {_exact('price')} AS sum_price, n_prices, n_rows
FROM (SELECT l_returnflag, CAST(count(l_extendedprice) AS BIGINT) AS n_prices,
             CAST(count(*) AS BIGINT) AS n_rows,
             sum(CAST(l_extendedprice * power(2, 3 * l_linenumber) * {EXACT}.0
                      * CASE WHEN l_linestatus = 'F' THEN -1 ELSE 1 END AS HUGEINT)) AS mixed,
             sum(CAST(l_extendedprice * {EXACT}.0 AS HUGEINT)) AS price
      FROM lineitem GROUP BY l_returnflag)""",
    "one_hot_sparse": """
WITH customers AS (
  SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS slot,
         CAST(count(*) OVER () AS INTEGER) AS size
  FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS value FROM orders
        WHERE o_orderstatus = 'F' AND o_custkey IS NOT NULL)),
priorities AS (
  SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS INTEGER) AS slot,
         CAST(count(*) OVER () AS INTEGER) AS size
  FROM (SELECT DISTINCT o_orderpriority AS value FROM orders
        WHERE o_orderstatus = 'F' AND o_orderpriority IS NOT NULL))
SELECT o_orderkey, (SELECT max(size) FROM customers) AS o_custkey_size, c.slot AS o_custkey_slot,
       CASE WHEN c.slot IS NOT NULL THEN CAST(1 AS DOUBLE) END AS o_custkey_value,
       (SELECT max(size) FROM priorities) AS o_orderpriority_size, p.slot AS o_orderpriority_slot,
       CASE WHEN p.slot IS NOT NULL THEN CAST(1 AS DOUBLE) END AS o_orderpriority_value
FROM orders LEFT JOIN customers c ON c.value = CAST(o_custkey AS VARCHAR)
LEFT JOIN priorities p ON p.value = o_orderpriority""",
    "alias_by_commit": """
SELECT user_id AS model_id, event_type AS alias, max(event_id) AS "commit"
FROM events GROUP BY user_id, event_type""",
    "lifecycle_round": _with(*FED, _split(), STUMP)
    + f"""SELECT {FEATURE_COLUMNS}, total_demand AS actual_demand,
       CASE WHEN CASE WHEN f = 'month' THEN month ELSE day_of_week END <= v
            THEN low ELSE high END AS predicted_demand,
       'promoted' AS status, CAST(1 AS BIGINT) AS version
FROM split, best WHERE split = 'test'""",
    "refresh_features_lean": REFRESHED,
    "default_rounding": _with(*SCORED)
    + "\nUNION ALL\n".join(
        [
            *_none_off(
                ("total_demand", "avg_unit_price", "total_inventory", "rolling_7_day_avg"), "gold"
            ),
            *_none_off(("mae", "rmse", "r2"), "metrics"),
        ]
    ),
    "tree_leaves": _with(*SPLIT)
    + """SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(0 AS BIGINT) AS n_small,
       CAST(0 AS BIGINT) AS n_off, true AS has_splits
FROM split WHERE split = 'train'""",
    "tree_stump": _with(*SPLIT, STUMP)
    + """SELECT month, day_of_week, CAST(count(*) AS BIGINT) AS n_rows,
       max(CASE WHEN CASE WHEN f = 'month' THEN month ELSE day_of_week END <= v
                THEN low ELSE high END) AS predicted_demand
FROM split, best GROUP BY month, day_of_week""",
    "run_record": _with(*SCORED)
    + """SELECT 'stump' AS run_name, 'FINISHED' AS status, '1' AS max_depth, '128' AS max_bins,
       'demand' AS team, mae AS validation_mae, rmse AS validation_rmse, r2 AS validation_r2
FROM metrics WHERE split = 'validation' AND model = 'rolling_mean'""",
    "alias_model_score": _with(*SPLIT)
    + """SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_same,
       'cleared' AS kept_tag, 'second' AS new_tag, CAST(1 AS BIGINT) AS version
FROM split GROUP BY split""",
    "csv_typed_scan": _with(BRONZE_WIDE) + "SELECT * FROM bronze",
    "csv_permissive_nulls": """
SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
       CASE WHEN l_linenumber <> 1 THEN CAST(l_shipdate AS DATE) END AS transaction_date,
       CASE WHEN l_linenumber NOT IN (3, 5) THEN CAST(year(l_shipdate) AS INTEGER) END
         AS transaction_year,
       CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS product_name,
       CASE WHEN l_linenumber NOT IN (2, 3) THEN l_quantity END AS demand_quantity
FROM lineitem""",
    "ingest_stamp": _with(BRONZE_SLIM)
    + """SELECT transaction_date, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) AS BIGINT) AS n_stamped, true AS one_stamp
FROM bronze GROUP BY transaction_date""",
    "drop_metadata": _with(BRONZE_WIDE)
    + "SELECT * EXCLUDE (ingestion_timestamp, source_system, operation_type) FROM bronze",
    "dedup_by_key": f"""
SELECT transaction_id, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate, l_quantity,
       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
FROM (SELECT l_orderkey || '-' || l_linenumber AS transaction_id, *,
             row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                ORDER BY {LINE_ORDER}) AS line_rank
      FROM lineitem)
WHERE line_rank = 1""",
    "layer_row_counts": _with(
        BRONZE_SLIM,
        SILVER_OF_FEED,
        _gold(),
        FEATURES,
    )
    + """SELECT 'bronze' AS layer, CAST(count(*) AS BIGINT) AS n_rows FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold', count(*) FROM gold
UNION ALL SELECT 'gold_features', count(*) FROM features""",
    "gold_fact": _with(*BASE) + "SELECT * FROM gold",
    "lag_features": _with(*FEATURED)
    + """SELECT transaction_date, product_name, destination_city, total_demand, demand_1, demand_7
FROM features""",
    "rolling_mean": _with(*FEATURED)
    + """SELECT transaction_date, product_name, destination_city, total_demand, rolling_7_day_avg
FROM features""",
    "hot_series_features": f"""
SELECT event_id, event_type, lag(value, 1) OVER w AS value_1, lag(value, 7) OVER w AS value_7,
       CASE WHEN count(value) OVER f > 0 THEN
         CAST((2 * sum({_cents('value')}) OVER f + count(value) OVER f)
              // (2 * count(value) OVER f) AS DOUBLE) / 100 END AS rolling_value
FROM events
WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id),
       f AS (PARTITION BY event_type ORDER BY ts, event_id
             ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)""",
    "calendar_features": _with(*FEATURED)
    + """SELECT transaction_date, product_name, destination_city, month, day_of_week
FROM features""",
    "fill_cold_start": _with(*ALL_KEYED)
    + """SELECT transaction_date, product_name, destination_city, demand_1, demand_7,
       rolling_7_day_avg FROM keyed""",
    "composite_key": _with(*BASE)
    + f"""SELECT transaction_date, product_name, destination_city, {KEY_SQL} AS primary_key
FROM gold""",
    "feature_table": _with(*ALL_KEYED) + f"SELECT {FEATURE_COLUMNS} FROM keyed",
    "label_table": _with(*ALL_KEYED) + "SELECT primary_key, total_demand FROM keyed",
    "key_audit": _with(*BASE)
    + _audit("lineitem", "l_orderkey || '-' || l_linenumber", "transaction_id")
    + "\nUNION ALL\n"
    + _audit("gold", KEY_SQL, "primary_key"),
    "training_set_join": _with(*ALL_KEYED)
    + f"""SELECT y.primary_key, y.total_demand,
       x.* EXCLUDE (primary_key)
FROM (SELECT primary_key, total_demand FROM keyed) y
LEFT JOIN (SELECT {FEATURE_COLUMNS} FROM keyed) x ON x.primary_key = y.primary_key""",
    "training_frame": _with(*ALL_KEYED)
    + "SELECT * EXCLUDE (primary_key, transaction_date) FROM keyed",
    "chrono_rank": _with(*SPLIT) + "SELECT primary_key, transaction_date, rn FROM split",
    "chrono_split": _with(*SPLIT) + "SELECT primary_key, transaction_date, split FROM split",
    "split_sizes": _with(*SPLIT)
    + "SELECT split, CAST(count(*) AS BIGINT) AS n_rows FROM split GROUP BY split",
    "null_profile": _with(*FEATURED, UNFILLED, _split("unfilled"))
    + """SELECT split, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(*) - count(total_demand) AS BIGINT) AS total_demand_nulls,
       CAST(count(*) - count(demand_1) AS BIGINT) AS demand_1_nulls,
       CAST(count(*) - count(demand_7) AS BIGINT) AS demand_7_nulls,
       CAST(count(*) - count(rolling_7_day_avg) AS BIGINT) AS rolling_7_day_avg_nulls
FROM split GROUP BY split""",
    "category_vocab": _with(*SPLIT)
    + """SELECT "column", value, CAST(count(*) AS BIGINT) AS n_rows,
       CAST(row_number() OVER (PARTITION BY "column" ORDER BY value) - 1 AS INTEGER) AS position
FROM (SELECT 'product_name' AS "column", product_name AS value FROM split WHERE split = 'train'
      UNION ALL
      SELECT 'destination_city', destination_city FROM split WHERE split = 'train')
GROUP BY "column", value""",
    "one_hot_wide": _one_hot(),
    "one_hot_unseen": """
WITH placed AS (
  SELECT n_name, o_orderpriority, r_name
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
nations AS (SELECT n_name, CAST(row_number() OVER (ORDER BY n_name) - 1 AS INTEGER) AS slot
            FROM (SELECT DISTINCT n_name FROM placed WHERE r_name = 'ASIA')),
priorities AS (
  SELECT o_orderpriority, CAST(row_number() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS slot
  FROM (SELECT DISTINCT o_orderpriority FROM placed WHERE r_name = 'ASIA')),
everything AS (SELECT n_name, o_orderpriority, CAST(count(*) AS BIGINT) AS n_rows
               FROM placed GROUP BY ALL)
SELECT e.n_name, e.o_orderpriority, e.n_rows,
       CASE WHEN a.slot IS NULL THEN 0 ELSE 1 END AS n_name_ones, a.slot AS n_name_slot,
       CASE WHEN b.slot IS NULL THEN 0 ELSE 1 END AS o_orderpriority_ones,
       b.slot AS o_orderpriority_slot
FROM everything e
LEFT JOIN nations a ON a.n_name = e.n_name
LEFT JOIN priorities b ON b.o_orderpriority = e.o_orderpriority""",
    "regression_metrics": _with(*SCORED)
    + "SELECT model, split, n_rows, mae, rmse, r2 FROM metrics",
    "run_metrics": _with(*SCORED) + RUNS,
    "best_run": _with(*SCORED) + RUNS + " ORDER BY r2 DESC NULLS LAST, model LIMIT 1",
    "quality_gate": _with(*SCORED)
    + """SELECT model_name, run_id, test_r2, threshold, coalesce(test_r2 > threshold, false) AS passed,
       CASE WHEN test_r2 > threshold THEN
         CAST(row_number() OVER (PARTITION BY model_name, test_r2 > threshold ORDER BY run_id)
              AS BIGINT) END AS version
FROM ("""
    + "\n  UNION ALL ".join(
        f"SELECT 'naive>{g}' AS model_name, model AS run_id, r2 AS test_r2, "
        f"CAST({g} AS DOUBLE) AS threshold FROM metrics WHERE split = 'test'\n  UNION ALL "
        f"SELECT 'naive>{g}', 'broken', CAST(NULL AS DOUBLE), CAST({g} AS DOUBLE)"
        for g in (-2.0, -0.5, 0.9)
    )
    + ")",
    "champion_challenger": _with(*SCORED)
    + "\nUNION ALL\n".join(
        [
            _scenario("rolling_challenges", "last_value", "rolling_mean"),
            _scenario("last_value_challenges", "rolling_mean", "last_value"),
            _scenario("no_champion", None, "rolling_mean"),
            _scenario("no_challenger", "rolling_mean", None),
            "SELECT 'broken_challenges', (SELECT r2 FROM metrics WHERE split = 'test' "
            "AND model = 'rolling_mean'), CAST(NULL AS DOUBLE), false, 'kept'",
            "SELECT 'broken_alone', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), false, 'kept'",
        ]
    ),
    "alias_current": """
SELECT user_id AS model_id, event_type AS alias, event_id AS version, ts AS assigned_at
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type
                                   ORDER BY ts DESC, event_id DESC) AS newest
      FROM events)
WHERE newest = 1""",
    "prediction_table": _with(*SCORED)
    + f"""SELECT {FEATURE_COLUMNS}, total_demand AS actual_demand,
       CAST(CASE WHEN {WINNER} THEN rolling_7_day_avg ELSE demand_1 END AS DOUBLE)
         AS predicted_demand
FROM split WHERE split = 'test'""",
    "overwrite_roundtrip": _with(*BASE) + "SELECT * FROM gold",
    "tree_known_means": _with(_silver("p_type", "r_name"), _gold(), FEATURES, KEYED, _split())
    + """SELECT primary_key, total_demand,
       avg(CASE WHEN split = 'train' THEN total_demand END) OVER (PARTITION BY product_name)
         AS predicted_demand
FROM split""",
    "tree_score_reload": _with(*SPLIT)
    + """SELECT split, CAST(count(*) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_same
FROM split GROUP BY split""",
}
