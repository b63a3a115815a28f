"""The same results in plain SQL."""

from __future__ import annotations

from workload.queries import (
    AS_OF,
    EVENTS_MARK,
    LOW_DAY,
    ORDERS_MARK,
)
from workload.standins import CONFORMED, INSTALLS_SRC, MERCHANT_SRC, OFFERS_SRC, TYPED_OFFERS
from workload.upkeep import SQL as UPKEEP

WINDOW = f"""
  install_date > DATE '{LOW_DAY}' AND install_date < DATE '{AS_OF}' - INTERVAL 1 DAY"""

LATEST_ORDER = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_custkey IS NOT NULL)
  WHERE rn = 1"""

LATEST_HOT = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY key ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS key FROM orders)
    WHERE key IS NOT NULL)
  WHERE rn = 1"""

LATEST_MERCHANT = """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (
      PARTITION BY "mrchID" ORDER BY mt_update_dt DESC, mrch_key DESC, mrch_sid DESC,
        "mrchName" DESC, mrch_rating DESC) AS rn
    FROM conformed WHERE "mrchID" IS NOT NULL)
  WHERE rn = 1"""

ORACLE = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_pushed_filter": f"""
        SELECT * FROM events
        WHERE CAST(ts AS DATE) > DATE '{LOW_DAY}'
          AND CAST(ts AS DATE) < DATE '{AS_OF}' - INTERVAL 1 DAY""",
    "sink_append": "SELECT * FROM orders",
    "sink_overwrite_staging": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'",
    "sink_partitioned_append": f"WITH {INSTALLS_SRC} SELECT * FROM installs_src",
    "insert_select_typed": f"WITH {OFFERS_SRC} {TYPED_OFFERS}",
    "replace_from_self": LATEST_ORDER,
    "drop_if_exists": """
        SELECT count(*) AS rows_before, true AS dropped, false AS dropped_again,
               CAST(0 AS BIGINT) AS rows_after
        FROM orders""",
    "drop_column": "SELECT * FROM orders",
    "project_rename": f"""
        WITH {MERCHANT_SRC}
        SELECT mrch_key, mrch_id AS "mrchID", mt_update_dt, mrch_sid, mrch_name AS "mrchName",
               mrch_full_name AS "mrchFullName", mrch_is_test AS mrch_is_test_mrch,
               mrch_activation_date, mrch_forgiveness_dt AS mrch_forgiveness_date,
               mrch_show_pdp, mrch_show_cc,
               mrch_delivery_order_section_enabled AS mrch_is_delivery_order_section_enabled,
               mrch_last_feed_dt AS mrch_last_feed_date, mrch_integration_is_active,
               mrch_main_category_key, mrch_sales_manager_key AS sales_manager_key,
               mrch_sales_manager_name AS sales_manager_name, mrch_rating
        FROM merchant_src""",
    "project_cast": f"""
        WITH {MERCHANT_SRC}
        SELECT mrch_key, TRY_CAST(mrch_activation_date AS DATE) AS mrch_activation_date,
               TRY_CAST(mrch_show_pdp AS BOOLEAN) AS mrch_show_pdp,
               TRY_CAST(mrch_show_cc AS BOOLEAN) AS mrch_show_cc,
               TRY_CAST(mrch_integration_is_active AS BIGINT) AS mrch_integration_is_active,
               TRY_CAST(mrch_main_category_key AS BIGINT) AS mrch_main_category_key,
               TRY_CAST(mrch_sales_manager_key AS BIGINT) AS sales_manager_key
        FROM merchant_src""",
    "project_hex_key": """
        SELECT o_orderkey, '0x' || hex(encode(o_orderpriority)) AS from_binary,
               '0x' || hex(o_orderpriority) AS from_text, '0x' || hex(o_custkey) AS from_number,
               '0x' || hex(CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS from_null
        FROM orders""",
    "project_derived_date": "SELECT *, CAST(o_orderdate AS DATE) AS update_date FROM orders",
    "project_constant": """
        SELECT l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS "IsOffer" FROM lineitem""",
    "project_passthrough": "SELECT * EXCLUDE (o_custkey), o_custkey AS customer FROM orders",
    "conform_merchant": f"WITH {CONFORMED} SELECT * FROM conformed",
    "filter_watermark_ts": f"SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'",
    "filter_watermark_param": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src WHERE install_date > TIMESTAMP '{EVENTS_MARK}'""",
    "filter_open_interval": f"WITH {INSTALLS_SRC} SELECT * FROM installs_src WHERE {WINDOW}",
    "filter_key_not_null": """
        SELECT * FROM (
          SELECT *, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS key FROM orders)
        WHERE key IS NOT NULL""",
    "gate_nonempty": f"""
        WITH {OFFERS_SRC}
        SELECT CAST(1 AS INTEGER) AS run, count(*) > 0 AS inserted, count(*) AS row_count,
               count(snapshot_date) AS value_count
        FROM offers_src WHERE snapshot_date IS NOT NULL
        UNION ALL
        SELECT CAST(2 AS INTEGER), count(*) > 0, count(*), count(snapshot_date)
        FROM offers_src WHERE snapshot_date > (SELECT max(snapshot_date) FROM offers_src)""",
    "agg_max_target": "SELECT max(o_orderdate) AS max_value FROM orders",
    "agg_max_partition": "SELECT max(CAST(ts AS DATE)) AS max_value FROM events",
    "agg_max_parsed_ts": """
        SELECT max(strptime(strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'), '%Y-%m-%dT%H:%M:%S')) AS as_text,
               max(l_shipdate) AS as_timestamp,
               max(CAST(CAST(l_shipdate AS DATE) AS TIMESTAMP)) AS as_date
        FROM lineitem""",
    "agg_row_count": f"""
        SELECT count(*) AS stored_rows, count(*) AS observed_rows
        FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'""",
    "agg_reconcile": f"""
        WITH {OFFERS_SRC}
        SELECT count(*) AS row_count, count(snapshot_date) AS value_count,
               max(snapshot_date) AS max_value, min(snapshot_date) AS min_value
        FROM offers_src""",
    "agg_missing_watermark": "SELECT count(*) AS row_count FROM orders WHERE o_orderstatus = 'P'",
    "agg_cast_losses": f"""
        WITH {MERCHANT_SRC}
        SELECT count(*) FILTER (WHERE TRY_CAST(mrch_activation_date AS DATE) IS NULL)
                 AS lost_mrch_activation_date,
               count(*) FILTER (WHERE TRY_CAST(mrch_show_pdp AS BOOLEAN) IS NULL) AS lost_mrch_show_pdp,
               count(*) FILTER (WHERE TRY_CAST(mrch_show_cc AS BOOLEAN) IS NULL) AS lost_mrch_show_cc,
               count(*) FILTER (WHERE TRY_CAST(mrch_integration_is_active AS BIGINT) IS NULL)
                 AS lost_mrch_integration_is_active,
               count(*) FILTER (WHERE TRY_CAST(mrch_main_category_key AS BIGINT) IS NULL)
                 AS lost_mrch_main_category_key,
               count(*) FILTER (WHERE TRY_CAST(mrch_sales_manager_key AS BIGINT) IS NULL)
                 AS lost_sales_manager_key
        FROM merchant_src""",
    "window_latest_hot_key": LATEST_HOT,
    "upsert_hot_key": LATEST_HOT,
    "upsert_rejects": """
        SELECT *, CAST(NULL AS BIGINT) AS key FROM orders WHERE o_orderstatus = 'P'""",
    "bounded_backup_hot_day": f"""
        WITH {INSTALLS_SRC},
        moved AS (
          SELECT * REPLACE (
            CASE WHEN event_id % 3 = 0 THEN DATE '{LOW_DAY}' ELSE install_date END AS install_date)
          FROM installs_src)
        SELECT * FROM moved WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY""",
    "bounded_backup_late_rows": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY""",
    "window_latest_per_key": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                     l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                     l_linestatus DESC) AS rn
          FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL)
        WHERE rn = 1""",
    "union_base_increment": f"""
        SELECT * EXCLUDE (o_orderpriority), CAST(NULL AS VARCHAR) AS o_orderpriority
        FROM orders WHERE o_orderdate <= TIMESTAMP '{ORDERS_MARK}'
        UNION ALL BY NAME
        SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'""",
    "scalar_date_key": """
        SELECT l_orderkey, l_linenumber,
               CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS BIGINT) AS date_key
        FROM lineitem""",
    "scalar_day_diff": f"""
        WITH {OFFERS_SRC}
        SELECT offer_id, item_id, CAST(snapshot_date - offer_delivery_date AS BIGINT) AS delivery_days,
               CAST(snapshot_date - DATE '1996-02-29' AS BIGINT) AS since_leap_day
        FROM offers_src""",
    "incremental_extract": f"""
        WITH {MERCHANT_SRC}
        SELECT * FROM merchant_src
        WHERE mt_update_dt > (
          SELECT max(mt_update_dt) FROM merchant_src WHERE mt_update_dt <= TIMESTAMP '{ORDERS_MARK}')""",
    "upsert_latest": LATEST_ORDER,
    "rebucket": LATEST_ORDER,
    "filter_watermark_text": f"SELECT * FROM events WHERE ts > TIMESTAMP '{EVENTS_MARK}'",
    "filter_interval_time_bound": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src
        WHERE install_date >= TIMESTAMP '2024-01-10 12:00:00' AND install_date < TIMESTAMP '2024-01-20 12:00:00'""",
    "project_cast_decimal_text": """
        SELECT o_orderkey, CASE o_orderkey % 3 WHEN 2 THEN NULL
            ELSE CAST(trunc(o_totalprice) AS BIGINT) * CASE o_orderkey % 3 WHEN 0 THEN -1 ELSE 1 END END AS price
        FROM orders""",
    "bounded_backup_partial_source": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY AND (
          install_date >= DATE '{EVENTS_MARK[:10]}' - INTERVAL 2 DAY AND install_date < DATE '{EVENTS_MARK[:10]}' - INTERVAL 1 DAY
          OR install_date >= DATE '{EVENTS_MARK[:10]}' - INTERVAL 1 DAY AND install_date < DATE '{EVENTS_MARK[:10]}' AND event_id % 5 = 0
          OR install_date >= DATE '{EVENTS_MARK[:10]}'
          OR install_date < DATE '{EVENTS_MARK[:10]}' - INTERVAL 2 DAY AND event_id % 5 <> 0)""",
    "merchant_sync": f"WITH {CONFORMED} {LATEST_MERCHANT}",
    "bounded_backup": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY""",
    "bounded_backup_adopted": f"""
        WITH {INSTALLS_SRC}
        SELECT * FROM installs_src WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY""",
    "staged_load": f"WITH {OFFERS_SRC} {TYPED_OFFERS}",
    "watermark_registry": f"""
        SELECT 'orders' AS table_name, '2' AS load_id, max(o_orderdate) AS watermark,
               count(*) AS row_count
        FROM orders WHERE o_orderdate > TIMESTAMP '{ORDERS_MARK}'
        UNION ALL
        SELECT 'events', '2', max(ts), count(*) FROM events WHERE ts > TIMESTAMP '{EVENTS_MARK}'""",
    **UPKEEP,
}
