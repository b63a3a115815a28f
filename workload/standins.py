"""The tables the jobs work on, built from the test data, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The column names that the jobs' inputs must have.
def merchant_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "orders").select(
        c("o_orderkey").alias("mrch_key"),
        c("o_custkey").alias("mrch_id"),
        c("o_orderdate").alias("mt_update_dt"),
        c("o_orderpriority").cast("binary").alias("mrch_sid"),
        c("o_orderstatus").alias("mrch_name"),
        F.concat_ws("/", "o_orderstatus", "o_orderpriority").alias("mrch_full_name"),
        (c("o_orderstatus") == "F").alias("mrch_is_test"),
        c("o_orderdate").cast("string").alias("mrch_activation_date"),
        c("o_orderdate").alias("mrch_forgiveness_dt"),
        (c("o_orderkey") % 2).alias("mrch_show_pdp"),
        (c("o_custkey") % 2).cast("string").alias("mrch_show_cc"),
        (c("o_totalprice") > 100000).alias("mrch_delivery_order_section_enabled"),
        c("o_orderdate").cast("date").alias("mrch_last_feed_dt"),
        (c("o_orderstatus") == "O").alias("mrch_integration_is_active"),
        c("o_custkey").cast("string").alias("mrch_main_category_key"),
        F.when(c("o_orderstatus") == "F", c("o_custkey").cast("string"))
        .otherwise(c("o_orderpriority"))
        .alias("mrch_sales_manager_key"),
        c("o_orderpriority").alias("mrch_sales_manager_name"),
        c("o_totalprice").alias("mrch_rating"),
    )


MERCHANT_SRC = """
merchant_src AS (
  SELECT o_orderkey AS mrch_key, o_custkey AS mrch_id, o_orderdate AS mt_update_dt,
         encode(o_orderpriority) AS mrch_sid, o_orderstatus AS mrch_name,
         o_orderstatus || '/' || o_orderpriority AS mrch_full_name,
         o_orderstatus = 'F' AS mrch_is_test,
         strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS mrch_activation_date,
         o_orderdate AS mrch_forgiveness_dt, o_orderkey % 2 AS mrch_show_pdp,
         CAST(o_custkey % 2 AS VARCHAR) AS mrch_show_cc,
         o_totalprice > 100000 AS mrch_delivery_order_section_enabled,
         CAST(o_orderdate AS DATE) AS mrch_last_feed_dt,
         o_orderstatus = 'O' AS mrch_integration_is_active,
         CAST(o_custkey AS VARCHAR) AS mrch_main_category_key,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END
           AS mrch_sales_manager_key,
         o_orderpriority AS mrch_sales_manager_name, o_totalprice AS mrch_rating
  FROM orders)"""

CONFORMED = (
    MERCHANT_SRC
    + """,
conformed AS (
  SELECT mrch_key, mrch_id AS "mrchID", mt_update_dt, '0x' || hex(mrch_sid) AS mrch_sid,
         mrch_name AS "mrchName", mrch_full_name AS "mrchFullName",
         mrch_is_test AS mrch_is_test_mrch,
         TRY_CAST(mrch_activation_date AS DATE) AS mrch_activation_date,
         mrch_forgiveness_dt AS mrch_forgiveness_date,
         TRY_CAST(mrch_show_pdp AS BOOLEAN) AS mrch_show_pdp,
         TRY_CAST(mrch_show_cc AS BOOLEAN) AS mrch_show_cc,
         mrch_delivery_order_section_enabled AS mrch_is_delivery_order_section_enabled,
         mrch_last_feed_dt AS mrch_last_feed_date,
         TRY_CAST(mrch_integration_is_active AS BIGINT) AS mrch_integration_is_active,
         TRY_CAST(mrch_main_category_key AS BIGINT) AS mrch_main_category_key,
         TRY_CAST(mrch_sales_manager_key AS BIGINT) AS sales_manager_key,
         mrch_sales_manager_name AS sales_manager_name, mrch_rating,
         CAST(mt_update_dt AS DATE) AS update_date
  FROM merchant_src)"""
)


def installs_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("install_date", F.col("ts").cast("date"))


INSTALLS_SRC = "installs_src AS (SELECT *, CAST(ts AS DATE) AS install_date FROM events)"


def offers_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    snapshot = c("l_shipdate").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        snapshot.alias("snapshot_date"),
        c("l_suppkey").cast("string").alias("merchant_id"),
        c("l_partkey").alias("item_id"),
        c("l_extendedprice").alias("offer_price"),
        c("l_orderkey").cast("string").alias("offer_id"),
        (c("l_returnflag") == "R").alias("offer_is_favorite"),
        F.date_add(snapshot, c("l_quantity").cast("int")).alias("offer_delivery_date"),
    )


OFFERS_SRC = """
offers_src AS (
  SELECT CAST(l_shipdate AS DATE) AS snapshot_date, CAST(l_suppkey AS VARCHAR) AS merchant_id,
         l_partkey AS item_id, l_extendedprice AS offer_price,
         CAST(l_orderkey AS VARCHAR) AS offer_id, l_returnflag = 'R' AS offer_is_favorite,
         CAST(l_shipdate AS DATE) + CAST(trunc(l_quantity) AS INTEGER) AS offer_delivery_date
  FROM lineitem)"""

TYPED_OFFERS = """
  SELECT snapshot_date AS "SnapshotDate",
         CAST(year(snapshot_date) * 10000 + month(snapshot_date) * 100 + day(snapshot_date) AS BIGINT)
           AS "SnapshotDateKey",
         CAST(merchant_id AS BIGINT) AS "MerchantID", CAST(item_id AS VARCHAR) AS "ArticleNumber",
         CAST(offer_price AS DOUBLE) AS "Price", CAST(offer_id AS BIGINT) AS "OfferID",
         CAST(offer_is_favorite AS BIGINT) AS "IsFavorite", CAST(1 AS BIGINT) AS "IsOffer",
         CAST(snapshot_date - offer_delivery_date AS BIGINT) AS "DeliveryDays",
         offer_delivery_date AS delivery_date
  FROM offers_src"""
