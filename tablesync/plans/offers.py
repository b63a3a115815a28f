"""Offers: daily snapshots, staged and inserted into a typed target."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import date_key, day_diff, to_int64
from tablesync.operators.mapping import select_typed
from tablesync.plans.staged import StagedLoad

NAME = "offers"
SNAPSHOT = "snapshot_date"

# The target's columns, in order.
OFFERS_SCHEMA = T.StructType([
    T.StructField("SnapshotDate", T.DateType()),
    T.StructField("SnapshotDateKey", T.LongType()),
    T.StructField("MerchantID", T.LongType()),
    T.StructField("ArticleNumber", T.StringType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("OfferID", T.LongType()),
    T.StructField("IsFavorite", T.LongType()),
    T.StructField("IsOffer", T.LongType()),
    T.StructField("DeliveryDays", T.LongType()),
    T.StructField("delivery_date", T.DateType()),
])


def insert_offers(staged: DataFrame) -> DataFrame:
    """The target's columns from a staged snapshot. Bad input raises."""

    def whole(name: str):
        return to_int64(F.col(name), staged.schema[name].dataType)

    snapshot, delivery = F.col(SNAPSHOT), F.col("offer_delivery_date")
    values = [
        snapshot.cast("date"),
        date_key(snapshot),
        whole("merchant_id"),
        F.col("item_id").cast("string"),
        F.col("offer_price").cast("double"),
        whole("offer_id"),
        whole("offer_is_favorite"),
        F.lit(1).cast("bigint"),
        day_diff(snapshot, delivery),
        delivery.cast("date"),
    ]
    return select_typed(staged, values, OFFERS_SCHEMA)


def offers_load(root: str, by_day: bool = False) -> StagedLoad:
    """The load of the offers target; ``by_day`` lays it out by snapshot, so that reads of some days open no others."""
    return StagedLoad(
        name=NAME,
        target=f"{root}/target",
        staging=f"{root}/staging",
        column=SNAPSHOT,
        insert=insert_offers,
        target_schema=OFFERS_SCHEMA,
        day="SnapshotDate" if by_day else None,
    )
