"""Merchant dimension: newer rows, conformed, latest row per merchant."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablesync.functions.columns import prefixed_hex
from tablesync.operators.increment import extract_increment
from tablesync.operators.mapping import ColumnMap, MappedColumn
from tablesync.plans.upsert import UpsertResult, upsert_latest
from tablesync.sources.versions import VersionedTable

KEY = ["mrchID"]
UPDATED_AT = "mt_update_dt"

# The column names and types of the target table. Columns that keep both
# name and type have no entry.
RENAMED = {
    "mrch_id": "mrchID",
    "mrch_name": "mrchName",
    "mrch_full_name": "mrchFullName",
    "mrch_is_test": "mrch_is_test_mrch",
    "mrch_forgiveness_dt": "mrch_forgiveness_date",
    "mrch_delivery_order_section_enabled": "mrch_is_delivery_order_section_enabled",
    "mrch_last_feed_dt": "mrch_last_feed_date",
    "mrch_sales_manager_key": "sales_manager_key",
    "mrch_sales_manager_name": "sales_manager_name",
}
CAST = {
    "mrch_activation_date": "date",
    "mrch_show_pdp": "boolean",
    "mrch_show_cc": "boolean",
    "mrch_integration_is_active": "bigint",
    "mrch_main_category_key": "bigint",
    "mrch_sales_manager_key": "bigint",
}

RENAMES = [MappedColumn(source, target) for source, target in RENAMED.items() if source not in CAST]
CASTS = [MappedColumn(source, RENAMED.get(source), to_type, lenient=True) for source, to_type in CAST.items()]
HEX_KEY = MappedColumn("mrch_sid", using=prefixed_hex)

MERCHANT = ColumnMap(
    columns=[*RENAMES, *CASTS, HEX_KEY],
    derived={"update_date": lambda: F.col(UPDATED_AT).cast("date")},
)


def sync_merchants(
    source: DataFrame,
    table: VersionedTable,
    load_id: str,
    first_load: bool = False,
    overlap: str | None = None,
) -> UpsertResult:
    """One run: what is newer than the table, conformed and merged into it.

    The watermark is the one committed with the table's current version, so rows and
    watermark move together. The lenient casts are counted by the write that stages the
    increment; a load that was committed before stages nothing.
    """
    repeated = table.find(load_id) is not None
    version = table.current()
    watermark = version.watermark if version else None
    fresh = extract_increment(source, UPDATED_AT, watermark, first_load, overlap)
    losses = Observation()
    rows = MERCHANT.apply(fresh.observe(losses, *MERCHANT.cast_losses(fresh.schema)))
    result = upsert_latest(table, rows, [UPDATED_AT], load_id, watermark=UPDATED_AT)
    return result if repeated else replace(result, lost=losses.get)
