"""One query per operator, over whole tables of the test data."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tablesync.functions.columns import date_key, day_diff, prefixed_hex
from tablesync.operators import increment, metrics
from tablesync.operators.latest import latest, with_key
from tablesync.operators.mapping import ColumnMap, MappedColumn, union_rows
from tablesync.plans import installs, merchant, offers
from tablesync.plans.backup import backup_window, last_stored
from tablesync.plans.registry import Registry
from tablesync.plans.upsert import upsert_latest as upsert
from tablesync.session import scratch_dir
from tablesync.sources import files, tables
from tablesync.sources.versions import VersionedTable, buckets_for
from workload.standins import installs_src, merchant_src, offers_src, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Points in time at which the stored tables were last brought up to date.
ORDERS_MARK = "2001-01-01 00:00:00"
ORDERS_EARLIER_MARK = "1998-01-01 00:00:00"
EVENTS_MARK = "2024-01-15 00:00:00"
LATE_MARK = "2024-01-15 12:00:00"
SHIP_MARK = "1998-06-01"
LOW_DAY, AS_OF = "2024-01-10", "2024-01-30"

LINEITEM_KEY = ["l_orderkey", "l_linenumber"]
LINEITEM_TIES = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"
]


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def up_to(df: DataFrame, column: str, point: str) -> DataFrame:
    """A source as it stood at an earlier point in time."""
    return df.where(F.col(column) <= F.lit(point).cast(df.schema[column].dataType))


def order_table(spark: SparkSession, sf_dir: str, name: str, key: str = "o_custkey") -> VersionedTable:
    """An empty table for rows of orders, sized by the orders file."""
    n_buckets = buckets_for(files.size_bytes(spark, f"{sf_dir}/orders.parquet"))
    return VersionedTable(spark, scratch_dir(spark, name), [key], n_buckets)


def hot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = F.col("o_orderkey") % 3 == 0
    return table(spark, sf_dir, "orders").withColumn("key", F.when(hot, F.lit(0)).otherwise(F.col("o_custkey")))


# scans


@query
def scan_parquet(spark, sf_dir):
    return tables.scan_parquet(spark, f"{sf_dir}/orders.parquet")


@query
def scan_pushed_filter(spark, sf_dir):
    day = F.col("ts").cast("date")
    window = (day > F.lit(LOW_DAY).cast("date")) & (day < increment.yesterday(AS_OF))
    return tables.scan_source(spark, "parquet", f"{sf_dir}/events.parquet", predicate=window)


# sinks


@query
def sink_append(spark, sf_dir):
    path = scratch_dir(spark, "append")
    source = table(spark, sf_dir, "orders")
    tables.append(up_to(source, "o_orderdate", ORDERS_MARK), path)
    tables.append(increment.newer_than(source, "o_orderdate", ORDERS_MARK), path)
    return tables.scan_parquet(spark, path, source.schema)


@query
def sink_overwrite_staging(spark, sf_dir):
    path = scratch_dir(spark, "staging")
    source = table(spark, sf_dir, "orders")
    tables.overwrite(source, path)
    tables.overwrite(increment.newer_than(source, "o_orderdate", ORDERS_MARK), path)
    return tables.scan_parquet(spark, path, source.schema)


@query
def sink_partitioned_append(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    source = installs_src(spark, sf_dir)
    tables.append_partitions(up_to(source, "ts", EVENTS_MARK), path, "install_date")
    tables.append_partitions(increment.newer_than(source, "ts", EVENTS_MARK), path, "install_date")
    return spark.read.parquet(path)


@query
def insert_select_typed(spark, sf_dir):
    return offers.insert_offers(offers_src(spark, sf_dir))


@query
def replace_from_self(spark, sf_dir):
    target = order_table(spark, sf_dir, "replace")
    target.publish("first", table(spark, sf_dir, "orders"))
    target.replace("deduplicated", partial(latest, key=["o_custkey"], order=["o_orderdate"], ties=["o_orderkey"]))
    target.retire()
    return target.read()


@query
def drop_if_exists(spark, sf_dir):
    path = scratch_dir(spark, "drop")
    source = table(spark, sf_dir, "orders")
    tables.overwrite(source, path)
    stored = metrics.row_count(tables.scan_parquet(spark, path, source.schema)).first()[0]
    dropped, again = files.drop_if_exists(spark, path), files.drop_if_exists(spark, path)
    left = tables.scan_parquet(spark, path, source.schema)
    return metrics.row_count(left, "rows_after").select(
        F.lit(stored).cast("bigint").alias("rows_before"),
        F.lit(dropped).alias("dropped"),
        F.lit(again).alias("dropped_again"),
        "rows_after",
    )


@query
def drop_column(spark, sf_dir):
    target = order_table(spark, sf_dir, "drop-column", key="o_orderkey")
    source = table(spark, sf_dir, "orders").withColumn("rn", F.col("o_orderkey") + F.col("o_custkey"))
    target.publish("first", source)
    target.replace("dropped", lambda df: df.drop("rn"), row_by_row=True)
    return target.read()


# projections


@query
def project_rename(spark, sf_dir):
    """All nine renames over the whole row; nothing is cast."""
    renames = [MappedColumn(source, target) for source, target in merchant.RENAMED.items()]
    return ColumnMap(renames).apply(merchant_src(spark, sf_dir))


@query
def project_cast(spark, sf_dir):
    keyed = [MappedColumn("mrch_key"), *merchant.CASTS]
    return ColumnMap(keyed, passthrough=False).apply(merchant_src(spark, sf_dir))


@query
def project_hex_key(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        prefixed_hex(F.col("o_orderpriority").cast("binary")).alias("from_binary"),
        prefixed_hex(F.col("o_orderpriority")).alias("from_text"),
        prefixed_hex(F.col("o_custkey")).alias("from_number"),
        prefixed_hex(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey"))).alias("from_null"),
    )


@query
def project_derived_date(spark, sf_dir):
    added = ColumnMap(derived={"update_date": lambda: F.col("o_orderdate").cast("date")})
    return added.apply(table(spark, sf_dir, "orders"))


@query
def project_constant(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.lit(1).cast("bigint").alias("IsOffer")
    )


@query
def project_passthrough(spark, sf_dir):
    mapping = ColumnMap([
        MappedColumn("o_custkey", "customer"),
        MappedColumn("no_such_column", "ignored"),
    ])
    return mapping.apply(table(spark, sf_dir, "orders"))


@query
def conform_merchant(spark, sf_dir):
    return merchant.MERCHANT.apply(merchant_src(spark, sf_dir))


# filters


@query
def filter_watermark_ts(spark, sf_dir):
    return increment.newer_than(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_MARK)


@query
def filter_watermark_param(spark, sf_dir):
    """A date column against a timestamp, the column being a partition of the table."""
    path = scratch_dir(spark, "partitioned")
    tables.append_partitions(installs_src(spark, sf_dir), path, "install_date")
    return increment.newer_than(spark.read.parquet(path), "install_date", EVENTS_MARK)


@query
def filter_open_interval(spark, sf_dir):
    source = installs_src(spark, sf_dir)
    return increment.between(source, "install_date", LOW_DAY, increment.yesterday(AS_OF))


@query
def filter_key_not_null(spark, sf_dir):
    keyed = table(spark, sf_dir, "orders").withColumn(
        "key", F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    )
    return with_key(keyed, ["key"])


@query
def gate_nonempty(spark, sf_dir):
    """Two runs over the same source: the second finds nothing newer and inserts nothing."""
    root = scratch_dir(spark, "gate")
    registry = Registry(spark, f"{root}/registry")
    load = offers.offers_load(f"{root}/offers")
    source = offers_src(spark, sf_dir)
    runs = [load.run(source, registry, f"run-{n}", full_load=True) for n in (1, 2)]
    return spark.createDataFrame(
        [(n, r.inserted, r.row_count, r.value_count) for n, r in enumerate(runs, 1)],
        "run int, inserted boolean, row_count bigint, value_count bigint",
    )


# aggregations


@query
def agg_max_target(spark, sf_dir):
    """Of a target that was written, as the jobs read it back."""
    source = merchant_src(spark, sf_dir)
    path = scratch_dir(spark, "target")
    tables.overwrite(source, path)
    return metrics.max_value(tables.scan_parquet(spark, path, source.schema), "mt_update_dt")


@query
def agg_max_partition(spark, sf_dir):
    path = scratch_dir(spark, "partitioned")
    tables.append_partitions(installs_src(spark, sf_dir), path, "install_date")
    return metrics.max_value(spark.read.parquet(path), "install_date")


@query
def agg_max_parsed_ts(spark, sf_dir):
    """The same maximum from text, from a timestamp and from a date."""
    source = table(spark, sf_dir, "lineitem").select(
        F.date_format("l_shipdate", metrics.ISO_SECONDS).alias("as_text"),
        F.col("l_shipdate").alias("as_timestamp"),
        F.col("l_shipdate").cast("date").alias("as_date"),
    )
    return source.agg(*[
        metrics.latest_timestamp(source, name).cast("timestamp_ntz").alias(name) for name in source.columns
    ])


@query
def agg_row_count(spark, sf_dir):
    """Rows counted by the write itself, next to a count of what was written."""
    path = scratch_dir(spark, "count")
    source = increment.newer_than(table(spark, sf_dir, "orders"), "o_orderdate", ORDERS_MARK)
    seen = Observation()
    tables.append(source.observe(seen, F.count(F.lit(1)).alias("row_count")), path)
    stored = metrics.row_count(tables.scan_parquet(spark, path, source.schema), "stored_rows")
    return stored.withColumn("observed_rows", F.lit(seen.get["row_count"]).cast("bigint"))


@query
def agg_reconcile(spark, sf_dir):
    return metrics.reconcile(offers_src(spark, sf_dir), "snapshot_date")


@query
def agg_missing_watermark(spark, sf_dir):
    """Rows that no watermark on the column can ever load."""
    source = table(spark, sf_dir, "orders").withColumn(
        "updated", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate"))
    )
    return metrics.missing_values(source, "updated")


@query
def agg_cast_losses(spark, sf_dir):
    """Values that lenient casts turned into NULL, counted by the write that casts them."""
    path = scratch_dir(spark, "losses")
    source = merchant_src(spark, sf_dir)
    seen = Observation()
    losses = merchant.MERCHANT.cast_losses(source.schema)
    tables.overwrite(merchant.MERCHANT.apply(source.observe(seen, *losses)), path)
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in seen.get.items()])


# latest per key


@query
def window_latest_per_key(spark, sf_dir):
    return latest(table(spark, sf_dir, "lineitem"), LINEITEM_KEY, ["l_shipdate"], LINEITEM_TIES)


@query
def window_latest_hot_key(spark, sf_dir):
    """The same when a third of all rows share one key."""
    return latest(hot_orders(spark, sf_dir), ["key"], ["o_orderdate"], ["o_orderkey"])


@query
def union_base_increment(spark, sf_dir):
    source = table(spark, sf_dir, "orders")
    base = up_to(source, "o_orderdate", ORDERS_MARK).drop("o_orderpriority")
    fresh = increment.newer_than(source, "o_orderdate", ORDERS_MARK)
    return union_rows(base, fresh, allow_new_columns=True)


# scalar functions


@query
def scalar_date_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        *LINEITEM_KEY, date_key(F.col("l_shipdate")).alias("date_key")
    )


@query
def scalar_day_diff(spark, sf_dir):
    return offers_src(spark, sf_dir).select(
        "offer_id",
        "item_id",
        day_diff(F.col("snapshot_date"), F.col("offer_delivery_date")).alias("delivery_days"),
        day_diff(F.col("snapshot_date"), F.lit("1996-02-29")).alias("since_leap_day"),
    )


# composite jobs


@query
def incremental_extract(spark, sf_dir):
    """Newer than the watermark that the registry holds for the table."""
    registry = Registry(spark, scratch_dir(spark, "registry"))
    source = merchant_src(spark, sf_dir)
    stored = up_to(source, "mt_update_dt", ORDERS_MARK)
    last = metrics.reconcile(stored, "mt_update_dt").select(F.col("max_value").cast("string"), "row_count").first()
    registry.record("merchants", "stored", *last)
    return increment.extract_increment(source, "mt_update_dt", registry.watermark("merchants"))


@query
def upsert_latest(spark, sf_dir):
    """Three loads, and one of them again, merged into the latest order per customer."""
    target = order_table(spark, sf_dir, "upsert")
    source = table(spark, sf_dir, "orders")
    steps = [
        ("first", up_to(source, "o_orderdate", ORDERS_EARLIER_MARK)),
        ("second", increment.between(source, "o_orderdate", ORDERS_EARLIER_MARK, ORDERS_MARK, closed="high")),
        ("third", increment.newer_than(source, "o_orderdate", ORDERS_MARK)),
        ("second", increment.between(source, "o_orderdate", ORDERS_EARLIER_MARK, ORDERS_MARK, closed="high")),
    ]
    for load_id, rows in steps:
        upsert(target, rows, ["o_orderdate"], load_id, watermark="o_orderdate", ties=["o_orderkey"])
    target.retire()
    return target.read()


@query
def rebucket(spark, sf_dir):
    """Two loads, the table dealt into more buckets, and a third load."""
    target = order_table(spark, sf_dir, "rebucket")
    source = table(spark, sf_dir, "orders")
    target.publish("first", up_to(source, "o_orderdate", ORDERS_EARLIER_MARK))
    second = increment.between(source, "o_orderdate", ORDERS_EARLIER_MARK, ORDERS_MARK, closed="high")
    upsert(target, second, ["o_orderdate"], "second", ties=["o_orderkey"])
    target = target.rebucket("wider", 2 * target.n_buckets + 3)
    third = increment.newer_than(source, "o_orderdate", ORDERS_MARK)
    upsert(target, third, ["o_orderdate"], "third", ties=["o_orderkey"])
    target.retire()
    return target.read()


@query
def filter_watermark_text(spark, sf_dir):
    """Newer than a watermark by text that is partly local time with its offset."""
    local = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL 3 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+03:00"))
    utc = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    source = table(spark, sf_dir, "events").withColumn("at", F.when(F.col("event_id") % 2 == 0, local).otherwise(utc))
    return increment.newer_than(source, "at", EVENTS_MARK).drop("at")


@query
def filter_interval_time_bound(spark, sf_dir):
    """Days between bounds that have a time of day."""
    return increment.between(
        installs_src(spark, sf_dir), "install_date", "2024-01-10 12:00:00", "2024-01-20 12:00:00", closed="low")


@query
def project_cast_decimal_text(spark, sf_dir):
    """Numbers in text, with fractions and signs, as bigint: the fraction is cut off."""
    price = F.col("o_totalprice").cast("decimal(20,2)")
    text = F.when(F.col("o_orderkey") % 3 == 0, (-price).cast("string")).when(
        F.col("o_orderkey") % 3 == 1, price.cast("string")).otherwise(F.col("o_orderpriority"))
    source = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("price"))
    return ColumnMap([MappedColumn("price", cast="bigint", lenient=True)]).apply(source)


@query
def upsert_hot_key(spark, sf_dir):
    """Two loads in each of which one key has a third of the rows."""
    target = order_table(spark, sf_dir, "upsert-hot", key="key")
    source = hot_orders(spark, sf_dir)
    for load_id, rows in (
        ("first", up_to(source, "o_orderdate", ORDERS_MARK)),
        ("second", increment.newer_than(source, "o_orderdate", ORDERS_MARK)),
    ):
        upsert(target, rows, ["o_orderdate"], load_id, watermark="o_orderdate", ties=["o_orderkey"])
    return target.read()


@query
def upsert_rejects(spark, sf_dir):
    """Rows without a key, as an upsert sets them aside."""
    target = order_table(spark, sf_dir, "rejects", key="key")
    source = table(spark, sf_dir, "orders").withColumn(
        "key", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )
    upsert(target, source, ["o_orderdate"], "first")
    return spark.read.parquet(f"{target.path}/rejects/load_id=first")


@query
def merchant_sync(spark, sf_dir):
    """The merchant job, run when the source stood at the mark and run again now."""
    source = merchant_src(spark, sf_dir)
    target = order_table(spark, sf_dir, "merchants", merchant.KEY[0])
    merchant.sync_merchants(up_to(source, merchant.UPDATED_AT, ORDERS_MARK), target, "day-1", first_load=True)
    merchant.sync_merchants(source, target, "day-2")
    target.retire()
    return target.read()


@query
def bounded_backup_partial_source(spark, sf_dir):
    """The last stored day is read again from a source that shows only its late rows."""
    root = scratch_dir(spark, "backup-partial")
    registry = Registry(spark, f"{root}/registry")
    source = installs_src(spark, sf_dir)
    late = F.col("event_id") % 5 == 0
    installs.backup_installs(source.where(~late), f"{root}/sink", EVENTS_MARK[:10], registry, "day-1", first_load=True)
    shown = source.where(late | (F.col("install_date") >= F.lit(EVENTS_MARK[:10]).cast("date")))
    installs.backup_installs(shown, f"{root}/sink", AS_OF, registry, "day-2", closed="low")
    return tables.scan_parquet(spark, f"{root}/sink", source.schema)


@query
def bounded_backup(spark, sf_dir):
    """The installs job on two days, the second run twice."""
    root = scratch_dir(spark, "backup")
    registry = Registry(spark, f"{root}/registry")
    source = installs_src(spark, sf_dir)
    installs.backup_installs(source, f"{root}/sink", EVENTS_MARK[:10], registry, "day-1", first_load=True)
    for _ in range(2):
        installs.backup_installs(source, f"{root}/sink", AS_OF, registry, "day-2")
    return spark.read.parquet(f"{root}/sink")


@query
def bounded_backup_adopted(spark, sf_dir):
    """The installs job continuing a sink that was filled before there was a registry."""
    root = scratch_dir(spark, "adopt")
    source = installs_src(spark, sf_dir)
    sink = f"{root}/sink"
    tables.append_partitions(up_to(source, "install_date", LOW_DAY), sink, "install_date")
    low = last_stored(spark.read.parquet(sink), "install_date")
    installs.backup_installs(source, sink, AS_OF, Registry(spark, f"{root}/registry"), "day-1", low=low)
    return spark.read.parquet(sink)


@query
def bounded_backup_hot_day(spark, sf_dir):
    """A backup in which one day has a third of the rows and more."""
    root = scratch_dir(spark, "backup-hot")
    day = F.when(F.col("event_id") % 3 == 0, F.lit(LOW_DAY).cast("date")).otherwise(F.col("install_date"))
    source = installs_src(spark, sf_dir).withColumn("install_date", day)
    registry = Registry(spark, f"{root}/registry")
    installs.backup_installs(source, f"{root}/sink", AS_OF, registry, "day-1", first_load=True)
    return spark.read.parquet(f"{root}/sink")


@query
def bounded_backup_late_rows(spark, sf_dir):
    """Rows of the last stored day that came after its backup, read by a closed bound."""
    root = scratch_dir(spark, "backup-late")
    source = installs_src(spark, sf_dir)
    stood = up_to(source, "ts", LATE_MARK)
    registry = Registry(spark, f"{root}/registry")
    for load_id, rows in (("day-1", stood), ("day-2", source)):
        backup_window(
            rows, f"{root}/sink", "install_date", AS_OF, registry, "late", load_id,
            first_load=True, closed="low",
        )
    return spark.read.parquet(f"{root}/sink")


@query
def staged_load(spark, sf_dir):
    """The offers job when the source stood at the mark, now, and now once more."""
    root = scratch_dir(spark, "offers")
    registry = Registry(spark, f"{root}/registry")
    load = offers.offers_load(root)
    source = offers_src(spark, sf_dir)
    load.run(up_to(source, "snapshot_date", SHIP_MARK), registry, "day-1", full_load=True)
    for _ in range(2):
        load.run(source, registry, "day-2")
    return load.read(spark, registry)


@query
def watermark_registry(spark, sf_dir):
    """Two loads recorded for each table, as measured on the tables; the current rows."""
    registry = Registry(spark, scratch_dir(spark, "registry"))
    marks = {"orders": ("o_orderdate", ORDERS_MARK), "events": ("ts", EVENTS_MARK)}
    for name, (column, mark) in marks.items():
        source = table(spark, sf_dir, name)
        for load_id, rows in (("1", up_to(source, column, mark)), ("2", increment.newer_than(source, column, mark))):
            highest, count = metrics.reconcile(rows, column).select(
                F.col("max_value").cast("string"), "row_count"
            ).first()
            registry.record(name, load_id, highest, count)
    return registry.current().drop("committed_at")
