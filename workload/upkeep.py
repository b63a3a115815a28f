"""Queries on keeping copies, versions and histories of a table right, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablesync.operators import increment
from tablesync.operators.content import differing_keys
from tablesync.plans import arrival, changes, history, installs, offers
from tablesync.plans.backfill import backfill, stored_ranges
from tablesync.plans.registry import Registry
from tablesync.plans.upsert import upsert_latest
from tablesync.session import scratch_dir
from tablesync.sources import catalogue, files, tables
from workload.queries import (
    AS_OF, EVENTS_MARK, ORDERS_EARLIER_MARK, ORDERS_MARK, SHIP_MARK, hot_orders, order_table, query, up_to,
)
from workload.standins import INSTALLS_SRC, OFFERS_SRC, TYPED_OFFERS, installs_src, offers_src, table

SQL: dict[str, str] = {}

LOST_DAYS = ("2024-01-05", "2024-01-12", "2024-01-13")
MOMENT = "1999-06-30"
LATE_ORDERS = "2001-07-22"
STATE = ["o_orderstatus", "o_orderpriority"]


def with_sql(sql: str):
    def named(build):
        SQL[build.__name__] = sql
        return query(build)

    return named


# A5: contents of two copies

COPY = """
copied AS (
    SELECT * REPLACE (CASE WHEN o_orderkey % 101 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice)
    FROM orders WHERE o_orderkey % 97 <> 0
    UNION ALL SELECT * FROM orders WHERE o_orderkey % 103 = 0 AND o_orderkey % 97 <> 0
    UNION ALL SELECT * REPLACE (o_orderkey + 1000000000 AS o_orderkey) FROM orders WHERE o_orderkey % 107 = 0)"""


@with_sql(f"""
    WITH {COPY}, s AS (
        SELECT o_orderkey, count(*) AS n, list(DISTINCT o_totalprice) AS p FROM orders GROUP BY o_orderkey),
    t AS (SELECT o_orderkey, count(*) AS n, count(*) FILTER (o_totalprice IS NULL) AS lost
        FROM copied GROUP BY o_orderkey)
    SELECT o_orderkey, coalesce(s.n, 0) AS rows_in_source, coalesce(t.n, 0) AS rows_in_sink,
        CASE WHEN t.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS difference
    FROM s FULL JOIN t USING (o_orderkey)
    WHERE s.n IS DISTINCT FROM t.n OR t.lost > 0""")
def reconcile_content(spark, sf_dir):
    """A copy with rows lost, values lost, rows repeated and rows made up: the keys it is wrong about."""
    path = scratch_dir(spark, "copy")
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    price = F.when(key % 101 != 0, F.col("o_totalprice"))
    tables.append(orders.where(key % 97 != 0).withColumn("o_totalprice", price), path)
    tables.append(orders.where((key % 103 == 0) & (key % 97 != 0)), path)
    tables.append(orders.where(key % 107 == 0).withColumn("o_orderkey", key + 1_000_000_000), path)
    return differing_keys(orders, tables.scan_parquet(spark, path, orders.schema), ["o_orderkey"])


@with_sql("""
    WITH keyed AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS key FROM orders),
    s AS (SELECT key, count(*) AS n FROM keyed GROUP BY key),
    t AS (SELECT key, count(*) AS n FROM keyed WHERE o_orderkey <> 3 GROUP BY key)
    SELECT key, s.n AS rows_in_source, coalesce(t.n, 0) AS rows_in_sink,
        CASE WHEN t.n IS NULL THEN 'missing' ELSE 'changed' END AS difference
    FROM s LEFT JOIN t USING (key) WHERE s.n IS DISTINCT FROM t.n""")
def reconcile_hot_key(spark, sf_dir):
    """One row is lost of a key that has a third of them."""
    orders = hot_orders(spark, sf_dir)
    return differing_keys(orders, orders.where("o_orderkey <> 3"), ["key"])


# C2: changes, deletes

LATEST_AT = """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_custkey IS NOT NULL AND {0}) WHERE rn = 1"""
BEFORE = LATEST_AT.format(f"o_orderdate <= TIMESTAMP '{ORDERS_MARK}'")
NOW = LATEST_AT.format("true")
SNAPSHOT = LATEST_AT.format("o_custkey % 7 <> 0")
CHANGED = """
    WITH old AS ({0}), new AS ({1})
    SELECT o_custkey, coalesce(new.o_orderkey, old.o_orderkey) AS o_orderkey,
        CASE WHEN new.o_orderkey IS NULL THEN 'deleted' WHEN old.o_orderkey IS NULL THEN 'inserted'
            ELSE 'updated' END AS change
    FROM old FULL JOIN new USING (o_custkey) WHERE old.o_orderkey IS DISTINCT FROM new.o_orderkey"""


def two_loads(spark, sf_dir, name):
    target = order_table(spark, sf_dir, name)
    source = table(spark, sf_dir, "orders")
    upsert_latest(target, up_to(source, "o_orderdate", ORDERS_MARK), ["o_orderdate"], "first", ties=["o_orderkey"])
    upsert_latest(target, increment.newer_than(source, "o_orderdate", ORDERS_MARK), ["o_orderdate"], "second",
                  ties=["o_orderkey"])
    return target


@with_sql(CHANGED.format(BEFORE, NOW))
def version_changes(spark, sf_dir):
    """What the second of two upserts changed."""
    target = two_loads(spark, sf_dir, "versions")
    found = changes.version_changes(target, "first", "second", scratch_dir(spark, "changes"))
    return found.select("o_custkey", "o_orderkey", "change")


@with_sql(NOW)
def apply_changes(spark, sf_dir):
    """A replica with other buckets that follows a table by its changes alone."""
    target = two_loads(spark, sf_dir, "versions")
    first = target.find("first")
    replica = order_table(spark, sf_dir, "replica")
    replica.n_buckets = target.n_buckets + 2
    upsert_latest(replica, target.read_version(first), ["o_orderdate"], "copied")
    found = changes.version_changes(target, "first", "second", scratch_dir(spark, "changes"))
    changes.apply_changes(replica, found, "followed")
    replica.retire()
    return replica.read()


def snapshots(spark, sf_dir, name):
    """A table of every customer's latest order, then a snapshot without a seventh of the customers."""
    target = order_table(spark, sf_dir, name)
    source = table(spark, sf_dir, "orders")
    upsert_latest(target, up_to(source, "o_orderdate", ORDERS_MARK), ["o_orderdate"], "first", ties=["o_orderkey"])
    changes.upsert_full_snapshot(target, source.where("o_custkey % 7 <> 0"), ["o_orderdate"], "full", ties=["o_orderkey"])
    return target


@with_sql(SNAPSHOT)
def upsert_full_snapshot(spark, sf_dir):
    target = snapshots(spark, sf_dir, "snapshot")
    target.retire()
    return target.read()


@with_sql(CHANGED.format(BEFORE, SNAPSHOT))
def snapshot_changes(spark, sf_dir):
    """The log of what the snapshot inserted, updated and retired."""
    target = snapshots(spark, sf_dir, "snapshot-log")
    return spark.read.parquet(f"{target.path}/changes/load_id=full").select("o_custkey", "o_orderkey", "change")


@with_sql("""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END AS key FROM orders)
        WHERE key IS NOT NULL AND key % 5 <> 1) WHERE rn = 1""")
def upsert_full_snapshot_hot_key(spark, sf_dir):
    """The same when one key has a third of both the table's source and the snapshot."""
    target = order_table(spark, sf_dir, "snapshot-hot", key="key")
    source = hot_orders(spark, sf_dir)
    upsert_latest(target, up_to(source, "o_orderdate", ORDERS_EARLIER_MARK), ["o_orderdate"], "first", ties=["o_orderkey"])
    changes.upsert_full_snapshot(target, source.where("key % 5 <> 1"), ["o_orderdate"], "full", ties=["o_orderkey"])
    return target.read()


# C2: history

VERSIONS = """
versions AS (
    SELECT key, o_orderstatus, o_orderpriority, o_orderdate,
        lag(o_orderdate) OVER w AS earlier, lag(o_orderstatus) OVER w AS status, lag(o_orderpriority) OVER w AS priority
    FROM (SELECT {0} AS key, o_orderdate, o_orderstatus, o_orderpriority, row_number() OVER (
            PARTITION BY {0}, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_custkey IS NOT NULL)
    WHERE rn = 1 WINDOW w AS (PARTITION BY key ORDER BY o_orderdate)),
history AS (
    SELECT key, o_orderstatus, o_orderpriority, o_orderdate AS valid_from,
        lead(o_orderdate) OVER (PARTITION BY key ORDER BY o_orderdate) AS valid_to
    FROM versions WHERE earlier IS NULL OR status IS DISTINCT FROM o_orderstatus
        OR priority IS DISTINCT FROM o_orderpriority)"""


def customer_history(spark, sf_dir, name):
    """Orders as versions of their customer: three loads, the late one first, one of them twice."""
    target = order_table(spark, sf_dir, name)
    source = table(spark, sf_dir, "orders")
    middle = increment.between(source, "o_orderdate", ORDERS_EARLIER_MARK, ORDERS_MARK, closed="high")
    loads = {
        "late": increment.newer_than(source, "o_orderdate", ORDERS_MARK),
        "early": up_to(source, "o_orderdate", ORDERS_EARLIER_MARK),
        "middle": middle,
        "again": middle,
    }
    for load_id, rows in loads.items():
        history.extend_history(target, rows, "o_orderdate", STATE, load_id, ties=["o_orderkey"])
    target.retire()
    return target.read()


@with_sql(f"WITH {VERSIONS.format('o_custkey')} SELECT key AS o_custkey, * EXCLUDE (key) FROM history")
def history_intervals(spark, sf_dir):
    return history.intervals(customer_history(spark, sf_dir, "history"))


@with_sql(f"""
    WITH {VERSIONS.format('o_custkey')} SELECT key AS o_custkey, o_orderstatus, o_orderpriority FROM history
    WHERE valid_from <= TIMESTAMP '{MOMENT}' AND (valid_to IS NULL OR valid_to > TIMESTAMP '{MOMENT}')""")
def history_as_of(spark, sf_dir):
    return history.as_of(customer_history(spark, sf_dir, "as-of"), MOMENT)


@with_sql(f"""
    WITH {VERSIONS.format('CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_custkey END')} SELECT * FROM history""")
def history_hot_key(spark, sf_dir):
    """A third of all versions are of one key."""
    target = order_table(spark, sf_dir, "history-hot", key="key")
    source = hot_orders(spark, sf_dir).where("o_custkey IS NOT NULL")
    for load_id, rows in (("first", up_to(source, "o_orderdate", ORDERS_MARK)), ("all", source)):
        history.extend_history(target, rows, "o_orderdate", STATE, load_id, ties=["o_orderkey"])
    return history.intervals(target.read())


# C3: gaps


def gappy_sink(spark, sf_dir, root):
    """A backup of which some days were lost."""
    source = installs_src(spark, sf_dir)
    registry = Registry(spark, f"{root}/registry")
    installs.backup_installs(source, f"{root}/sink", AS_OF, registry, "day-1", first_load=True)
    for day in LOST_DAYS:
        files.drop_if_exists(spark, f"{root}/sink/install_date={day}")
    return source, registry


@with_sql(f"""
    WITH {INSTALLS_SRC}
    SELECT * FROM installs_src WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY""")
def backup_gaps_filled(spark, sf_dir):
    root = scratch_dir(spark, "gaps")
    source, registry = gappy_sink(spark, sf_dir, root)
    for _ in range(2):
        backfill(source, f"{root}/sink", installs.DAY, registry, installs.NAME, "fill")
    return tables.scan_parquet(spark, f"{root}/sink", source.schema)


@with_sql(f"""
    WITH {INSTALLS_SRC}, days AS (
        SELECT DISTINCT install_date AS day FROM installs_src
        WHERE install_date < DATE '{AS_OF}' - INTERVAL 1 DAY
            AND CAST(install_date AS VARCHAR) NOT IN ({', '.join(f"'{d}'" for d in LOST_DAYS)})),
    runs AS (SELECT day, day - CAST(row_number() OVER (ORDER BY day) AS INTEGER) AS run FROM days),
    ranges AS (SELECT min(day) AS first_day, max(day) AS last_day, count(*) AS n_days FROM runs GROUP BY run)
    SELECT *, CAST(lead(first_day) OVER (ORDER BY first_day) - last_day - 1 AS BIGINT) AS gap_days FROM ranges""")
def backup_stored_ranges(spark, sf_dir):
    root = scratch_dir(spark, "ranges")
    source, _ = gappy_sink(spark, sf_dir, root)
    return stored_ranges(tables.scan_parquet(spark, f"{root}/sink", source.schema), installs.DAY)


# C4, K7: layout


@with_sql(f"""
    WITH {OFFERS_SRC} {TYPED_OFFERS} WHERE snapshot_date > DATE '{SHIP_MARK}' AND day(snapshot_date) = 1""")
def staged_load_by_day(spark, sf_dir):
    """Two loads of the offers target laid out by snapshot; the first days of months after the mark, by a join."""
    root = scratch_dir(spark, "offers-by-day")
    registry = Registry(spark, f"{root}/registry")
    load = offers.offers_load(root, by_day=True)
    source = offers_src(spark, sf_dir)
    load.run(up_to(source, "snapshot_date", SHIP_MARK), registry, "day-1", full_load=True)
    load.run(source, registry, "day-2")
    days = source.select(F.col("snapshot_date").alias("SnapshotDate")).where(
        (F.col("SnapshotDate") > F.lit(SHIP_MARK).cast("date")) & (F.dayofmonth("SnapshotDate") == 1)).distinct()
    return load.read(spark, registry).join(days, "SnapshotDate", "left_semi")


@with_sql("SELECT * EXCLUDE (o_orderpriority) FROM orders")
def drop_column_in_place(spark, sf_dir):
    """A column dropped by a control row alone."""
    target = order_table(spark, sf_dir, "drop-in-place", key="o_orderkey")
    target.publish("first", table(spark, sf_dir, "orders"))
    target.drop_columns("dropped", ["o_orderpriority"])
    return target.read()


@with_sql(f"""
    SELECT 'orders' AS table_name, CAST(count(DISTINCT CAST(o_orderdate AS DATE)) AS BIGINT) AS loads,
        max(o_orderdate) AS watermark, CAST(count(*) AS BIGINT) AS row_count
    FROM orders WHERE o_orderdate > TIMESTAMP '{LATE_ORDERS}'""")
def registry_history(spark, sf_dir):
    """A load for each of many days, recorded in order: the history after it was folded."""
    registry = Registry(spark, scratch_dir(spark, "registry-history"))
    fresh = increment.newer_than(table(spark, sf_dir, "orders"), "o_orderdate", LATE_ORDERS)
    days = fresh.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(
        F.max("o_orderdate").cast("string").alias("mark"), F.count(F.lit(1)).alias("n")).orderBy("day")
    for n, row in enumerate(days.collect()):
        registry.record("orders", f"{row['day']}", row["mark"], row["n"])
        if n == 5:
            registry.fold("orders")
    return registry.history().groupBy("table_name").agg(
        F.count(F.lit(1)).alias("loads"), F.max("watermark").alias("watermark"), F.sum("row_count").alias("row_count"))


# C1, K3: by arrival; K1, K4: tables of the catalogue


@with_sql(NOW)
def arrival_sync(spark, sf_dir):
    """Orders in two deliveries, the second with late ones that no watermark over dates would let in."""
    root = scratch_dir(spark, "arrival")
    source = table(spark, sf_dir, "orders")
    target = order_table(spark, sf_dir, "arrival-table")
    arrivals = arrival.Arrivals(f"{root}/source", source.schema, f"{root}/home")
    for load_id, rows in (("first", source.where("o_orderkey % 5 <> 0")), ("late", source.where("o_orderkey % 5 = 0"))):
        tables.append(rows, arrivals.source)
        arrival.sync_arrivals(arrivals, target, ["o_orderdate"], load_id, ties=["o_orderkey"])
    return target.read()


@with_sql("SELECT * FROM events")
def arrival_unique(spark, sf_dir):
    """Events of which most are delivered twice, a seventh of them only late."""
    root = scratch_dir(spark, "arrival-unique")
    source = table(spark, sf_dir, "events")
    arrivals = arrival.Arrivals(
        f"{root}/source", source.schema, f"{root}/home", unique=["event_id"], at="ts", within="60 days")
    for load_id, rows in (("first", source.where("event_id % 7 <> 0")), ("again", source)):
        tables.append(rows, arrivals.source)
        tables.append(arrivals.land(spark, load_id), f"{root}/unique")
        arrivals.done(spark, load_id)
    return tables.scan_parquet(spark, f"{root}/unique", source.schema)


@with_sql("SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 'late' ELSE 'first' END AS load_id FROM orders")
def catalogue_loads(spark, sf_dir):
    """Two loads in a table of the catalogue, one of them tried twice, with its columns in another order."""
    path = scratch_dir(spark, "catalogue")
    name = f"spark_catalog.default.tablesync_{path[-12:]}"
    source = table(spark, sf_dir, "orders")
    named = source.withColumn("load_id", F.lit(None).cast("string"))
    catalogue.create_table(named, name, path, ["load_id"])
    try:
        catalogue.publish_load(source.where("o_orderkey % 5 <> 0"), name, "first")
        late = source.where("o_orderkey % 5 = 0").select(*reversed(source.columns))
        for _ in range(2):
            catalogue.publish_load(late, name, "late")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return tables.scan_parquet(spark, path, named.schema)


@with_sql(f"""
    WITH {INSTALLS_SRC} SELECT * REPLACE (
        CASE WHEN install_date = DATE '{LOST_DAYS[0]}' THEN value + 1 ELSE value END AS value) FROM installs_src""")
def catalogue_partitions(spark, sf_dir):
    """Days appended to a table of the catalogue, and one of them replaced."""
    path = scratch_dir(spark, "catalogue-days")
    name = f"spark_catalog.default.tablesync_{path[-12:]}"
    source = installs_src(spark, sf_dir)
    catalogue.create_table(source, name, path, [installs.DAY])
    try:
        catalogue.append_table(tables.gathered(source, installs.DAY), name)
        day = source.where(F.col(installs.DAY) == F.lit(LOST_DAYS[0]).cast("date"))
        catalogue.replace_table_partitions(day.withColumn("value", F.col("value") + 1), name, installs.DAY)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return tables.scan_parquet(spark, path, source.schema)


# S2: predicates handed to sources of other formats


def handed_over(spark, sf_dir, source_format):
    path = scratch_dir(spark, f"events-{source_format}")
    tables.overwrite(table(spark, sf_dir, "events"), path, source_format)
    window = (F.col("ts") > F.lit(EVENTS_MARK).cast("timestamp_ntz")) & (F.col("event_type") == "error")
    return tables.scan_source(spark, source_format, path, predicate=window)


@with_sql(f"SELECT * FROM events WHERE ts > TIMESTAMP '{EVENTS_MARK}' AND event_type = 'error'")
def scan_pushed_filter_orc(spark, sf_dir):
    return handed_over(spark, sf_dir, "orc")
