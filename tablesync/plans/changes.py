"""Changes between two versions of a table, or between a table and a full snapshot of its source.

A change is a row with the column ``change``: the new row of a key that was inserted or updated,
the old row of one that was deleted. Both sides of the comparison lie by bucket, so the full
outer join that finds the changes exchanges neither; a snapshot is dealt into the buckets once.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.latest import last_of_each, latest, with_key, without_key
from tablesync.operators.mapping import quoted, union_rows
from tablesync.plans.upsert import stage
from tablesync.sources.files import drop_if_exists
from tablesync.sources.tables import overwrite, scan_parquet
from tablesync.sources.versions import BUCKET, Commit, VersionedTable, bucket_bitmaps, buckets_in

CHANGE = "change"
KINDS = INSERTED, UPDATED, DELETED = "inserted", "updated", "deleted"


@dataclass(frozen=True)
class SnapshotResult:
    """What a full snapshot changed. Rows without a key are set aside as rejects."""

    published: bool
    inserted: int = 0
    updated: int = 0
    deleted: int = 0
    rejected: int = 0
    touched_buckets: int = 0


def version_changes(table: VersionedTable, before: str, after: str, path: str) -> DataFrame:
    """Write the changes from one load's version to another's to ``path``; read them back.

    Both versions must still be held and have unique keys. Buckets that both take from the
    same load are not read. A column that only the older version has is not compared.
    """
    old, new = _version(table, before), _version(table, after)
    unlike = [b for b in {*old.buckets, *new.buckets} if old.buckets.get(b) != new.buckets.get(b)]
    session = table.bucket_session()
    with table.bucketed(old, unlike, session, _missing(old, new.schema)) as one, table.bucketed(new, unlike, session) as other:
        overwrite(compared(one, other, table.key, new.schema.names), path)
    return scan_parquet(table.spark, path, T.StructType([*new.schema.fields, T.StructField(CHANGE, T.StringType())]))


def compared(old: DataFrame, new: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The rows of ``new`` that are not alike in ``old``, and those of ``old`` whose key is gone.

    Keys are unique and not NULL. Inputs that are partitioned alike by the key are not exchanged.
    """
    if CHANGE in columns:
        raise ValueError(f"{CHANGE} tells what happened to a row and cannot be a column of the table")
    one, other = old.alias("old"), new.alias("new")
    same_key = [_of("old", k) == _of("new", k) for k in key]
    joined = one.join(other, _all(same_key), "full_outer")
    gone, fresh = _of("new", key[0]).isNull(), _of("old", key[0]).isNull()
    unlike = ~_all([_of("old", c).eqNullSafe(_of("new", c)) for c in columns if c not in key])
    change = F.when(gone, DELETED).when(fresh, INSERTED).when(unlike, UPDATED)
    return joined.select(
        *[F.when(gone, _of("old", c)).otherwise(_of("new", c)).alias(c) for c in columns], change.alias(CHANGE),
    ).where(F.col(CHANGE).isNotNull())


def apply_changes(table: VersionedTable, changes: DataFrame, load_id: str) -> Commit | None:
    """Publish a version with the changes applied: only the buckets they fall in are written.

    ``changes`` may come from another table with the same key. Without any, or if the load was
    committed before, nothing is published.
    """
    done = table.find(load_id)
    staging = f"{table.path}/staging/load_id={load_id}"
    if done is not None:
        drop_if_exists(table.spark, staging)
        return done
    seen = _write(table, with_key(changes, table.key), staging)
    commit = _publish(table, staging, changes.schema, load_id, seen)
    drop_if_exists(table.spark, staging)
    return commit


def upsert_full_snapshot(
    table: VersionedTable,
    snapshot: DataFrame,
    order: Sequence[str],
    load_id: str,
    ties: Sequence[str] | None = None,
    allow_empty: bool = False,
) -> SnapshotResult:
    """Make the table what a full snapshot of the source says, keys that it lacks retired.

    The snapshot is read once and its latest row per key dealt into the table's buckets, where
    it meets the table without a shuffle of it. Only buckets with changes are written. The
    changes stay under ``changes/load_id=<load>`` until ``retire``.

    A snapshot without a single key would retire everything: it is refused unless ``allow_empty``.
    A load that was committed before, or brings no change, publishes nothing.
    """
    staging, log = (f"{table.path}/{kind}/load_id={load_id}" for kind in ("staging", "changes"))
    if table.find(load_id) is not None:
        drop_if_exists(table.spark, staging)
        return SnapshotResult(False)
    staged, size = stage(table, snapshot, staging, None)
    if size["rejected"]:
        overwrite(without_key(staged, table.key), f"{table.path}/rejects/load_id={load_id}")
    before = table.current()
    if size["row_count"] == size["rejected"] and before is not None and not allow_empty:
        raise ValueError(f"{table.path}: the snapshot of load {load_id} has no keys; allow_empty retires every row")

    session = table.bucket_session()
    fresh = latest(scan_parquet(session, staging, snapshot.schema), table.key, order, ties)
    if before is None:
        found = fresh.withColumn(CHANGE, F.lit(INSERTED))
        seen = _write(table, found, log)
    elif before.unique_keys:
        with table.bucketed(before, range(table.n_buckets), session, _missing(before, snapshot.schema)) as base:
            seen = _write(table, compared(base, fresh, table.key, snapshot.columns), log)
    else:  # keys may repeat: the latest row of each stands for the table
        base = latest(table.read_version(before, session), table.key, order, ties)
        seen = _write(table, compared(base, fresh, table.key, snapshot.columns), log)
    schema = T.StructType([*snapshot.schema.fields, T.StructField(CHANGE, T.StringType())])
    commit = _publish(table, log, schema, load_id, seen, order, ties)
    drop_if_exists(table.spark, staging)
    return SnapshotResult(
        commit is not None, seen[INSERTED], seen[UPDATED], seen[DELETED], size["rejected"], len(seen["buckets"]))


def _write(table: VersionedTable, changes: DataFrame, path: str) -> dict:
    """Write changes, counted by kind and with the buckets they fall in."""
    seen = Observation()
    kinds = [F.count_if(F.col(CHANGE) == kind).alias(kind) for kind in KINDS]
    overwrite(changes.observe(seen, *kinds, *bucket_bitmaps(table.bucket_of(), table.n_buckets)), path)
    return {**seen.get, "buckets": buckets_in(seen.get)}


def _publish(
    table: VersionedTable,
    path: str,
    schema: T.StructType,
    load_id: str,
    seen: dict,
    order: Sequence[str] = (),
    ties: Sequence[str] | None = None,
) -> Commit | None:
    """The table with written changes merged into their buckets.

    ``order`` and ``ties`` choose the row of a key that a table with repeated keys has several of.
    """
    if not seen["buckets"]:
        return None
    before, session = table.current(), table.bucket_session()
    mark = schema[CHANGE]
    fresh = table.placed(latest(scan_parquet(session, path, schema), table.key, [CHANGE]))
    if before is None:
        return table.publish_placed(load_id, _kept(fresh), None, unique_keys=True)
    if not before.unique_keys:
        base = latest(table.read_version(before, session), table.key, order, ties)
        rows = last_of_each(union_rows(base.withColumn(CHANGE, F.lit(None).cast("string")), fresh.drop(BUCKET), True),
                            table.key, [CHANGE], [])
        return table.publish_placed(load_id, _kept(table.placed(rows)), before, unique_keys=True)
    new = [f for f in schema.fields if f.name not in before.schema.names and f.name != CHANGE]
    with table.bucketed(before, seen["buckets"], session, [*new, mark]) as base:
        rows = last_of_each(union_rows(base, fresh, True), table.key, [CHANGE], [])
        return table.publish_placed(load_id, _kept(rows), before, replaces=seen["buckets"], unique_keys=True)


def _kept(rows: DataFrame) -> DataFrame:
    """A row that the changes bring comes before the table's, which has none; deleted ones go."""
    return rows.where(F.col(CHANGE).isNull() | (F.col(CHANGE) != DELETED)).drop(CHANGE)


def _version(table: VersionedTable, load_id: str) -> Commit:
    commit = table.find(load_id)
    if commit is None:
        raise ValueError(f"{table.path}: no version of load {load_id} is held")
    if not commit.unique_keys:
        raise ValueError(f"{table.path}: keys of load {load_id} may repeat; the next upsert makes them unique")
    return commit


def _missing(held: Commit, schema: T.StructType) -> list[T.StructField]:
    """Fields that a version lacks, checking those it has."""
    types = {f.name: f.dataType.simpleString() for f in held.schema.fields}
    changed = [f.name for f in schema.fields if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if changed:
        raise TypeError(f"{changed} changed their types")
    return [f for f in schema.fields if f.name not in types]


def _of(side: str, name: str) -> Column:
    return F.col(f"{side}.`{name.replace('`', '``')}`")


def _all(tests: Collection[Column]) -> Column:
    whole = F.lit(True)
    for test in tests:
        whole &= test
    return whole
