"""A Parquet table that is replaced by publishing a new version next to the old one.

Plain Parquet cannot be overwritten by a query that reads it, and has no atomic replace.
So the rows of a load go to directories of their own,

    data/load_id=<load>/bucket=<n>/*.parquet

and one control row, written last as a single file, says which load holds each bucket:

    commits/load_id=<load>/

Readers follow the row with the highest sequence number. A job that dies before that row
is written leaves the table as it was, and repeating a committed load changes nothing.
One writer at a time is assumed; two rows with the same number are reported.

The files are written by Spark's bucketed writer. A bucket directory holds the files of
the bucket of the same number, and ``bucketed`` gives a reader a table that Spark knows to
be hash-partitioned by the key, so that merging into it does not shuffle it.
"""

from __future__ import annotations

import json
import math
import re
import uuid
from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.mapping import quoted
from tablesync.sources.files import (
    LOAD, directories, drop_if_exists, drop_other_loads, drop_others, exists, loads_in,
)
from tablesync.sources.tables import empty, gathered, one_row, scan_parquet

BUCKET, LOAD_ID = "bucket", LOAD.removesuffix("=")
#: Buckets of a load that a reader is given one by one.
FEW_BUCKETS = 32
#: A task handles a bucket whole, so tables aim at buckets of this many bytes on disk, up to this many of them.
BUCKET_BYTES, MANY_BUCKETS = 4 << 20, 10_000
#: How much of an increment a task reads to deal it to the buckets.
SPLIT_BYTES = 16 << 20
#: Bits of Spark's bitmap aggregates.
BITMAP = 32768
MANAGE_PARTITIONS = "spark.sql.hive.manageFilesourcePartitions"

COMMIT_SCHEMA = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("key", T.ArrayType(T.StringType())),
    T.StructField("n_buckets", T.IntegerType()),
    T.StructField("buckets", T.StringType()),
    T.StructField("columns", T.StringType()),
    T.StructField("watermark", T.TimestampNTZType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("unique_keys", T.BooleanType()),
    T.StructField("committed_at", T.TimestampType()),
    T.StructField("dropped", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class Commit:
    """One version. ``buckets`` maps a bucket to the load that holds its rows;
    ``unique_keys`` tells that no two rows share a key and none lacks one; ``dropped``
    are columns that files still hold and no reader sees."""

    load_id: str
    seq: int
    buckets: dict[int, str]
    schema: T.StructType
    watermark: str | None
    row_count: int
    unique_keys: bool
    dropped: tuple[str, ...] = ()


class VersionedTable:
    """``key`` and ``n_buckets`` are fixed by the first version; ``rebucket`` changes the number.

    ``database`` is where Spark's catalogue holds the passing tables of a load; ``retire``
    drops those that a killed driver has left there.
    """

    def __init__(
        self, spark: SparkSession, path: str, key: Sequence[str], n_buckets: int,
        database: str = "spark_catalog.default",
    ) -> None:
        most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        if not 1 <= n_buckets <= most:
            raise ValueError(f"{n_buckets} buckets: spark.sql.sources.bucketing.maxBuckets allows 1 to {most}")
        self.database = database
        self.spark = spark
        self.path = path.rstrip("/")
        self.key = list(key)
        self.n_buckets = n_buckets

    # control rows

    def commits(self) -> DataFrame:
        return scan_parquet(self.spark, f"{self.path}/commits", COMMIT_SCHEMA)

    def current(self) -> Commit | None:
        if not exists(self.spark, f"{self.path}/commits"):
            return None
        # the number first: the rows of a long history are large together
        newest = self.commits().select("seq").orderBy(F.desc("seq")).first()
        if newest is None:
            return None
        rows = _as_text(self.commits().where(F.col("seq") == newest["seq"])).take(2)
        if len(rows) > 1:
            loads = [row["load_id"] for row in rows]
            raise RuntimeError(f"{self.path}: loads {loads} were committed at the same time")
        return self._commit(rows[0])

    def find(self, load_id: str) -> Commit | None:
        """The version a load published, if it did."""
        check_name(load_id)
        if not exists(self.spark, f"{self.path}/commits/load_id={load_id}"):
            return None
        rows = _as_text(self.commits().where(F.col("load_id") == load_id)).take(1)
        return self._commit(rows[0]) if rows else None

    # rows

    def read(self) -> DataFrame:
        commit = self.current()
        if commit is None:
            raise ValueError(f"{self.path}: nothing has been published")
        return self.read_version(commit)

    def read_version(self, commit: Commit, session: SparkSession | None = None) -> DataFrame:
        session = session or self.spark
        if not commit.buckets:
            return empty(session, commit.schema)
        data, paths, superseded = f"{self.path}/data", [], F.lit(False)
        for load, used in _by_load(commit.buckets).items():
            if len(used) <= FEW_BUCKETS:
                paths += [self._directory(load, bucket) for bucket in used]
                continue
            # one path for them all; the directories that later loads have replaced are pruned
            root = f"{data}/{LOAD}{load}"
            others = {int(b) for b in directories(self.spark, root, f"{BUCKET}=")}.difference(used)
            paths.append(root)
            if others:
                superseded |= (F.col(LOAD_ID) == load) & F.col(BUCKET).isin(sorted(others))
        named = T.StructType([*commit.schema.fields, T.StructField(LOAD_ID, T.StringType()), T.StructField(BUCKET, T.IntegerType())])
        rows = session.read.schema(named).option("basePath", data).parquet(*paths)
        return rows.where(~superseded).select(*[quoted(c) for c in commit.schema.names])

    @contextmanager
    def bucketed(
        self,
        commit: Commit,
        buckets: Collection[int],
        session: SparkSession | None = None,
        new_columns: Sequence[T.StructField] = (),
    ) -> Iterator[DataFrame]:
        """Some buckets of a version, hash-partitioned by the key without a shuffle.

        Spark takes a bucket layout only from its catalogue, so the directories are
        registered as an external table while the block runs. Dropping it leaves the
        files alone. A bucket is read by one task, so its keys should be unique.

        The rows carry their bucket number, and NULL in ``new_columns``. A projection
        before a union would make Spark lose sight of the partitioning.
        """
        _check_dropped(commit.dropped, [f.name for f in new_columns], self.path)
        session = session or self.spark
        name = self._passing_name()
        fields = [*commit.schema.fields, *new_columns]
        columns = ", ".join(f"{quote(f.name)} {ddl(f.dataType)}" for f in fields)
        keys = ", ".join(quote(k) for k in self.key)
        session.sql(
            f"CREATE TABLE {name} ({columns}, {BUCKET} INT) USING parquet PARTITIONED BY ({BUCKET}) "
            f"CLUSTERED BY ({keys}) INTO {self.n_buckets} BUCKETS LOCATION {literal(f'{self.path}/data')}"
        )
        try:
            present = sorted(set(buckets) & set(commit.buckets))
            for start in range(0, len(present), 1000):
                parts = " ".join(
                    f"PARTITION ({BUCKET}={b}) LOCATION {literal(self._directory(commit.buckets[b], b))}"
                    for b in present[start:start + 1000]
                )
                session.sql(f"ALTER TABLE {name} ADD {parts}")
            yield session.table(name)
        finally:
            session.sql(f"DROP TABLE IF EXISTS {name}")

    def bucket_session(self) -> SparkSession:
        """A session like the table's own whose shuffles fall into the table's buckets.

        With as many shuffle partitions as buckets, and these left alone at run time,
        rows that were shuffled by the key already lie where the table keeps them. A task
        then writes one bucket and may keep its file open, rather than sort by bucket. Files that
        are not buckets are read in small pieces, as a task sorts what it sends to the buckets.
        """
        session = self.spark.newSession()
        for name, value in self.spark.conf.getAll.items():
            if session.conf.isModifiable(name):
                session.conf.set(name, value)
        session.conf.set("spark.sql.shuffle.partitions", self.n_buckets)
        session.conf.set("spark.sql.adaptive.enabled", False)
        session.conf.set("spark.sql.maxConcurrentOutputFileWriters", 4)
        session.conf.set("spark.sql.files.maxPartitionBytes", SPLIT_BYTES)
        session.conf.set(MANAGE_PARTITIONS, True)
        return session

    def bucket_of(self) -> Column:
        """Spark's own bucket number: Murmur3 of the key, as in ``bucketBy``."""
        return F.pmod(F.hash(*[quoted(k) for k in self.key]), F.lit(self.n_buckets))

    def placed(self, df: DataFrame) -> DataFrame:
        """Rows with their bucket number, which names a directory and is no column of the table."""
        clashes = sorted({BUCKET, "load_id"} & {name.lower() for name in df.columns})
        if clashes:
            raise ValueError(f"{clashes} are directories of the table and cannot be columns")
        return df.withColumn(BUCKET, self.bucket_of())

    # publishing

    def publish(self, load_id: str, rows: DataFrame, watermark: str | None = None) -> Commit:
        """Make ``rows`` the table, and ``watermark`` its watermark: none, unless one is given."""
        done = self.find(load_id)
        if done is not None:
            return done
        rows = gathered(self.placed(rows), BUCKET)
        return self.publish_placed(load_id, rows, self.current(), watermark=watermark, keep_watermark=False)

    def rebucket(self, load_id: str, n_buckets: int) -> VersionedTable:
        """The same rows in another number of buckets: one shuffle, one version.

        Returns the table as it is from then on; this object can no longer read it.
        """
        table = VersionedTable(self.spark, self.path, self.key, n_buckets, self.database)
        if exists(self.spark, f"{self.path}/commits/load_id={check_name(load_id)}") and table.find(load_id):
            return table
        before = self.current()
        if before is None:
            raise ValueError(f"{self.path}: nothing has been published")
        rows = gathered(table.placed(self.read_version(before)), BUCKET)
        table.publish_placed(load_id, rows, before, unique_keys=before.unique_keys)
        return table

    def replace(self, load_id: str, change: Callable[[DataFrame], DataFrame], row_by_row: bool = False) -> Commit:
        """Replace the table by a query over itself.

        A change that is ``row_by_row`` and keeps the key, such as dropping a column,
        needs no shuffle: rows are written to the bucket they were read from.
        """
        done = self.find(load_id)
        if done is not None:
            return done
        before = self.current()
        if before is None:
            raise ValueError(f"{self.path}: nothing has been published")
        rows = self.placed(change(self.read_version(before)))
        return self.publish_placed(
            load_id,
            rows if row_by_row else gathered(rows, BUCKET),
            before,
            unique_keys=row_by_row and before.unique_keys,
        )

    def drop_columns(self, load_id: str, names: Collection[str]) -> Commit:
        """Drop columns without reading or writing a row: one control row with a smaller schema.

        Files keep the values until their bucket is written again. A column of the same name can
        be added once all are, by ``replace``, ``publish`` or ``rebucket``.
        """
        done = self.find(load_id)
        if done is not None:
            return done
        before = self.current()
        if before is None:
            raise ValueError(f"{self.path}: nothing has been published")
        gone = set(names)
        absent = sorted(gone - set(before.schema.names))
        if absent or gone & set(self.key):
            raise ValueError(f"{absent or sorted(gone & set(self.key))} cannot be dropped")
        commit = replace(
            before, load_id=load_id, seq=before.seq + 1, row_count=0,
            schema=T.StructType([f for f in before.schema.fields if f.name not in gone]),
            dropped=tuple(sorted({*before.dropped, *gone})))
        self._write_commit(commit)
        return commit

    def publish_placed(
        self,
        load_id: str,
        rows: DataFrame,
        before: Commit | None,
        replaces: Collection[int] | None = None,
        watermark: str | None = None,
        row_count: int | None = None,
        unique_keys: bool = False,
        keep_watermark: bool = True,
    ) -> Commit:
        """Write ``placed`` rows from where they are. They become the table, or the
        ``replaces`` buckets of it, after the version ``before``.

        The load must be a new one. ``row_count`` is its size for the record, by default
        the rows written.
        """
        if self.find(load_id) is not None:
            raise ValueError(f"{self.path}: load {load_id} is committed")
        dropped = before.dropped if before is not None and replaces is not None else ()
        _check_dropped(dropped, rows.columns, self.path)
        written = self._write_rows(load_id, rows)
        buckets: dict[int, str] = {}
        if before is not None and replaces is not None:
            gone = set(replaces)
            buckets = {b: load for b, load in before.buckets.items() if b not in gone}
        buckets.update({b: load_id for b in written["buckets"]})
        commit = Commit(
            load_id=load_id,
            seq=before.seq + 1 if before else 1,
            buckets=buckets,
            schema=T.StructType([T.StructField(f.name, f.dataType) for f in rows.drop(BUCKET).schema.fields]),
            watermark=watermark or (before.watermark if before and keep_watermark else None),
            row_count=written["row_count"] if row_count is None else row_count,
            unique_keys=unique_keys,
            dropped=dropped,
        )
        self._write_commit(commit)
        return commit

    def retire(self, keep: int = 1) -> int:
        """Drop the buckets that none of the last ``keep`` versions uses, whatever loads
        that died have left behind, and the control rows and changes of the versions before.

        Call it between loads, when no reader of an older version is left and no retired
        load will be tried again. Returns how many bucket directories were dropped. A table
        without versions is left alone.
        """
        if keep < 1:
            raise ValueError(f"keep={keep}: the current version cannot be retired")
        if not exists(self.spark, f"{self.path}/commits"):
            return 0
        kept = self.commits().orderBy(F.desc("seq")).limit(keep).select("seq", "load_id", "buckets").collect()
        if not kept:
            return 0
        in_use: dict[str, set[str]] = {}
        for row in kept:
            for bucket, load in _bucket_map(row["buckets"]).items():
                in_use.setdefault(load, set()).add(str(bucket))
        drop_other_loads(self.spark, f"{self.path}/commits", {row["load_id"] for row in kept})
        data = f"{self.path}/data"
        dropped = sum(
            drop_others(self.spark, f"{data}/load_id={load}", f"{BUCKET}=", in_use.get(load, ()))
            for load in loads_in(self.spark, data)
        )
        drop_other_loads(self.spark, data, in_use)
        for passing in ("staging", "slices"):
            drop_other_loads(self.spark, f"{self.path}/{passing}", ())
        drop_other_loads(self.spark, f"{self.path}/changes", {row["load_id"] for row in kept})
        self._sweep_catalogue()
        return dropped

    def _sweep_catalogue(self) -> None:
        """Drop the passing tables over this table's files that a killed driver has left."""
        here = f"{self.path}/data"
        for row in self.spark.sql(f"SHOW TABLES IN {self.database} LIKE 'tablesync_*'").collect():
            name = f"{self.database}.{row['tableName']}"
            described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()
            if described is not None and re.sub("^[a-z]+:/*", "/", described["data_type"]).startswith(
                    re.sub("^[a-z]+:/*", "/", here)):
                self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _passing_name(self) -> str:
        return f"{self.database}.tablesync_{uuid.uuid4().hex}"

    def _directory(self, load_id: str, bucket: int | str) -> str:
        return f"{self.path}/data/load_id={load_id}/{BUCKET}={bucket}"

    def _write_rows(self, load_id: str, rows: DataFrame) -> dict:
        path = f"{self.path}/data/load_id={load_id}"
        drop_if_exists(self.spark, path)
        name = self._passing_name()
        seen = Observation()
        counted = rows.observe(
            seen,
            F.count(F.lit(1)).alias("row_count"),
            *bucket_bitmaps(F.col(BUCKET), self.n_buckets),
        )
        try:
            with _unlisted_partitions(rows.sparkSession):
                (
                    counted.write.format("parquet")
                    .partitionBy(BUCKET)
                    .bucketBy(self.n_buckets, *self.key)
                    .option("path", path)
                    .saveAsTable(name)
                )
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        return {"row_count": seen.get["row_count"], "buckets": buckets_in(seen.get)}

    def _write_commit(self, commit: Commit) -> None:
        row = one_row(self.spark, COMMIT_SCHEMA, {
            "load_id": commit.load_id,
            "seq": commit.seq,
            "key": self.key,
            "n_buckets": self.n_buckets,
            "buckets": json.dumps({load: _runs(used) for load, used in _by_load(commit.buckets).items()}),
            "columns": commit.schema.json(),
            "watermark": commit.watermark,
            "row_count": commit.row_count,
            "unique_keys": commit.unique_keys,
            "committed_at": F.current_timestamp(),
            "dropped": F.array(*[F.lit(name) for name in commit.dropped]),
        })
        path = f"{self.path}/commits/load_id={commit.load_id}"
        row.drop("load_id").write.mode("overwrite").parquet(path)

    def _commit(self, row: Row) -> Commit:
        if row["n_buckets"] != self.n_buckets or row["key"] != self.key:
            raise ValueError(
                f"{self.path} is bucketed by {row['key']} into {row['n_buckets']}, "
                f"not by {self.key} into {self.n_buckets}"
            )
        return Commit(
            load_id=row["load_id"],
            seq=row["seq"],
            buckets=_bucket_map(row["buckets"]),
            schema=T.StructType.fromJson(json.loads(row["columns"])),
            watermark=row["watermark"],
            row_count=row["row_count"],
            unique_keys=row["unique_keys"],
            dropped=tuple(row["dropped"] or ()),
        )


def _by_load(buckets: dict[int, str]) -> dict[str, list[int]]:
    """The buckets that each load holds, in order."""
    held: dict[str, list[int]] = {}
    for bucket in sorted(buckets):
        held.setdefault(buckets[bucket], []).append(bucket)
    return held


def _runs(numbers: Sequence[int]) -> list[list[int]]:
    """Ordered numbers as pairs of the first and last of each unbroken run."""
    runs: list[list[int]] = []
    for number in numbers:
        if runs and runs[-1][1] == number - 1:
            runs[-1][1] = number
        else:
            runs.append([number, number])
    return runs


def _bucket_map(text: str) -> dict[int, str]:
    """The load of each bucket, from runs of buckets per load or, as control rows had it before, a load per bucket."""
    found: dict[int, str] = {}
    for name, value in json.loads(text).items():
        if isinstance(value, str):
            found[int(name)] = value
        else:
            found.update((bucket, name) for first, last in value for bucket in range(first, last + 1))
    return found


def buckets_for(total_bytes: int, bucket_bytes: int | None = None) -> int:
    """Buckets for a table of this size on disk. A table refuses more than Spark's own limit.

    Unless their size is given, buckets are of 4 MiB, which a task sorts in some hundred MB. Tables that
    would need more than 10,000 of these get larger ones, up to 1 GiB.
    """
    if bucket_bytes is not None:
        return max(1, math.ceil(total_bytes / bucket_bytes))
    small = min(math.ceil(total_bytes / BUCKET_BYTES), MANY_BUCKETS)
    return max(1, small, math.ceil(total_bytes / (1 << 30)))


def bucket_bitmaps(bucket: Column, n_buckets: int) -> list[Column]:
    """Aggregates that tell which buckets occur: a bitmap of fixed size per 32,768 buckets.

    Tasks send 4 KB each however many rows and buckets they see; NULL is no bucket.
    """
    return [
        F.bitmap_construct_agg(F.when(F.floor(bucket / BITMAP) == n, bucket % BITMAP)).alias(f"buckets_{n}")
        for n in range(-(-n_buckets // BITMAP))
    ]


def buckets_in(measured: dict) -> list[int]:
    """The buckets that ``bucket_bitmaps`` found."""
    found = []
    for name, bitmap in measured.items():
        if name.startswith("buckets_") and bitmap is not None:
            first = int(name.removeprefix("buckets_")) * BITMAP
            found += [first + 8 * i + k for i, byte in enumerate(bitmap) if byte for k in range(8) if byte >> k & 1]
    return sorted(found)


def _check_dropped(dropped: Collection[str], names: Collection[str], path: str) -> None:
    back = sorted(set(dropped) & set(names))
    if back:
        raise ValueError(f"{path}: {back} were dropped and files still hold them; replace the table first")


def check_name(name: str) -> str:
    """Names of loads and tables are directory names."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name):
        raise ValueError(f"{name!r} cannot name a directory")
    return name


@contextmanager
def _unlisted_partitions(session: SparkSession) -> Iterator[None]:
    """Spare the catalogue the partitions of a table whose entry is dropped at once."""
    before = session.conf.get(MANAGE_PARTITIONS)
    session.conf.set(MANAGE_PARTITIONS, False)
    try:
        yield
    finally:
        session.conf.set(MANAGE_PARTITIONS, before)


def _as_text(commits: DataFrame) -> DataFrame:
    return commits.withColumn("watermark", F.col("watermark").cast("string"))


def ddl(dtype: T.DataType) -> str:
    """A type as DDL, with the names of nested fields quoted."""
    if isinstance(dtype, T.StructType):
        return f"STRUCT<{', '.join(f'{quote(f.name)}: {ddl(f.dataType)}' for f in dtype.fields)}>"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{ddl(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<{ddl(dtype.keyType)}, {ddl(dtype.valueType)}>"
    return dtype.simpleString()


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"
