"""What has arrived in a directory of files since the last load, whatever points in time its rows have.

A stream that ends with what is there (``availableNow``) keeps the names of the files it has taken in
its checkpoint, so rows that come late are new when they come, which a watermark over their values
would pass over. Each load lands its rows in a directory of its own; the log of the file sink they
share counts every batch once, however often it is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.mapping import quoted
from tablesync.plans.upsert import NOTHING, UpsertResult, upsert_latest
from tablesync.sources.files import LOAD, drop_if_exists, loads_in
from tablesync.sources.tables import scan_parquet
from tablesync.sources.versions import VersionedTable, check_name

EVENT_TIME = "__event_time"
LOAD_ID = LOAD.removesuffix("=")


@dataclass(frozen=True)
class Arrivals:
    """Files under ``source``; checkpoint and landed rows under ``home``.

    With ``unique``, of rows alike in these columns that arrive within ``within`` of each other by
    ``at`` only the first lands. Spark keeps the keys of that long in its state store; a
    row that is older than the latest ``at`` by more is dropped as late. Without it nothing is.
    The sink forgets files landed longer than ``retention`` ago: a load has to be done before.
    """

    source: str
    schema: T.StructType
    home: str
    file_format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    files_per_batch: int | None = None
    unique: Sequence[str] = ()
    at: str | None = None
    within: str | None = None
    retention: str = "90d"

    def __post_init__(self) -> None:
        if LOAD_ID in self.schema.names:
            raise ValueError(f"{LOAD_ID} names the load and cannot be a column of its rows")
        if bool(self.unique) != bool(self.at and self.within):
            raise ValueError("unique rows need a column and a time within which they are unique")

    def land(self, spark: SparkSession, load_id: str) -> DataFrame:
        """The rows that have arrived, and those an earlier try of this load has landed.

        A load that was landed but not ``done`` has to be finished first: its files are taken.
        """
        pending = [load for load in self.pending(spark) if load != check_name(load_id)]
        if pending:
            raise ValueError(f"{self.home}: finish load {pending} first, whose files were taken")
        limit = {} if self.files_per_batch is None else {"maxFilesPerTrigger": str(self.files_per_batch)}
        rows = spark.readStream.schema(self.schema).format(self.file_format).options(**self.options, **limit).load(self.source)
        if self.unique:
            moment = quoted(self.at).cast("timestamp")
            rows = rows.withColumn(EVENT_TIME, moment).withWatermark(EVENT_TIME, self.within)
            rows = rows.dropDuplicatesWithinWatermark(list(self.unique)).drop(EVENT_TIME)
        stream = (
            rows.withColumn(LOAD_ID, F.lit(load_id))
            .writeStream.format("parquet")
            .partitionBy(LOAD_ID)
            .option("path", f"{self.home}/landed")
            .option("checkpointLocation", f"{self.home}/offsets")
            .option("retention", self.retention)
            .trigger(availableNow=True)
            .start()
        )
        stream.awaitTermination()
        landed = T.StructType([*self.schema.fields, T.StructField(LOAD_ID, T.StringType())])
        return scan_parquet(spark, f"{self.home}/landed", landed).where(F.col(LOAD_ID) == load_id).drop(LOAD_ID)

    def done(self, spark: SparkSession, load_id: str) -> None:
        """Drop what a load has landed, when it is part of the table."""
        drop_if_exists(spark, f"{self.home}/landed/{LOAD}{check_name(load_id)}")

    def pending(self, spark: SparkSession) -> list[str]:
        """Loads that were landed and are not done."""
        return sorted(loads_in(spark, f"{self.home}/landed"))


def sync_arrivals(
    arrivals: Arrivals,
    table: VersionedTable,
    order: Sequence[str],
    load_id: str,
    ties: Sequence[str] | None = None,
) -> UpsertResult:
    """Merge what has arrived into a table. A run that died at any point is tried again with its load id.

    A load that is committed takes no further files: they are the next load's.
    """
    spark = table.spark
    if table.find(load_id) is not None:
        arrivals.done(spark, load_id)
        return NOTHING
    rows = arrivals.land(spark, load_id)
    result = upsert_latest(table, rows, order, load_id, ties=ties)
    arrivals.done(spark, load_id)
    return result
