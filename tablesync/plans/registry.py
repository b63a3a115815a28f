"""The control table of watermarks: one row per committed load of each table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import literal_text
from tablesync.operators.increment import Point
from tablesync.operators.latest import latest
from tablesync.sources.files import LOAD, directories, drop_if_exists, drop_others, exists, loads_in
from tablesync.sources.tables import one_row, overwrite, scan_parquet
from tablesync.sources.versions import check_name

REGISTRY_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_id", T.StringType()),
    T.StructField("watermark", T.TimestampNTZType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("committed_at", T.TimestampType()),
])


@dataclass(frozen=True)
class Progress:
    """Where a table stands: its watermark as ISO text, and its committed loads."""

    watermark: str | None
    loads: list[str]


FOLDED = "fold="
#: Rows of a table that lie in files of their own before they are folded into one.
FOLD = 64


class Registry:
    """A load is committed when its row is here, so a job writes the row last.

    A row is written to a directory of its own, ``table_name=<table>/load_id=<load>``: jobs of
    different tables do not meet, and recording a load again replaces its row. When a table has FOLD
    such rows they are folded, with what was folded before, into one file,
    ``_folded/table_name=<table>/fold=<n>``. However many loads a table has had, a lookup lists at most FOLD
    directories and opens one file more.

    A fold counts once it is whole; only then are the rows it holds dropped from their own
    places. One that died in between leaves rows in both, where the later row of a load counts.
    Jobs of one table do not run at the same time.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def history(self) -> DataFrame:
        rows = scan_parquet(self.spark, self.path, REGISTRY_SCHEMA).select(*REGISTRY_SCHEMA.names)
        for name in sorted(directories(self.spark, f"{self.path}/_folded", "table_name=")):
            folded = self._fold(name)
            if folded is not None:
                rows = rows.union(folded.select(F.lit(name).alias("table_name"), *REGISTRY_SCHEMA.names[1:]))
        return latest(rows, ["table_name", "load_id"], ["committed_at"])

    def current(self) -> DataFrame:
        """The row of each table with the latest watermark, which never goes back."""
        return latest(self.history(), ["table_name"], ["watermark", "committed_at", "load_id"])

    def loads(self, table_name: str) -> DataFrame:
        """The committed loads of a table, (load_id)."""
        return self._rows(table_name).select("load_id").distinct()

    def progress(self, table_name: str) -> Progress:
        """The watermark with the list of all loads; a job that needs no list asks the two below."""
        rows = self.loads(table_name).collect()
        return Progress(self.watermark(table_name), sorted(row["load_id"] for row in rows))

    def watermark(self, table_name: str) -> str | None:
        """The table's watermark, None before its first load: one row comes to the driver."""
        return self._rows(table_name).agg(F.max("watermark").cast("string")).first()[0]

    def committed(self, table_name: str, load_id: str) -> bool:
        """Whether a load is committed: by its own row, or by one of the folded file."""
        path = f"{self._own(table_name)}/{LOAD}{check_name(load_id)}"
        if not scan_parquet(self.spark, path, T.StructType(REGISTRY_SCHEMA.fields[2:])).isEmpty():
            return True
        folded = self._fold(table_name)
        return folded is not None and not folded.where(F.col("load_id") == load_id).isEmpty()

    def record(self, table_name: str, load_id: str, watermark: Point, row_count: int) -> None:
        value, stored = literal_text(watermark), self.watermark(table_name)
        if stored is not None and datetime.fromisoformat(value) < datetime.fromisoformat(stored):
            raise ValueError(f"{table_name}: watermark {value} is before the stored {stored}")
        row = one_row(self.spark, REGISTRY_SCHEMA, {
            "watermark": value,
            "row_count": row_count,
            "committed_at": F.current_timestamp(),
        })
        overwrite(row.drop("table_name", "load_id"), f"{self._own(table_name)}/{LOAD}{check_name(load_id)}")
        if len(loads_in(self.spark, self._own(table_name))) >= FOLD:
            self.fold(table_name)

    def fold(self, table_name: str) -> None:
        """Move the rows of a table into one file, a new one next to the one that counts until then."""
        held = loads_in(self.spark, self._own(table_name))
        number = max(self._folds(table_name), default=0) + 1
        rows = latest(self._rows(table_name), ["load_id"], ["committed_at"])
        overwrite(rows.coalesce(1).sortWithinPartitions("load_id"), f"{self._folded(table_name)}/{FOLDED}{number}",
                  options={"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"})
        for load in held:
            drop_if_exists(self.spark, f"{self._own(table_name)}/{LOAD}{load}")
        drop_others(self.spark, self._folded(table_name), FOLDED, [str(number)])

    def _own(self, table_name: str) -> str:
        return f"{self.path}/table_name={check_name(table_name)}"

    def _folded(self, table_name: str) -> str:
        return f"{self.path}/_folded/table_name={check_name(table_name)}"

    def _rows(self, table_name: str) -> DataFrame:
        """Every row of a table; a load that is both in a fold and by itself comes twice."""
        schema = T.StructType(REGISTRY_SCHEMA.fields[1:])
        rows = scan_parquet(self.spark, self._own(table_name), schema).select(*schema.names)
        folded = self._fold(table_name)
        return rows if folded is None else rows.union(folded.select(*schema.names))

    def _folds(self, table_name: str) -> list[int]:
        return [int(n) for n in directories(self.spark, self._folded(table_name), FOLDED)]

    def _fold(self, table_name: str) -> DataFrame | None:
        """The newest fold that is whole."""
        home = self._folded(table_name)
        for number in sorted(self._folds(table_name), reverse=True):
            if exists(self.spark, f"{home}/{FOLDED}{number}/_SUCCESS"):
                return scan_parquet(self.spark, f"{home}/{FOLDED}{number}", T.StructType(REGISTRY_SCHEMA.fields[1:]))
        return None
