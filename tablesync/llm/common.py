"""Helpers of the corpus operators: saved tables, scans, words, running totals, components."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.session import scratch_dir

#: A word, as every operator on shingles counts it: a run of letters, marks, digits or underscores.
NOT_WORD = r"[^\p{L}\p{M}\p{N}_]+"
SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Bytes and rows that reach Python at once in a session that has no setting of its own.
ARROW = {"spark.sql.execution.arrow.maxBytesPerBatch": "8m", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def carried(module: str) -> None:
    """Send a module's functions to executors by value: they need not have this package installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


carried(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Let texts reach Python a few megabytes at a time, unless the session says otherwise."""
    chosen = spark.conf.getAll
    for name, value in ARROW.items():
        if name not in chosen:
            spark.conf.set(name, value)


def saved(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write rows under the shared checkpoint folder and read them back: the lineage ends here."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text in lower case; a null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), NOT_WORD), lambda w: w != "")


def row_name(*columns: str) -> Column:
    """128 bits that name a row by some of its columns, nulls told from texts."""
    texts = [F.col(f"`{c.replace('`', '``')}`").cast("string") for c in columns]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
             for t in texts]
    return F.unhex(F.md5(F.concat(*parts)))


def packed(df: DataFrame) -> Column:
    """A row as one column: whatever else is added cannot meet a name of its own."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in df.columns])


def once(name: str, value: Column) -> Column:
    """A column computed once per row: later expressions that use it many times cannot copy it."""
    return F.explode(F.array(value)).alias(name)


def running(df: DataFrame, order: Sequence[str], amounts: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add ``before_<amount>``: the sum of an amount over the rows ahead in the group's order.

    Rows are dealt into ranges of (by, order), so a group of any size is shared by many
    tasks; each range is summed, and the sums of the ranges ahead are added to the running
    total inside it. ``by`` must not be null. Ranges are saved: a task that runs again sees
    the same ones.
    """
    by, order, amounts = list(by), list(order), list(amounts)
    ranged = saved(
        df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()), "ranges"
    )
    ahead = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("_range", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range", *by)
        .agg(*[F.sum(a).alias(f"_sum_{a}") for a in amounts])
        .select("_range", *by, *[F.coalesce(F.sum(f"_sum_{a}").over(ahead), F.lit(0)).alias(f"_start_{a}")
                                 for a in amounts])
    )
    within = ranged.select("*", *[F.coalesce(F.sum(a).over(inside), F.lit(0)).alias(f"_in_{a}") for a in amounts])
    joined = within.join(starts, ["_range", *by])
    return joined.select(*df.columns, *[(F.col(f"_in_{a}") + F.col(f"_start_{a}")).alias(f"before_{a}")
                                        for a in amounts])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of (a, b): one row (node, class), the class being its smallest node.

    Large-star and small-star steps in turn until neither changes an edge. A step is a
    minimum per node and a join, so a node with very many neighbours is combined map-side
    and its rows are spread by the skew join.
    """
    pairs = saved(_ordered(edges.select("a", "b")).distinct(), "edges")
    before = None
    while True:
        both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _ordered(large).distinct()
        low = large.select(F.col("a").alias("low"), F.col("b").alias("high"))
        first = low.groupBy("high").agg(F.min("low").alias("m"))
        small = low.join(first, "high").select(
            F.explode(F.array(F.struct(F.col("m").alias("a"), F.col("low").alias("b")),
                              F.struct(F.col("m").alias("a"), F.col("high").alias("b")))).alias("e")
        ).select("e.*")
        pairs = saved(_ordered(small).distinct(), "edges")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    leaves = pairs.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("class"))
    roots = pairs.select(F.col("a").alias("node"), F.col("a").alias("class")).distinct()
    return leaves.union(roots)


def _ordered(edges: DataFrame) -> DataFrame:
    """Edges as (smaller, larger), without loops."""
    return edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b")

