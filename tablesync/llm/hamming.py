"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code has a bit per component, set if it is above zero, and is cut into segments of
16 bits. Codes are indexed by the value of each segment. A query looks up, segment by segment,
the values at distance 0, then 1, 2 and so on from its own. Once all S segments are searched
to radius r, every code within S * (r + 1) - 1 is found: a code further than r from the query
in every segment differs in S * (r + 1) bits. A query ends when its kth distance is within
that bound; only the others go on to the next radius, and keep what is no further than their
kth distance so far.

Vectors are compared with those of their own length: the length is the first number of a code
and part of every lookup, so vectors of other lengths lose and find nothing.

Equal codes are one row of the index with their k smallest ids, which is all that a result
can show of them. Ties go to the smaller id. The query's own row is a row like the others.

Defined results: vectors that are null or without components have no code, and neither answer
nor ask; null components count as zero; ids that repeat are separate rows;
a null id is not indexed; fewer than k rows of a length give as many as there are; an empty table gives
an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import saved, table

K = 10
SEGMENT_BITS = 16
EVERY = 100


def codes(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, code): the code is an array of the vector's length and one number per segment."""
    segments = F.transform(
        F.sequence(F.lit(1), F.size("embedding"), F.lit(SEGMENT_BITS)),
        lambda at: F.aggregate(
            F.slice("embedding", at, SEGMENT_BITS), F.lit(0),
            lambda sofar, x: F.shiftleft(sofar, 1).bitwiseOR(F.when(x > 0, 1).otherwise(0))))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select(
        "vec_id", F.concat(F.array(F.size("embedding")), segments).alias("code"))


def length(code: str = "code") -> Column:
    return F.get(F.col(code), F.lit(0))


def segments_of(code: str = "code") -> Column:
    return F.slice(F.col(code), F.lit(2), F.size(code) - 1)


def _parts(a: str, b: str) -> Column:
    """The distances of two codes of a length, segment by segment."""
    return F.zip_with(segments_of(a), segments_of(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))


def _key(s: Column, value: Column) -> Column:
    """A number for a segment and its value."""
    return s.cast("long") * (1 << SEGMENT_BITS) + value


def nearest(index: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Rows (code, found, distance) of the codes that hold a query code's k nearest rows.

    ``index`` has (code, ids): distinct codes with up to k ids each; ``queries`` has (code).
    """
    totals = index.groupBy(length().alias("length")).agg(
        F.least(F.lit(k), F.sum(F.size("ids"))).alias("enough"))
    where = saved(index.select("code", F.posexplode(segments_of()).alias("s", "value"), F.size("ids").alias("n"),
                               F.get("ids", F.lit(0)).alias("least")).select(
        length().alias("length"), _key(F.col("s"), F.col("value")).alias("key"), F.col("code").alias("found"), "n", "least"),
        "segments")
    segments = F.size("code") - 1
    bits = segments * SEGMENT_BITS
    active, done, best = saved(
        queries.select("code", length().alias("length"), bits.alias("bound")).distinct().join(totals, "length"),
        "active"), [], None
    for radius in range(SEGMENT_BITS + 1):
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << SEGMENT_BITS) - 1)), lambda m: F.bit_count(m) == radius)
        probes = active.select("code", "length", "bound", "enough", F.posexplode(segments_of()).alias("s", "value")).withColumn(
            "mask", F.explode(masks)).select(
            "code", "length", "bound", "enough", "s", _key(F.col("s"), F.col("value").bitwiseXOR(F.col("mask"))).alias("key"))
        # a code is met in every segment that is near; it counts where (distance, segment) is least
        parts = F.col("parts")
        # the probes come from few rows, but are many: they are not to be broadcast
        new = probes.hint("merge").join(where, ["length", "key"]).withColumn("parts", _parts("code", "found")).where(
            (F.array_min(parts) == radius) & (F.array_position(parts, F.lit(radius)) == F.col("s") + 1)).select(
            "code", "found", "n", "least", "enough", "bound",
            F.aggregate(parts, F.lit(0), lambda sofar, x: sofar + x).alias("distance")).where(
            "distance <= bound").drop("bound")
        seen = new if best is None else new.unionByName(best)
        rank = F.row_number().over(Window.partitionBy("code").orderBy("distance", "least"))
        seen = seen.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")
        covered = segments * (radius + 1) - 1
        within = F.sum(F.when(F.col("distance") <= covered, F.col("n")).otherwise(0))
        # nothing beyond the kth distance so far is of use any more
        sofar = Window.partitionBy("code").orderBy("distance", "least").rowsBetween(Window.unboundedPreceding, 0)
        best = saved(
            seen.withColumn("sofar", F.sum("n").over(sofar)).withColumns({
                "sure": within.over(Window.partitionBy("code")),
                "kth": F.min(F.when(F.col("sofar") >= F.col("enough"), F.col("distance"))).over(Window.partitionBy("code"))})
            .drop("sofar"), "best")
        finished = best.where(F.col("sure") >= F.col("enough"))
        done.append(finished.select("code", "found", "distance"))
        going = best.where(F.col("sure") < F.col("enough"))
        kth = going.groupBy("code").agg(F.min("kth").alias("kth"))
        active = saved(active.join(finished.select("code").distinct(), "code", "left_anti").join(
            kth, "code", "left").select("code", "length", F.coalesce("kth", bits).alias("bound"), "enough"), "active")
        best = saved(going.drop("sure", "kth"), "best")
        if active.isEmpty():
            break
    out = done[0]
    for part in done[1:]:
        out = out.union(part)
    return out


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """Rows (query_id, rank, vec_id, distance): the k nearest rows of each row that asks."""
    coded = saved(codes(vectors), "codes")
    rank = F.row_number().over(Window.partitionBy("code").orderBy("vec_id"))
    index = saved(coded.withColumn("rank", rank).where(F.col("rank") <= k).groupBy("code").agg(
        F.array_sort(F.collect_list("vec_id")).alias("ids")), "index")
    queries = saved(coded.where(is_query).select(F.col("vec_id").alias("query_id"), "code"), "queries")
    near = nearest(index, queries, k)
    rows = near.join(index.select(F.col("code").alias("found"), "ids"), "found").select(
        "code", "distance", F.explode("ids").alias("vec_id"))
    placed = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("code").orderBy("distance", "vec_id"))).where(F.col("rank") <= k)
    return queries.join(placed, "code").select(
        "query_id", "rank", "vec_id", F.col("distance").cast("int").alias("distance"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % EVERY == 0)


ORACLE = """
WITH c AS (
    SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings
), d AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(list_zip(q.bits, c.bits), lambda p: CASE WHEN p[1] <> p[2] THEN 1 ELSE 0 END))::INTEGER
            AS distance
    FROM c q, c WHERE q.vec_id % 100 = 0
), r AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INTEGER AS rank FROM d
)
SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= 10
"""
