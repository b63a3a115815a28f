"""Benchmark decontamination: which documents contain a benchmark item.

Items fall into classes by size (a power of two of distinct shingles). An item is
represented by its bottom-k MinHash signature, the k smallest hashes of its shingles. A
document that holds the share ``t`` of an item lacks at most ``(1 - t) * n`` of the n
shingles, so of any ``(1 - t) * u + 1`` of them it holds one. With k of that length for the
upper bound u of the size class, a search for documents that hold any value of a signature
misses nothing, however long the document is. Documents with too few words for the class
are skipped. What is found is verified by the exact shingles.

Only DataFrame functions; equal (document, item) pairs are made distinct map-side before
they are shuffled. The signatures are broadcast if they are few, by count, else joined.

Defined results: null and empty texts, and items of fewer than five words, match nothing;
rows alike in id and text are one document; items alike in text match each under its own id;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import SHINGLE_WORDS, SIMILARITY, once, packed, row_name, saved, table, words

#: Rows up to which a side of a join is broadcast: under 10 MB of signatures or ids.
BROADCAST_ROWS = 200_000
#: Items, with their shingles, up to which they are broadcast.
BROADCAST_ITEMS = 2_000
#: Shingles up to which a whole item counts as small enough for that.
BROADCAST_SHINGLES = 500_000


def _starts(n: Column) -> Column:
    return F.sequence(F.lit(0), n - SHINGLE_WORDS)


def shingle_hashes(w: Column) -> Column:
    """A hash per run of five words, in order, repeats included."""
    return F.transform(_starts(F.size(w)), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(SHINGLE_WORDS)]))


def shingles(w: Column) -> Column:
    """The distinct runs of five words as texts."""
    return F.array_distinct(F.transform(
        _starts(F.size(w)), lambda i: F.array_join(F.slice(w, i + 1, F.lit(SHINGLE_WORDS)), " ")))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df`` to be broadcast if it has few rows, else as it is."""
    return F.broadcast(df) if df.count() <= rows else df


def contained(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Pairs (row, doc_id, item_id, n_shared, n_item, containment) of documents holding an item.

    ``row`` names the document's id and text by 128 bits.
    """
    sized = (
        items.select("item_id", F.monotonically_increasing_id().alias("item"), once("w", words(F.col("text")))).where(F.size("w") >= SHINGLE_WORDS)
        .select("item", "item_id", shingles(F.col("w")).alias("shingles"))
        .withColumn("n_item", F.size("shingles"))
    )
    upper = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1
    known = saved(sized.withColumn("k", (F.floor(F.lit(1 - similarity) * upper + 1e-9) + 1).cast("int")), "items")
    # hashes of the shingles' words, as shingle_hashes() makes them
    hashed = known.select("item", "n_item", "k", F.transform("shingles", lambda s: F.xxhash64(
        *[F.get(F.split(s, " "), F.lit(i)) for i in range(SHINGLE_WORDS)])).alias("hashes"))
    signatures = saved(
        hashed.select("item", "n_item", F.explode(F.slice(F.array_sort("hashes"), F.lit(1), F.col("k"))).alias("hash")),
        "signatures")
    rows = docs.select("doc_id", "text", row_name("doc_id", "text").alias("row"))
    probes = rows.select("row", once("w", words(F.col("text")))).where(F.size("w") >= SHINGLE_WORDS).select(
        "row", F.size("w").alias("n_words"), F.explode(shingle_hashes(F.col("w"))).alias("hash"))
    found = probes.join(_few(signatures, BROADCAST_ROWS), "hash").where(
        F.col("n_words") - SHINGLE_WORDS + 1 >= F.lit(similarity) * F.col("n_item") - 1e-9
    ).select("row", "item").distinct()
    candidates = saved(found, "candidates")
    n_shingles = known.agg(F.sum("n_item")).first()[0] or 0
    small = n_shingles <= BROADCAST_SHINGLES and known.count() <= BROADCAST_ITEMS
    texts = saved(rows.join(_few(candidates.select("row").distinct(), BROADCAST_ROWS), "row", "left_semi").distinct()
                  .select("row", "doc_id", once("w", words(F.col("text"))))
                  .select("row", "doc_id", shingles(F.col("w")).alias("held")), "held")
    pairs = candidates.join(texts, "row").join(F.broadcast(known) if small else known, "item")
    shared = F.size(F.array_intersect("shingles", "held"))
    return pairs.select("row", "doc_id", "item_id", shared.cast("long").alias("n_shared"),
                        F.col("n_item").cast("long").alias("n_item"),
                        (shared / F.col("n_item")).alias("containment")).where(
        F.col("n_shared") >= F.lit(similarity) * F.col("n_item") - 1e-9)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without those that contain an item."""
    leaks = saved(contained(docs, table(spark, sf_dir, "benchmark")).select("row").distinct(), "leaks")
    named = docs.select(row_name("doc_id", "text").alias("row"), packed(docs).alias("doc"))
    return named.join(_few(leaks, BROADCAST_ROWS), "row", "left_anti").select("doc.*")


_WORDS = r"""list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{M}\p{N}_]+'), lambda x: x <> '')"""
ORACLE = rf"""
WITH d AS (SELECT DISTINCT doc_id, text, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, text, array_to_string(w[p:p + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM d)),
its AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - 3)) AS p FROM i)),
n AS (SELECT item_id, count(*) AS n_item FROM its GROUP BY item_id)
SELECT doc_id, item_id, count(*)::BIGINT AS n_shared, n_item::BIGINT AS n_item,
    count(*)::DOUBLE / n_item AS containment
FROM ds JOIN its USING (s) JOIN n USING (item_id)
GROUP BY doc_id, text, item_id, n_item
HAVING count(*) >= 0.8 * n_item
"""
