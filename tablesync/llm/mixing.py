"""Mix sources to target weights by weighted sampling without replacement.

Every document draws an exponential key with its quality weight as the rate (Efraimidis
and Spirakis); documents are sorted by key within their source, and the sizes ahead of each
are summed. A source whose target exceeds its size gives whole epochs first; what is left of
the target is filled by the documents with the smallest keys.

Defined results: a null source is a source of its own, sorted last; a null weight counts as
1; a document of size 0 is never taken; rows alike in all columns are separate documents; with null
and repeated ids reruns agree, too, as the text's digest ends every order; an
empty table gives an empty result; columns of the input keep out of the way, as the
operator builds its own narrow table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.llm.common import packed, row_name, running, saved, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SEED = "mix-1"
#: A word is a run of anything but ASCII white space.
SIZE_WORD = r"[^\x20\x09-\x0D]+"
#: Rates of the exponential keys by the label of quality.
QUALITY = {1: 4.0, 0: 1.0}
UNLABELLED = 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SIZE_WORD)), F.lit(0)).cast("long")


def uniform(name: Column, seed: str = SEED) -> Column:
    """A number in (0, 1] that depends on a name, as text, and the seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), name.cast("string")))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1.0) / float(1 << 52)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row per source: its place by code point (null last), its size and its target.

    A target is ``level * weight`` but at most ``max_epochs`` sizes. Ordered by size over
    weight, the level is the largest of (budget - caps ahead) / (weights from here on).
    The windows run over one row per source, not over documents.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = per_source.select(
        "source", "source_size",
        F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))).alias("place"),
    )
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    full = place.select("*", weigh.alias("weight"), (F.lit(float(max_epochs)) * F.col("source_size")).alias("cap"))
    rank = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    ahead, onward = rank.rowsBetween(Window.unboundedPreceding, -1), rank.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(ahead), F.lit(0.0))
             ) / F.sum("weight").over(onward)
    return full.withColumn("level", level).select(
        "source", "place", "source_size",
        F.round(F.least("cap", F.max("level").over(everything) * F.col("weight")), 6).alias("target"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """What the mix takes of each row of ``docs`` (doc_id, source, size, rate and others kept).

    Returns the columns of ``docs`` with source_size, target (both of the source) and taken.
    The last document of a source is taken when that brings the source nearer to its target.
    Documents with one id have one key and stand in the order of their other columns; those without
    an id are drawn by these columns. A digest of the text among them tells all documents apart.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "source")]
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in others]
    sizes = saved(docs, "sizes")
    targets = saved(source_targets(sizes, weights, share, max_epochs), "targets")
    rate = F.greatest(F.coalesce(F.col("rate"), F.lit(1.0)), F.lit(1e-9))
    named = sizes.join(F.broadcast(targets) if targets.count() <= 10_000 else targets,
                       sizes["source"].eqNullSafe(targets["source"])).select(
        *[sizes[c] for c in docs.columns], "place", "source_size", "target",
        (-F.log(uniform(F.coalesce(F.col("doc_id").cast("string"), F.concat_ws(":", *shown)), seed)) / rate).alias("key"),
    )
    placed = running(named, ["key", "doc_id", *others], ["size"], by=["place"])
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - epochs * F.col("source_size")
    extra = (F.col("before_size") + F.col("size") / 2.0 <= rest).cast("long")
    taken = (F.col("size") * F.least(epochs + extra, F.lit(max_epochs))).cast("long")
    return placed.select(*docs.columns, "source_size", "target", taken.alias("taken"))


def rated(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with the sampling rate that the label of quality gives; several labels: the best."""
    quality = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.max("quality").alias("_quality"))
    rate = F.lit(UNLABELLED)
    for value, weight in QUALITY.items():
        rate = F.when(F.col("_quality") == value, weight).otherwise(rate)
    return docs.join(quality, "doc_id", "left").withColumn("rate", rate).drop("_quality")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), F.md5("text").alias("digest"))
    return mix(rated(docs, table(spark, sf_dir, "labels"))).select(
        "doc_id", "size", "source_size", "target", "taken")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as rows: a document that the mix takes twice comes twice.

    Rows alike in all columns get the copies of one of them.
    """
    mark = row_name(*docs.columns)
    plan = mix(rated(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark")),
        table(spark, sf_dir, "labels"),
    ))
    copies = plan.where("taken > 0").groupBy("mark").agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("copies"))
    joined = docs.select(mark.alias("mark"), packed(docs).alias("doc")).join(copies, "mark")
    return joined.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("doc.*")


ORACLE = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), q AS (
    SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM d GROUP BY source
), w AS (
    SELECT *, CASE place % 3 WHEN 1 THEN 5.0::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
        2.0::DOUBLE * source_size AS cap FROM s
), l AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()::DOUBLE - coalesce(sum(cap) OVER (
        ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM w
), t AS (
    SELECT source, source_size, round(least(cap, max(level) OVER () * weight), 6) AS target FROM l
), k AS (
    SELECT d.doc_id, d.size, d.source, t.source_size, t.target,
        -ln((('0x' || substr(md5('{SEED}:' || d.doc_id), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496.0::DOUBLE)
        / CASE q.quality WHEN 1 THEN 4.0 WHEN 0 THEN 1.0 ELSE 2.0 END AS key
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN q ON q.doc_id = d.doc_id
), r AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
    FROM k
)
SELECT doc_id, size, source_size, target,
    (size * least(epochs + CASE WHEN before + size / 2.0::DOUBLE <= target - epochs * source_size
        THEN 1 ELSE 0 END, 2))::BIGINT AS taken
FROM r
"""
