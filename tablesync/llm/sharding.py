"""Balanced label propagation: linked documents gather in one shard, shards keep even sizes.

Every node starts in a shard by hash. In each round a node looks at its neighbours' shards,
a join of the links with the shards; neighbours count by their number of links. A node that
would gain asks to move, and a shard admits by hash as large a part of those who ask as its
quota leaves room for. The best linked node of a neighbourhood keeps its seat unless its shard
had to refuse some; then it may take a new seat where there is room, and the others follow. At the end rows are put in the order (shard, group, id), and the
running total of the sizes is cut into equal parts. A group smaller than SNAP of a shard goes
whole to the side where its middle lies; larger ones are cut between documents.

Only DataFrame functions. The driver sees one row per shard and per pair of shards.

Defined results: a null text has no bytes and counts as empty for groups; null ids and rows
repeated under one id are placed like others (one id is one node of the links); an empty
table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import running, saved, table

SHARDS = 16
ROUNDS = 8
#: By how much a shard may pass its share while labels move; the cut at the end evens sizes out.
SLACK = 0.25
SNAP = 0.01


def propagate(nodes: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS,
              slack: float = SLACK) -> DataFrame:
    """Shards of ``nodes`` (id, size) after moving along ``links`` (a, b, weight).

    Returns (id, size, label). Ends early when a round moves nothing.
    """
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
    degrees = both.groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("degree"))
    arcs = saved(both, "arcs")
    around = arcs.join(degrees.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
        F.max(F.struct("degree", (-F.col("b")).alias("b"))).alias("top"), F.sum("weight").alias("degree"))
    first = F.coalesce(F.struct("degree", (-F.col("id")).alias("b")) > F.col("top"), F.lit(False))
    label = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    state = saved(nodes.join(around, "id", "left").select(
        "id", "size", F.coalesce("degree", F.lit(0.0)).alias("degree"), first.alias("first"), label.alias("label")),
        "labels")
    quota = (1 + slack) * (state.agg(F.sum("size")).first()[0] or 0) / shards
    for turn in range(rounds):
        seen = state.select(F.col("id").alias("b"), "label", "degree")
        votes = arcs.join(seen, "b").groupBy("a", "label").agg(
            F.sum(F.col("weight") * F.col("degree")).alias("pull"), F.min("b").alias("least"))
        wish = votes.groupBy(F.col("a").alias("id")).agg(
            F.max(F.struct("pull", (-F.col("label")).alias("back"), "least")).alias("best"))
        asking = saved(
            state.join(wish, "id").select("id", "size", "label", "degree", (-F.col("best.back")).alias("to"),
                                          F.col("best.pull").alias("pull"), F.col("best.least").alias("least"))
            .where("to != label and (pull > degree or pull = degree and id > least)")
            .select("id", "size", "label", "to"), "asking")
        flows = {(r["label"], r["to"]): r["size"] for r in asking.groupBy("label", "to").agg(
            F.sum("size").alias("size")).collect()}
        if not flows:
            break
        held = {r["label"]: r["size"] for r in state.groupBy("label").agg(F.sum("size").alias("size")).collect()}
        part = admission(flows, held, quota, shards)
        room = [max(0.0, quota - held.get(s, 0)) if part[s] > 0.999 or not any(to == s for _, to in flows) else 0.0
                for s in range(shards)]
        if max(part) < 0.01 and not any(room):
            break
        moves = asking.where(_lot("id", turn) < F.element_at(F.array(*[F.lit(a) for a in part]), F.col("to") + 1))
        # seats that have to be given up, and where to: a shard with room, by its share of it
        refused = {s for _, s in flows if part[s] <= 0.999}
        leaves = F.array(*[F.lit(1 - part[s] if s in refused else 0.0) for s in range(shards)])
        seats = _pick("id", turn + rounds, room)
        gives_up = F.col("first") & (_lot("id", turn + 2 * rounds) < F.element_at(leaves, F.col("label") + 1))
        state = saved(state.join(moves.select("id", "to"), "id", "left").select(
            "id", "size", "degree", "first",
            F.coalesce("to", F.when(gives_up, seats), "label").alias("label")), "labels")
    return state.select("id", "size", "label")


def _lot(column: str, turn: int) -> Column:
    """A number in [0, 1) for an id and a turn."""
    return F.pmod(F.xxhash64(column, F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)


def _pick(column: str, turn: int, room: list[float]) -> Column:
    """A shard by lot, each with the chance of its share of the room; null if there is none."""
    choice, ahead = F.lit(None).cast("int"), 0.0
    for s, part in enumerate(room):
        if part:
            ahead += part / sum(room)
            choice = F.coalesce(choice, F.when(_lot(column, turn) < ahead + 1e-9, F.lit(s)))
    return choice


def admission(flows: dict[tuple[int, int], int], held: dict[int, int], quota: float, shards: int) -> list[float]:
    """The part of those asking that each shard admits, so that what leaves makes room for what comes.

    Lowered step by step from 1 until no shard passes its quota; a few numbers per shard.
    """
    wanted = [sum(size for (_, to), size in flows.items() if to == s) for s in range(shards)]
    part = [1.0] * shards
    for _ in range(50):
        leaving = [sum(size * part[to] for (at, to), size in flows.items() if at == s) for s in range(shards)]
        part = [min(part[s], max(0.0, (quota - held.get(s, 0) + leaving[s]) / wanted[s])) if wanted[s] else 0.0
                for s in range(shards)]
    return part


def copies_as_links(rows: DataFrame, group: str, limit: float) -> DataFrame:
    """Links (a, b, weight) from each id to the smallest id of its group.

    A group of more than ``limit`` bytes cannot stay in one shard and is linked in parts.
    """
    sizes = rows.groupBy(group).agg(F.sum("size").alias("_bytes"), F.count("*").alias("_n")).where("_n > 1")
    parts = F.ceil(F.col("_bytes") / F.lit(max(limit, 1.0)))
    member = rows.where("doc_id is not null").join(sizes, group).select(
        group, "doc_id", F.pmod(F.xxhash64("doc_id"), parts).alias("_part"))
    first = member.groupBy(group, "_part").agg(F.min("doc_id").alias("b"))
    return member.join(first, [group, "_part"]).where("doc_id != b").select(
        F.col("doc_id").alias("a"), "b", F.lit(1.0).alias("weight")).distinct()


def shard(rows: DataFrame, links: DataFrame | None = None, shards: int = SHARDS) -> DataFrame:
    """Place ``rows`` (doc_id, size, group and others kept): adds shard and slot.

    Without links, equal values of ``group`` are linked.
    """
    rows = saved(rows, "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    if links is None:
        links = copies_as_links(rows, "group", 0.8 * total / shards)
    nodes = rows.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(F.sum("size").alias("size"))
    labels = propagate(nodes, links, shards).select(F.col("id").alias("doc_id"), "label")
    ordered = rows.join(labels, "doc_id", "left").select(
        *rows.columns, F.coalesce("label", F.lit(0)).alias("label"), F.lit(1).alias("one"),
        F.xxhash64("doc_id").alias("lot"))
    placed = running(saved(ordered, "ordered"), ["label", "group", "lot"], ["size", "one"])
    placed = saved(placed, "placed")
    runs = placed.groupBy("label", "group").agg(
        F.min("before_size").alias("run_before"), F.sum("size").alias("run_size"), F.count("*").alias("_n")).where(
        (F.col("_n") > 1) & (F.col("run_size") <= SNAP * total / shards)).drop("_n")
    middle = F.coalesce(F.col("run_before") + F.col("run_size") / 2.0, F.col("before_size") + F.col("size") / 2.0)
    part = F.floor(middle * F.lit(float(shards)) / F.lit(float(max(total, 1))))
    cut = saved(placed.join(runs, ["label", "group"], "left").withColumn(
        "shard", F.least(part, F.lit(shards - 1)).cast("int")), "cut")
    starts = cut.groupBy("shard").agg(F.min("before_one").alias("start"))
    return cut.join(F.broadcast(starts), "shard").select(
        *rows.columns, "shard", (F.col("before_one") - F.col("start")).cast("long").alias("slot"))


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_documents(table(spark, sf_dir, "documents"))


def place_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The law is ``bytes``: bytes are near equal, and equal texts share a shard where they fit."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), F.md5(text).alias("group"))
    return shard(rows, shards=shards).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: a row per document that is left, with its shard and slot."""
    return place_documents(docs)
