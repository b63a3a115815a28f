"""Merkle manifest of a dataset: a content-addressed store of nodes, and proofs by descent.

Rows are leaves of a tree per group (the language); the roots of the trees, in order of the
group, are the leaves of an upper tree, whose root names the dataset. A node is the digest of
its children's digests, ``fanout`` at a time; a last run may be shorter, even one.

* **Ranks.** Leaves alike in group, id and digest are one row with a number of copies. A running
  total over ranges of (group, id, digest) ranks them, so a group of any size is shared by many tasks.
* **Store.** ``depth`` levels of a tree are a segment, made by one task from at most
  ``fanout ** depth`` nodes. Its record maps the digest of its top to the digests at its bottom;
  the tops are the nodes of the next pass, until a tree has one segment left. Records are kept
  once per digest: alike segments are one record.
* **Descent.** Requests start at the root with an empty path. In each pass they look up the
  record of the digest they have reached, follow the digits of their rank (in base ``fanout``) from
  its top to its bottom, and collect the children they do not select. Requests that share the
  leading digits share that part: only distinct prefixes descend through the upper passes, and
  leaves meet their segment in the last. The path, reversed, is the proof from leaf to root.

A task holds one segment and its requests. The number of passes grows with the logarithm of the
largest tree; what comes to the driver is the root.

Defined results: null fields are ``-`` in a leaf; a null group is a tree of its own, before all
others; null ids come first and are never tampered with; ties are ordered by leaf, and rows alike
in every field have a proof each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import carried, running, saved, table

FANOUT = 2
DEPTH = 10
HEX = 64
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
#: The tree of the null group; any other group's tree is named by OF and the group.
NULL_TREE, OF = "0", "1"
UPPER = "roots"

carried(__name__)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


# leaves


def leaf_of(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each ``-`` if null, else its bytes, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    parts = [F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
             for t in texts]
    return F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256)


def tree_of(group: Column) -> Column:
    """The name of a group's tree: not null, and in the order of the groups with null first."""
    return F.when(group.isNull(), F.lit(NULL_TREE)).otherwise(F.concat(F.lit(OF), group.cast("string")))


# store


def levels_above(nodes: list[str], fanout: int, levels: int | None = None) -> list[list[str]]:
    """``nodes`` and the levels above them: so many, or until one node is left."""
    found = [nodes]
    while len(found[-1]) > 1 if levels is None else len(found) <= levels:
        below = found[-1]
        found.append([digest("".join(below[i:i + fanout])) for i in range(0, len(below), fanout)])
    return found


RECORD = "tree string, index long, digest string, top string, levels int, children string"


def _segment(fanout: int, depth: int) -> Callable:
    """The record of one segment: its digest ``depth`` levels up, and where one node is left."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        nodes = [d for d, n in zip(rows["node"], rows["copies"]) for _ in range(n)]
        found = levels_above(nodes, fanout)
        top = found[-1][0]
        full = levels_above([top], fanout, depth - (len(found) - 1))[-1][0]
        return pd.DataFrame([(rows["tree"].iloc[0], rows["index"].iloc[0], full, top, len(found) - 1, "".join(nodes))],
                            columns=["tree", "index", "digest", "top", "levels", "children"])

    return run


def pieces(nodes: DataFrame, width: int) -> DataFrame:
    """Rows that stand for ``copies`` nodes from ``rank`` on, cut at the segments: with index and place."""
    spread = nodes.withColumn("index", F.explode(F.sequence(
        F.expr(f"rank div {width}"), F.expr(f"(rank + copies - 1) div {width}"))))
    first = F.greatest("rank", F.col("index") * width)
    end = F.least(F.col("rank") + F.col("copies"), (F.col("index") + 1) * width)
    return spread.withColumns({"place": first - F.col("index") * width, "copies": (end - first).cast("long")})


class Store:
    """The records of a forest, a table per pass, and the root of each of its trees.

    ``nodes`` has (tree, rank, node, copies): ranks count from 0 in each tree.
    """

    def __init__(self, nodes: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> None:
        if fanout < 2 or depth < 1:
            raise ValueError("a node has at least two children, a segment at least a level")
        self.fanout, self.depth, self.width = fanout, depth, fanout ** depth
        self.passes: list[DataFrame] = []
        self.roots: list[DataFrame] = []
        while True:
            cut = pieces(nodes, self.width).select("tree", "index", "place", "copies", "node")
            made = saved(cut.groupBy("tree", "index").applyInPandas(_segment(fanout, depth), RECORD), "segments")
            several = made.where("index = 1").select("tree").distinct()
            whole = made.where("index = 0").join(several, "tree", "left_anti")
            rest = made.join(several, "tree", "left_semi")
            self.roots.append(saved(whole.select("tree", F.col("top").alias("root")), "roots"))
            self.passes.append(saved(
                whole.select(F.col("top").alias("digest"), "levels", "children").union(
                    rest.select("digest", F.lit(depth).alias("levels"), "children")).dropDuplicates(["digest"]),
                "store"))
            nodes = rest.select("tree", F.col("index").alias("rank"), F.lit(1).cast("long").alias("copies"),
                                F.col("digest").alias("node"))
            if several.isEmpty():
                break

    def all_roots(self) -> DataFrame:
        """One row (tree, root) per tree."""
        found = self.roots[0]
        for more in self.roots[1:]:
            found = found.union(more)
        return found

    def descend(self, requests: DataFrame, starts: DataFrame, answer: Callable, schema: str) -> DataFrame:
        """Answer requests (tree, rank, copies and others) for leaves by descent from ``starts`` (tree, path).

        ``answer`` makes the rows of a request (as a dict) from its rank and its path: strings
        ``digit:siblings``, one per level from the root down, in which siblings lie left to right.
        """
        frontier = None
        for at in range(len(self.passes) - 1, -1, -1):
            entering = self.roots[at].join(starts, "tree").select(
                "tree", F.lit(0).cast("long").alias("index"), F.col("root").alias("digest"), "path", "root")
            frontier = entering if frontier is None else entering.union(frontier)
            records = frontier.join(self.passes[at], "digest")
            if at:
                asked = requests.select("tree", F.explode(F.sequence(
                    F.expr(f"rank div {self.width ** at}"), F.expr(f"(rank + copies - 1) div {self.width ** at}"))).alias(
                        "rank")).distinct().withColumn("copies", F.lit(1).cast("long"))
                step, out = _next, FRONTIER
            else:
                asked, step, out = requests, answer, schema
            met = pieces(asked, self.width).groupBy("tree", "index").cogroup(records.groupBy("tree", "index"))
            frontier = met.applyInPandas(_descent(self.fanout, step, out), out)
            if at:
                frontier = saved(frontier, "frontier")
        return frontier


FRONTIER = "tree string, index long, digest string, path array<string>, root string"


def _next(request: dict, rank: int, node: str, path: list[str], root: str) -> tuple:
    return request["tree"], rank, node, path, root


def segment_path(found: list[list[str]], place: int, fanout: int) -> list[str]:
    """From the top of a segment down to the node at ``place``: the digit taken and the children not selected."""
    path = []
    for level in range(len(found) - 1, 0, -1):
        at = place // fanout ** (level - 1)
        run = found[level - 1][at - at % fanout:at - at % fanout + fanout]
        digit = at % fanout
        path.append(f"{digit}:{''.join(run[:digit] + run[digit + 1:])}")
    return path


def _descent(fanout: int, answer: Callable, schema: str) -> Callable:
    names = [field.split()[0] for field in schema.split(", ")]

    def run(requests: pd.DataFrame, records: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(requests) and len(records):
            record = records.iloc[0]
            nodes = [record["children"][i:i + HEX] for i in range(0, len(record["children"]), HEX)]
            found, above = levels_above(nodes, fanout, int(record["levels"])), list(record["path"])
            base = int(record["index"]) * fanout ** (len(found) - 1)
            for request in requests.to_dict("records"):
                for place in range(request["place"], request["place"] + request["copies"]):
                    path = above + segment_path(found, place, fanout)
                    rows.append(answer(request, base + place, nodes[place], path, record["root"]))
        return pd.DataFrame(rows, columns=names)

    return run


def siblings(path: list[str]) -> str:
    """The siblings of a path from the leaf up, left to right in each level."""
    return "".join(level.partition(":")[2] for level in reversed(path))


def folded(leaf: str, path: list[str]) -> str:
    """The root that a leaf and the siblings of a path give."""
    node = leaf
    for level in reversed(path):
        digit, _, others = level.partition(":")
        cut = HEX * int(digit)
        node = digest(others[:cut] + node + others[cut:])
    return node


# a manifest of a forest


def _upper(request: dict, rank: int, node: str, path: list[str], root: str) -> tuple:
    return request["name"], path


PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
         "rank long, path array<string>")


def _proof(root: str) -> Callable:
    def run(request: dict, rank: int, node: str, path: list[str], subroot: str) -> tuple:
        shown = request["shown"] or request["node"]
        key = request["key"]  # text: a long column with nulls would come as floats
        return (None if key is None else int(key), node, subroot, root, digest(siblings(path)), folded(shown, path),
                rank, path)

    return run


def manifest(leaves: DataFrame, fanout: int = FANOUT, depth: int = DEPTH) -> DataFrame:
    """Proofs of all leaves (tree, doc_id, node, shown): ``shown`` is what is verified, null for the leaf itself."""
    alike = leaves.groupBy("tree", "doc_id", "node", "shown").agg(F.count("*").alias("copies"))
    ranked = saved(running(alike, ["doc_id", "node"], ["copies"], by=["tree"]).withColumnRenamed(
        "before_copies", "rank"), "leaves")
    trees = Store(ranked, fanout, depth)
    names = trees.all_roots().select(F.lit(UPPER).alias("tree"), F.col("tree").alias("name"), F.col("root").alias("node"),
                                     F.lit(1).cast("long").alias("copies"))
    upper_nodes = saved(running(names, ["name"], ["copies"], by=["tree"]).withColumnRenamed(
        "before_copies", "rank"), "names")
    upper = Store(upper_nodes, fanout, depth)
    top = upper.all_roots().first()
    if top is None:
        return leaves.sparkSession.createDataFrame([], PROOF)
    start = upper.all_roots().select("tree", F.array().cast("array<string>").alias("path"))
    starts = saved(upper.descend(upper_nodes, start, _upper, "tree string, path array<string>"), "starts")
    requests = ranked.select("tree", "rank", "copies", "node", "shown", F.col("doc_id").cast("string").alias("key"))
    return trees.descend(requests, starts, _proof(top["root"]), PROOF)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its proof, recomputed from a tampered leaf for some."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 == 0
    raised = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    leaves = docs.select(
        tree_of(F.col("lang")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
        leaf_of([F.col(c) for c in FIELDS]).alias("node"),
        F.when(tampered & F.col("n_chars").isNotNull(),
               leaf_of([raised if c == "n_chars" else F.col(c) for c in FIELDS])).alias("shown"))
    return manifest(leaves).select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                   (F.col("folded_root") == F.col("root")).alias("verified"))


_FIELD = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
_LEAF = " || ".join(_FIELD.format(c) for c in FIELDS)
_CHANGED = " || ".join(_FIELD.format("(n_chars + 1)" if c == "n_chars" else c) for c in FIELDS)

ORACLE = f"""
WITH RECURSIVE polynomial AS (
    SELECT list(c ORDER BY b) AS crc FROM (
        SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) AS c
        FROM (SELECT unnest(range(256)) AS b))
), marked AS (
    SELECT doc_id, lang, sha256({_LEAF}) AS leaf,
        xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''),
            lambda x: ascii(x)::BIGINT)), lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS tampered,
        sha256({_CHANGED}) AS changed
    FROM documents, polynomial
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS rank FROM marked
), tree(lang, level, i, node, n) AS (
    SELECT lang, 0, rank, leaf, count(*) OVER (PARTITION BY lang) FROM leaves
    UNION ALL
    SELECT lang, level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2
    FROM tree WHERE n > 1 GROUP BY lang, level, i // 2, n
), subroots AS (
    SELECT lang, level AS height, node AS subroot,
        row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place, count(*) OVER () AS trees
    FROM tree WHERE n = 1
), upper(level, i, node, n) AS (
    SELECT 0, place, subroot, trees FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(node, '' ORDER BY i)), (n + 1) // 2
    FROM upper WHERE n > 1 GROUP BY level, i // 2, n
), fold(doc_id, lang, rank, level, i, node, proof) AS (
    SELECT doc_id, lang, rank, 0, rank,
        CASE WHEN tampered AND n_chars IS NOT NULL THEN changed ELSE leaf END, ''
    FROM leaves JOIN (SELECT doc_id, n_chars FROM documents) USING (doc_id)
    UNION ALL
    SELECT f.doc_id, f.lang, f.rank, f.level + 1, f.i // 2,
        sha256(CASE WHEN f.i % 2 = 1 THEN t.node || f.node ELSE f.node || coalesce(t.node, '') END),
        f.proof || coalesce(t.node, '')
    FROM fold f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang
    LEFT JOIN tree t ON t.lang IS NOT DISTINCT FROM f.lang AND t.level = f.level AND t.i = xor(f.i, 1)
    WHERE f.level < s.height
), above(doc_id, rank, lang, level, i, node, proof) AS (
    SELECT f.doc_id, f.rank, f.lang, 0, s.place, f.node, f.proof
    FROM fold f JOIN subroots s ON f.lang IS NOT DISTINCT FROM s.lang WHERE f.level = s.height
    UNION ALL
    SELECT a.doc_id, a.rank, a.lang, a.level + 1, a.i // 2,
        sha256(CASE WHEN a.i % 2 = 1 THEN u.node || a.node ELSE a.node || coalesce(u.node, '') END),
        a.proof || coalesce(u.node, '')
    FROM above a LEFT JOIN upper u ON u.level = a.level AND u.i = xor(a.i, 1)
    WHERE a.level < (SELECT max(level) FROM upper)
), root AS (SELECT node AS root FROM upper WHERE n = 1)
SELECT l.doc_id, l.leaf, s.subroot, root.root, sha256(a.proof) AS proof_sha256, a.node AS folded_root,
    a.node = root.root AS verified
FROM above a JOIN leaves l ON l.doc_id = a.doc_id AND l.rank = a.rank AND l.lang IS NOT DISTINCT FROM a.lang
JOIN subroots s ON s.lang IS NOT DISTINCT FROM a.lang, root
WHERE a.level = (SELECT max(level) FROM upper)
"""
