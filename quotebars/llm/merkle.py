"""A Merkle manifest of a table as a content-addressed store, and proofs by descent from the root.

The rows of a group (a language) are the leaves of one tree, in the order of their identifiers;
the groups' subroots are the leaves of a second one. Every inner node is a record, digest to
children. A proof is looked up as in any content-addressed store: from the root's digest, the
octal digits of a leaf's rank choose one child after another, the children not chosen are the
proof, and the path is turned round at the end. Leaves below one node share the way to it, so the
descent carries a row for each node and not one for each leaf; the last step meets a run of up to
eight leaves. Digests travel, texts don't: the documents are read once and never shuffled.
"""

from __future__ import annotations

import functools
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotebars.llm.ranks import rank, sort_files
from quotebars.session import scratch_dir

#: children of a node
RUN = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return digest(F.concat(*[framed(v) for v in values]))


def height_of(nodes: int) -> int:
    """Levels above ``nodes`` leaves."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // RUN), levels + 1
    return levels


class Tree(NamedTuple):
    """Trees of one kind on disk: ``leaves`` (tree, rank in it, n leaves of it, leaf and what was kept beside),
    one folder of records (tree, place, n, digest, children) for each height, ``tops`` (tree, digest, height)."""
    spark: SparkSession
    path: str
    height: int

    def leaves(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/leaves")

    def nodes(self, height: int) -> DataFrame:
        if height == 0:
            return self.leaves().select("tree", F.col("rank").alias("place"), "n", F.col("leaf").alias("digest"))
        return self.spark.read.parquet(f"{self.path}/height-{height}")

    def records(self, height: int) -> DataFrame:
        """digest to children, each digest once."""
        return self.nodes(height).groupBy("digest").agg(F.first("children").alias("children"))

    def tops(self) -> DataFrame:
        """(tree, digest, height) of the node that each tree ends in: a lone leaf or a record."""
        return self.spark.read.parquet(f"{self.path}/tops")


def plant(rows: DataFrame, order: list[str], path: str) -> Tree | None:
    """Write the trees of ``rows`` (``tree``, not null; ``leaf``; more columns), each ascending by ``order``.

    The texts are read once, and no tree has to go through one task (``ranks``). A level is one aggregation
    into runs of up to eight."""
    spark = rows.sparkSession
    rank(sort_files(rows, ["tree", *order, "leaf"], path), "tree").write.parquet(f"{path}/leaves")
    largest = spark.read.parquet(f"{path}/leaves").agg(F.max("n")).first()[0]
    if largest is None:
        return None
    tree = Tree(spark, path, height_of(largest))
    for height in range(1, tree.height + 1):
        runs = (tree.nodes(height - 1).where("n > 1")
                .groupBy("tree", F.floor(F.col("place") / RUN).alias("place"))
                .agg(F.max(F.ceil(F.col("n") / RUN)).alias("n"), F.collect_list(F.struct("place", "digest")).alias("run")))
        children = runs.withColumn("children", F.transform(F.array_sort("run"), lambda x: x["digest"])).drop("run")
        children.withColumn("digest", digest(F.array_join("children", ""))).write.parquet(f"{path}/height-{height}")
    ends = [tree.nodes(h).where("n = 1").select("tree", "digest", F.lit(h).alias("height")) for h in range(tree.height + 1)]
    functools.reduce(DataFrame.union, ends).write.parquet(f"{path}/tops")
    return tree


def descend(states: DataFrame, records: DataFrame) -> DataFrame:
    """One level down for every state (tree, place, digest, path): its record's children, each with the
    others, left and right of it, at the end of its path."""
    met = states.join(records, "digest").select("tree", "place", "path", "children", F.posexplode("children").alias("digit", "chosen"))
    return met.select("tree", (F.col("place") * RUN + F.col("digit")).alias("place"), F.col("chosen").alias("digest"),
                      F.concat("path", F.array(others(F.col("children"), F.col("digit")))).alias("path"))


def others(children: Column, digit: Column) -> Column:
    join = lambda x: F.array_join(x, "")
    return F.struct(join(F.slice(children, F.lit(1), digit)).alias("left"),
                    join(F.slice(children, digit + 2, F.greatest(F.size(children) - digit - 1, F.lit(0)))).alias("right"))


def wanted(states: DataFrame, requests: DataFrame | None, height: int) -> DataFrame:
    """The states that have a requested leaf (tree, rank) below them; all without ``requests``."""
    if requests is None:
        return states
    prefixes = requests.select("tree", F.floor(F.col("rank") / RUN ** height).alias("place")).distinct()
    return states.join(prefixes, ["tree", "place"], "left_semi")


def ways_to_subroots(top: Tree) -> DataFrame:
    states = top.tops().select("tree", F.lit(0).cast("long").alias("place"), "digest",
                               F.expr("array()").cast("array<struct<left:string,right:string>>").alias("path"))
    for height in range(top.height, 0, -1):
        states = descend(states, top.records(height))
    named = top.leaves().select(F.col("rank").alias("place"), F.col("group").alias("tree"), "height")
    return states.drop("tree").join(named, "place").select("tree", F.col("digest").alias("subroot"), "height", "path")


class Manifest(NamedTuple):
    groups: Tree
    top: Tree
    root: str
    path: str

    def subroots(self) -> DataFrame:
        """(tree, subroot, height, path): every group's tree with its way from the root."""
        return self.top.spark.read.parquet(f"{self.path}/subroots")

    def prove(self, requests: DataFrame | None = None) -> DataFrame:
        """The leaves, or those of ``requests`` (tree, rank), with what was kept beside them, ``subroot``
        and ``proof``: for every level from the leaf to the root what stands left and right of the node.

        ``requests`` may hold a leaf several times; it is proved once."""
        starts = self.subroots()
        start = starts.select("tree", F.lit(0).cast("long").alias("place"), F.col("subroot").alias("digest"), "path", "height")
        at = lambda h: wanted(start.where(F.col("height") == h).drop("height"), requests, h)
        states = at(self.groups.height)
        for height in range(self.groups.height, 1, -1):
            below = wanted(descend(states, self.groups.records(height)), requests, height - 1)
            states = below.unionByName(at(height - 1))
        own = F.concat(F.array(others(F.col("children"), (F.col("rank") % RUN).cast("int"))), F.reverse("path"))
        if self.groups.height:
            runs = states.join(self.groups.records(1), "digest").select("tree", "place", "path", "children")
            lone = at(0).select("tree", "place", "path", F.lit(None).cast("array<string>").alias("children"))
            runs = runs.unionByName(lone)
        else:
            runs = states.select("tree", "place", "path", F.lit(None).cast("array<string>").alias("children"))
        leaves = self.groups.leaves()
        if requests is not None:
            leaves = leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
        met = leaves.withColumn("place", F.floor(F.col("rank") / RUN)).join(runs, ["tree", "place"])
        proof = F.when(F.col("children").isNull(), F.reverse("path")).otherwise(own)
        named = starts.select("tree", "subroot")
        return met.withColumn("proof", proof).drop("place", "path", "children").join(named, "tree")


def write_manifest(docs: DataFrame, path: str | None = None, fields: tuple[str, ...] = FIELDS, key: str = "doc_id",
                   group: str = "lang", beside: dict[str, Column] | None = None) -> Manifest | None:
    """Write the trees of ``docs`` to ``path`` (a folder of the shared scratch root if not given); None
    for an empty table.

    A leaf is the digest of the framed ``fields``; nulls and empty texts have digests of their own. Leaves
    of one ``group`` ascend by ``key`` (null first, rows of one key by their digests; rows that repeat in
    full are leaves of their own). A null group is a group like any other and comes first among the
    subroots. Further columns are ignored unless ``beside`` names expressions to keep with each leaf."""
    path = path or scratch_dir(docs.sparkSession, "merkle")
    column = lambda c: F.col(f"`{c}`")
    beside = {"key": column(key)} | (beside or {})
    rows = docs.select(framed(column(group)).alias("tree"), leaf_digest([column(f) for f in fields]).alias("leaf"),
                       column(group).alias("group"), *[e.alias(name) for name, e in beside.items()])
    groups = plant(rows, ["key"], f"{path}/groups")
    if groups is None:
        return None
    named = groups.leaves().groupBy("tree").agg(F.first("group").alias("group"))
    subroots = groups.tops().withColumnRenamed("digest", "leaf").join(named, "tree").select(
        F.lit("").alias("tree"), "leaf", F.col("group").alias("ranked"), F.col("tree").alias("group"), "height")
    top = plant(subroots, ["ranked"], f"{path}/top")
    ways_to_subroots(top).write.parquet(f"{path}/subroots")
    return Manifest(groups, top, top.tops().first()["digest"], path)


def proof_text(proof: Column) -> Column:
    return F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), "")


def fold(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` and the proof lead to."""
    return F.aggregate(proof, leaf, lambda node, s: digest(F.concat(s["left"], node, s["right"])))


def tampered(key: str = "doc_id") -> Column:
    """One row in three, by its identifier; never a row without one."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def verify_tampered(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per document: its leaf, subroot, root and the digest of its proof, the root folded from a
    copy whose text is in lower case where ``tampered``, and whether that root is the manifest's."""
    lowered = [F.translate(F.col(f), _UPPER, _LOWER) if f == "text" else F.col(f) for f in FIELDS]
    claimed = F.when(tampered(), leaf_digest(lowered)).otherwise(leaf_digest([F.col(f) for f in FIELDS]))
    manifest = write_manifest(docs, path, beside={"claimed": claimed})
    if manifest is None:
        text = [F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")]
        return docs.select("doc_id", *text, F.lit(True).alias("verified")).limit(0)
    rows = manifest.prove().withColumn("folded_root", fold(F.col("claimed"), F.col("proof")))
    root = F.lit(manifest.root)
    return rows.select(F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"),
                       digest(proof_text(F.col("proof"))).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == root).alias("verified"))
