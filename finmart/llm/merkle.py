"""Merkle manifest of a dataset: a postorder append log of tree nodes, and proofs read from it.

A leaf is the SHA-256 of a row's columns. The leaves of a group (a language) stand in the order of
their ids; every run of ``FAN`` = 8 consecutive nodes, the last run shorter, has as parent the
SHA-256 of their digests as hex text, level by level until one node, the group's subroot, is left.
The subroots in the order of their groups are the leaves of one more tree of the same form, whose
top is the dataset's root.

Aligned builders each take 8^4 consecutive nodes of one level and write the nodes above them in the
order in which they are completed; what a builder ends with is a leaf of the builders of the next
round. The place of a node in the postorder log of its tree has a closed form: a full subtree of
height h has ``span(h)`` = (8^(h+1)-1)/7 nodes, so node j of level h stands at

    j * span(h)  +  sum of j // 8^k over k >= 1  +  (nodes below it)

and only the last node of a level has fewer nodes below it, which follow from the number of leaves.
A reader that holds the log's (tree, place, digest) rows finds the siblings of any node by that
arithmetic alone. Proofs are extracted block by block: a block of leaves is joined with the places
of its own subtree and of the siblings of the nodes above it, all computed, none searched.

Defined results: a NULL column enters a leaf as ``-``; NULL groups come first, other groups in UTF-8
byte order; NULL ids come first; rows with equal ids stand in the order of their leaves, so repeated
rows make equal leaves side by side; a lone leaf is its own subroot and a lone subroot the root; no
rows make no root. Very long texts are only ever hashed by Spark's own function, extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_bucket, land

FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Levels that one builder spans: 8^4 = 4,096 nodes in, 585 out.
BUILDER_LEVELS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree above the subroots; groups have names of at least one character.
ROOT_TREE = ""
LOG = "tree string, place long, level int, node long, digest string"


# --- arithmetic of the postorder log -------------------------------------------------------------

def height(leaves: int) -> int:
    """The level of the top node."""
    h = 0
    while leaves > 1:
        leaves = -(-leaves // FAN)
        h += 1
    return h


def nodes_at(leaves: int, level: int) -> int:
    return -(-leaves // FAN ** level)


def span(level: int) -> int:
    """Nodes of a full subtree of that height."""
    return (FAN ** (level + 1) - 1) // (FAN - 1)


def place(leaves: int, level: int, node: int) -> int:
    """Position (from 0) of a node in the postorder log of a tree of so many leaves."""
    closed, k = 0, node // FAN     # nodes of higher levels that were completed before
    while k:
        closed += k
        k //= FAN
    if node + 1 < nodes_at(leaves, level):
        size = span(level)
    else:                          # the last node of its level: what lies below it may be ragged
        size = sum(nodes_at(leaves, low) - node * FAN ** (level - low) for low in range(level + 1))
    return node * span(level) + closed + size - 1


def siblings(leaves: int, level: int, node: int) -> list[int]:
    """The other nodes of the run that has the same parent."""
    first = node - node % FAN
    return [k for k in range(first, min(first + FAN, nodes_at(leaves, level))) if k != node]


def hash_text(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- leaves --------------------------------------------------------------------------------------

def leaf(columns: Iterable[Column]) -> Column:
    """SHA-256 of columns: ``-`` for NULL, else the number of UTF-8 bytes, a colon, the value."""
    parts = []
    for c in columns:
        c = c.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, tampered: Column, columns: Iterable[str] = COLUMNS,
           id_col: str = "doc_id", group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, tree, leaf, changed): ``changed`` is the leaf after tampering (A-Z of the text in
    lower case) where ``tampered`` holds, else NULL. ``tree`` is the group, with one character in
    front of it that tells a NULL group (first in the order) from all others."""
    def made(text: Column) -> Column:
        return leaf(text if c == text_col else F.col(c) for c in columns)

    lower = F.translate(F.col(text_col).cast("string"), UPPER, LOWER)
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.concat(F.lit("1"), F.col(group_col).cast("string")), F.lit("0")).alias("tree"),
        made(F.col(text_col)).alias("leaf"), F.when(tampered, made(lower)).alias("changed"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``node``, a row's position inside its tree by ``order``, and ``leaves``, the tree's size.

    Rows are spread by ranges of (tree, *order), so that a tree with most of the rows covers many
    tasks; positions are counted inside a task and shifted by the counts of the tasks before. Rows
    that are equal in all of ``order`` are told apart by where they stood.
    """
    columns = rows.columns
    rows = land(rows.withColumn("__n", F.monotonically_increasing_id()), "rows")
    order = ["tree", *order, "__n"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = land(ranged.withColumn("__at", F.monotonically_increasing_id())
                  .withColumn("__task", F.spark_partition_id()).drop("__n"), "ranged")
    runs = tagged.groupBy("tree", "__task").agg(F.min("__at").alias("first"),
                                                F.count(F.lit(1)).alias("rows"))
    before = Window.partitionBy("tree").orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("tree", "__task", "first",     # one row a task and tree
                       F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("shift"),
                       F.sum("rows").over(Window.partitionBy("tree")).alias("leaves"))
    return tagged.join(runs, ["tree", "__task"]).select(
        *columns, (F.col("__at") - F.col("first") + F.col("shift")).alias("node"), "leaves")


# --- the log -------------------------------------------------------------------------------------

class Builder:
    """Takes consecutive nodes of one level and yields (level, node, digest) of every node above
    them, in the order of completion. It holds at most eight digests a level."""

    def __init__(self, leaves: int, base: int):
        self.top = min(height(leaves), base + BUILDER_LEVELS)
        self.base = base
        self.open: list[list[str]] = [[] for _ in range(base, self.top + 1)]
        self.next: list[int | None] = [None] * len(self.open)

    def _close(self, k: int) -> Iterator[tuple[int, int, str]]:
        """The parent of the open run of level base + k."""
        digest, node = hash_text(self.open[k]), self.next[k] >> FAN_BITS
        self.open[k] = []
        yield self.base + k + 1, node, digest
        yield from self._add(k + 1, node, digest)

    def _add(self, k: int, node: int, digest: str) -> Iterator[tuple[int, int, str]]:
        self.open[k].append(digest)
        self.next[k] = node
        if self.base + k < self.top and (node + 1) % FAN == 0:
            yield from self._close(k)

    def add(self, node: int, digest: str) -> Iterator[tuple[int, int, str]]:
        yield from self._add(0, node, digest)

    def finish(self) -> Iterator[tuple[int, int, str]]:
        """Close the ragged runs at the end of the tree, lowest first."""
        for k in range(self.top - self.base):
            if self.open[k]:
                yield from self._close(k)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (tree, leaves, level, node, digest), sorted by tree and node, whole blocks."""
    def rows():
        for b in batches:
            yield from zip(*(c.to_pylist() for c in b.columns))

    out: list[tuple] = []
    shift = FAN_BITS * BUILDER_LEVELS
    for (tree, n, base, _), block in groupby(rows(), key=lambda r: (*r[:3], r[3] >> shift)):
        builder = Builder(n, base)
        for *_, node, digest in block:
            out += [(tree, place(n, level, k), level, k, d) for level, k, d in builder.add(node, digest)]
        out += [(tree, place(n, level, k), level, k, d) for level, k, d in builder.finish()]
        if len(out) > 20_000:
            yield _batch(out)
            out = []
    if out:
        yield _batch(out)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string()]
    names = [c.split()[0] for c in LOG.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)


def _leaf_place(leaves: Column, node: Column) -> Column:
    @F.pandas_udf("long")
    def leaf_place(n: pd.Series, k: pd.Series) -> pd.Series:
        return pd.Series([place(a, 0, b) for a, b in zip(n.tolist(), k.tolist())], dtype="int64")
    return leaf_place(leaves, node)


def build_log(nodes: DataFrame) -> DataFrame:
    """The log of trees given by their leaves (tree, leaves, node, digest). Each round of builders
    is landed; its rows are a seventh of those of the round's input."""
    log = land(nodes.select("tree", _leaf_place(F.col("leaves"), F.col("node")).alias("place"),
                            F.lit(0).alias("level"), "node", "digest"), "log")
    sizes = land(nodes.select("tree", "leaves").distinct(), "trees")
    top = height(sizes.agg(F.max("leaves")).first()[0] or 0)
    last = log
    for base in range(0, top, BUILDER_LEVELS):
        block = F.shiftright("node", FAN_BITS * BUILDER_LEVELS)
        at = last.filter(F.col("level") == base).join(sizes, "tree") \
            .filter(F.col("leaves") > FAN ** base) \
            .select("tree", "leaves", "level", "node", "digest")
        dealt = at.repartition("tree", block).sortWithinPartitions("tree", "node")
        last = land(dealt.mapInArrow(_build, LOG), "log")
        log = log.unionByName(last)
    return log


# --- manifest and proofs -------------------------------------------------------------------------

@dataclass
class Manifest:
    """``members`` (id, tree, leaf, changed, node, leaves), ``groups`` (tree, subroot, node, leaves:
    the leaves of the tree of groups; size: the tree's own), the ``log`` of all trees (``LOG``), and
    the ``root`` digest, None without rows."""

    members: DataFrame
    groups: DataFrame
    log: DataFrame
    root: str | None


def build(docs: DataFrame, tampered: Column, **names) -> Manifest:
    """The manifest of a dataset; ``names`` as in ``leaves``."""
    members = land(numbered(leaves(docs, tampered, **names), ["id", "leaf"]), "members")
    log = build_log(members.select("tree", "leaves", "node", F.col("leaf").alias("digest")))
    sizes = members.select("tree", F.col("leaves").alias("size")).distinct()
    subroots = log.groupBy("tree").agg(F.max_by("digest", "place").alias("subroot")).join(sizes, "tree")
    groups = numbered(subroots.select(F.lit(ROOT_TREE).alias("tree"), F.col("tree").alias("name"),
                                      "subroot", "size"), ["name"])
    groups = land(groups.withColumnRenamed("tree", "above").withColumnRenamed("name", "tree"), "groups")
    above = build_log(groups.select(F.col("above").alias("tree"), "leaves", "node",
                                    F.col("subroot").alias("digest")))
    root = above.agg(F.max_by("digest", "place")).first()[0]
    return Manifest(members, groups.drop("above"), log.unionByName(above), root)


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows (tree, block, size, node, leaves): the places outside of a block's own subtree that
    its proofs need, as (tree, block, log tree, place)."""
    for b in batches:
        out = []
        for tree, block, size, node, n in zip(*(c.to_pylist() for c in b.columns)):
            out += [(tree, block, tree, p) for p in path_places(size, BUILDER_LEVELS, block)]
            out += [(tree, block, ROOT_TREE, p) for p in path_places(n, 0, node)]
        columns = list(zip(*out)) or [[]] * 4
        kinds = [pa.string(), pa.int64(), pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         names=["of_tree", "block", "tree", "place"])


def path_places(leaves: int, level: int, node: int) -> Iterator[int]:
    """Places of the siblings on the way from a node to the top."""
    while level < height(leaves):
        for k in siblings(leaves, level, node):
            yield place(leaves, level, k)
        level, node = level + 1, node >> FAN_BITS


PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def _prove(key, members: pa.Table, nodes: pa.Table) -> pa.Table:
    """Proofs of one block of leaves from the log rows that were sent to it."""
    digest = {(t, p): d for t, p, d in zip(*(nodes[c].to_pylist() for c in ("in_tree", "place", "digest")))}
    known: dict[tuple[str, int, int], tuple[dict, ...]] = {}

    def path(tree: str, n: int, level: int, node: int) -> tuple[dict, ...]:
        if level >= height(n):
            return ()
        if (tree, level, node) not in known:
            around = siblings(n, level, node)
            found = [digest[tree, place(n, level, k)] for k in around]
            left = node % FAN
            step = {"before": "".join(found[:left]), "after": "".join(found[left:])}
            known[tree, level, node] = (step, *path(tree, n, level + 1, node >> FAN_BITS))
        return known[tree, level, node]

    out = [path(tree, n, 0, node) + path(ROOT_TREE, above, 0, rank) for tree, n, node, above, rank in
           zip(*(members[c].to_pylist() for c in ("tree", "leaves", "node", "above", "rank")))]
    return pa.table({"id": members["id"], "leaf": members["leaf"], "changed": members["changed"],
                     "subroot": members["subroot"], "path": pa.array(out, PATH)})


def proofs(manifest: Manifest, members: DataFrame | None = None) -> DataFrame:
    """(id, leaf, changed, subroot, path) for all members, or for those given. ``path`` has a step
    for each level up to the root: the joined digests of the run's siblings before and after.

    A block of 8^4 leaves reads its own stretch of the log, where levels below the fourth lie
    together, and the computed places of the siblings above it.
    """
    members = manifest.members if members is None else members
    shift = FAN_BITS * BUILDER_LEVELS
    blocks = members.groupBy("tree", F.shiftright("node", shift).alias("block")).agg(F.first("leaves").alias("size"))
    above = manifest.groups.select("tree", "subroot", F.col("node").alias("rank"), F.col("leaves").alias("above"))
    blocks = land(blocks.join(above, "tree"), "blocks")
    wanted = blocks.select("tree", "block", "size", "rank", "above") \
        .mapInArrow(_wanted, "of_tree string, block long, tree string, place long")
    far = wanted.join(manifest.log.select("tree", "place", "digest"), ["tree", "place"]) \
        .select(F.col("of_tree").alias("tree"), "block", F.col("tree").alias("in_tree"), "place", "digest")
    near = manifest.log.filter((F.col("level") < BUILDER_LEVELS) & (F.col("tree") != ROOT_TREE)) \
        .select("tree", F.expr(f"shiftright(node, {FAN_BITS} * ({BUILDER_LEVELS} - level))").alias("block"),
                F.col("tree").alias("in_tree"), "place", "digest")
    asked = members.withColumn("block", F.shiftright("node", shift)) \
        .join(blocks.drop("size"), ["tree", "block"])
    return asked.groupBy("tree", "block").cogroup(near.unionByName(far).groupBy("tree", "block")) \
        .applyInArrow(_prove, "id long, leaf string, changed string, subroot string, "
                              "path array<struct<before string, after string>>")


def proof_digest(path: Column) -> Column:
    """SHA-256 of all sibling digests of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def fold(leaf_digest: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf_digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def prove_documents(docs: DataFrame, id_col: str = "doc_id", one_in: int = 3) -> DataFrame:
    """Build the manifest, then prove every row of it; the rows whose crc32(id) is divisible by
    ``one_in`` are tampered with before they are verified."""
    manifest = build(docs, crc_bucket(id_col, one_in) == 0, id_col=id_col)
    root = F.lit(manifest.root)
    return proofs(manifest).select(
        F.col("id").alias("doc_id"), "leaf", "subroot", root.alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"),
        fold(F.coalesce("changed", "leaf"), F.col("path")).alias("folded_root")) \
        .withColumn("verified", F.col("folded_root") == F.col("root"))
