"""Merkle manifest of a dataset: a hash tree per source, and one tree over the sources.

A document is a leaf; its digest covers the fields of the row, each with its length, so
that no two rows are written alike. Leaves of one source ascend by doc_id. A level holds
(tree, index, n, digest): the place of a node in its level and the size of that level.
Every level is joined with itself on sibling indices that a node computes from its own
place: the XOR with 1 where runs have two nodes, otherwise the places of the other slots
of its run. The rows in slot zero then hold their whole run and emit the parents. A node
whose level has no other node is the root of its tree.

The joined levels are also the proofs. Going down again, a node's path is its own
siblings, then the path of its parent, then that of its source's root. Folding a digest
along the path gives the root of the dataset where the row is as it was.

No level is gathered anywhere: places come from a range partitioning, and all joins are
equijoins with at most one partner on the other side of each sibling, so a source with a
third of all rows is dealt out like any other. Levels are written to the work area; each
has a ``fanout``-th of the rows of the level below. The driver reads one number a tree:
the size of its largest lowest level.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from affinia.sources.workspace import staged

FANOUT = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
STEP = "struct<before:string,after:string>"


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes, ``-`` for a null."""
    said = value.cast("string")
    return F.when(said.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(said).cast("string"), F.lit(":"), said))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*(field(v) for v in values)), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` in order with ``part_`` and ``row_``, and where each group starts in each part.

    Starts are (group, part_, first_, before_, n): the first ``row_`` of a group in a part,
    the rows of the group in earlier parts, and all its rows. They have a row for each group
    and part that meet, so at most as many as there are parts and groups together. Rows that
    are equal in every column are told apart by where they were read, so they too may be
    dealt over several parts.
    """
    keys = [group, *order, "tie_"]
    tied = rows.withColumn("tie_", F.monotonically_increasing_id())
    laid = staged(
        tied.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("tie_")
        .withColumn("row_", F.monotonically_increasing_id())
        .withColumn("part_", F.shiftright("row_", 33)),
        "laid",
    )
    counts = laid.groupBy(group, "part_").agg(F.min("row_").alias("first_"), F.count("*").alias("rows_"))
    own = Window.partitionBy(group)
    earlier = own.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group, "part_", "first_",
        F.coalesce(F.sum("rows_").over(earlier), F.lit(0)).alias("before_"),
        F.sum("rows_").over(own).alias("n"),
    )
    return laid, starts


def placed(laid: DataFrame, starts: DataFrame, group: str) -> DataFrame:
    """``laid`` with the columns of its group's start, and ``index`` from 0 in its group."""
    here = starts.withColumnsRenamed({group: "group_", "part_": "start_part_"})
    met = laid.join(here, laid[group].eqNullSafe(F.col("group_")) & (F.col("part_") == F.col("start_part_")))
    return met.withColumn("index", F.col("row_") - F.col("first_") + F.col("before_")).drop(
        "group_", "start_part_", "part_", "row_", "first_", "before_"
    )


def sibling_index(k: int, fanout: int) -> Column:
    """The place of the ``k``-th sibling: XOR in pairs, otherwise the slot ``k`` farther round."""
    place = F.col("index")
    if fanout == 2:
        return place.bitwiseXOR(F.lit(1).cast("long"))
    slot = place % fanout
    return place - slot + (slot + k) % fanout


def sibling_runs(nodes: DataFrame, fanout: int) -> DataFrame:
    """``nodes`` with the digests of their run ``before`` and ``after`` them, as text."""
    met = nodes
    for k in range(1, fanout):
        other = nodes.select(
            F.col("tree").alias(f"tree_{k}"), F.col("index").alias(f"at_{k}"), F.col("digest").alias(f"digest_{k}")
        )
        met = met.withColumn(f"sibling_{k}", sibling_index(k, fanout)).join(
            other, (F.col("tree") == F.col(f"tree_{k}")) & (F.col(f"sibling_{k}") == F.col(f"at_{k}")), "left"
        )
    # Slots come round: siblings that wrap stand before, in ascending order, the others after.
    wraps = [F.col("index") % fanout + k >= fanout for k in range(1, fanout)]
    digests = [F.col(f"digest_{k}") for k in range(1, fanout)]
    before = F.concat_ws("", *(F.when(w, d) for w, d in zip(wraps, digests, strict=True)))
    after = F.concat_ws("", *(F.when(~w, d) for w, d in zip(wraps, digests, strict=True)))
    return met.select(*nodes.columns, before.alias("before"), after.alias("after"))


def parents(runs: DataFrame, fanout: int) -> DataFrame:
    """Each run's row in slot zero as the node above it."""
    first = runs.where(F.col("index") % fanout == 0)
    return first.select(
        "tree",
        F.expr(f"index div {fanout}").alias("index"),
        F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"),
        F.sha2(F.concat("digest", "after"), 256).alias("digest"),
    )


@dataclass(frozen=True)
class Levels:
    """The trees of a forest, from the leaves up.

    ``runs`` are the nodes of levels of two and more, with their siblings; ``roots`` the
    nodes that stand alone in their level.
    """

    runs: list[DataFrame]
    roots: list[DataFrame]
    fanout: int

    def tops(self) -> DataFrame:
        """(tree, digest) of every tree."""
        found = [r.select("tree", "digest") for r in self.roots]
        whole = found[0]
        for more in found[1:]:
            whole = whole.unionByName(more)
        return whole


def raise_levels(nodes: DataFrame, fanout: int) -> Levels:
    """Levels above ``nodes`` (tree, index, n, digest and columns to keep on the lowest)."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs, roots = [], [nodes.where("n = 1")]
    while most > 1:
        here = staged(sibling_runs(nodes.where("n > 1"), fanout), "runs")
        nodes = parents(here, fanout)
        runs.append(here)
        roots.append(nodes.where("n = 1"))
        most = -(-most // fanout)
    return Levels(runs, roots, fanout)


def descend(levels: Levels, crown: DataFrame) -> DataFrame:
    """Columns of the lowest level with ``path`` and what ``crown`` says of each tree.

    ``crown`` is (tree, path, ...): the steps that follow a tree's root. A path is an
    array of (before, after) from the node itself to the last root.
    """
    said = [c for c in crown.columns if c not in ("tree", "path")]
    told = crown.withColumnRenamed("tree", "of_tree")

    def ends(roots: DataFrame) -> DataFrame:
        met = roots.join(told, F.col("tree") == F.col("of_tree"))
        return met.drop("of_tree").withColumn("top", F.col("digest"))

    above = None
    for runs, roots in zip([None, *reversed(levels.runs)], reversed(levels.roots), strict=True):
        here = ends(roots)
        if runs is not None:
            upper = above.select(
                F.col("tree").alias("up_tree"), F.col("index").alias("up_index"), "path", "top", *said
            )
            met = runs.withColumn("up_at", F.expr(f"index div {levels.fanout}")).join(
                upper, (F.col("tree") == F.col("up_tree")) & (F.col("up_at") == F.col("up_index"))
            )
            step = F.array(F.struct("before", "after"))
            inner = met.withColumn("path", F.concat(step, "path")).drop("up_tree", "up_index", "up_at", "before", "after")
            here = inner.unionByName(here)
        # The lowest level is read once, by the caller.
        above = here if roots is levels.roots[0] else staged(here, "paths")
    return above


def fold(digest: Column, path: Column) -> Column:
    """The root that a digest and its path give."""
    return F.aggregate(path, digest, lambda held, step: F.sha2(F.concat(step["before"], held, step["after"]), 256))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, from the leaf to the root and left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda step: F.concat(step["before"], step["after"]))), 256)


@dataclass(frozen=True)
class Manifest:
    """A tree per source over its documents, and the tree over the sources.

    ``sources`` is (tree, source, n): the number of a source in ascending order. The lowest
    level of ``documents`` has doc_id and ``altered``, the leaf of the altered row.
    """

    sources: DataFrame
    documents: Levels
    top: Levels

    def root(self) -> str | None:
        """Digest of the whole dataset; None for an empty one."""
        row = self.top.tops().first()
        return None if row is None else row["digest"]

    def paths(self) -> DataFrame:
        """(doc_id, leaf, altered, subroot, root, path) of every document."""
        bare = self.top.tops().select("tree", F.array().cast(f"array<{STEP}>").alias("path"))
        crown = descend(self.top, bare).select(F.col("index").alias("tree"), "path", F.col("top").alias("root"))
        below = descend(self.documents, staged(crown, "crown"))
        return below.select(
            "doc_id", F.col("digest").alias("leaf"), "altered", F.col("top").alias("subroot"), "root", "path"
        )


def build_manifest(docs: DataFrame, altered: Column | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    ``altered`` is a second text of each row, as a suspect copy of the dataset holds it;
    its leaf goes along and can be folded like the row's own. Nulls are written as ``-``
    and sort first; rows with the same source and doc_id follow by digest, so ties and
    repeated rows are leaves of their own in a fixed order. Rows without a doc_id or a
    source are leaves like others. An empty table has no levels and no root. Other
    columns, whatever their names, are not looked at.
    """
    # Columns are taken by place from here on, so names of other columns cannot clash.
    plain = docs.select(*FIELDS, (F.col("text") if altered is None else altered).alias("altered_text"))
    whole = [F.col(c) for c in FIELDS]
    leaves = staged(
        plain.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("source").cast("string").alias("source"),
            leaf_digest(whole).alias("digest"),
            leaf_digest([*whole[:-1], F.col("altered_text")]).alias("altered"),
        ),
        "leaves",
    )
    laid, starts = numbered(leaves, "source", ["doc_id", "digest"])
    starts = staged(starts, "starts")
    listed, listed_starts = numbered(
        starts.groupBy("source").agg(F.max("n").alias("size")).withColumn("all_", F.lit(0)), "all_", ["source"]
    )
    sources = staged(
        placed(listed, listed_starts, "all_").select(F.col("index").alias("tree"), "source", F.col("size"), F.col("n")),
        "sources",
    )
    named = sources.select("tree", F.col("source").alias("named"))
    numbered_starts = starts.join(named, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    nodes = placed(laid, numbered_starts, "source").select("tree", "index", "n", "digest", "doc_id", "altered")
    documents = raise_levels(staged(nodes, "nodes"), fanout)
    tops = documents.tops().withColumnRenamed("tree", "of_tree")
    crowns = sources.join(tops, F.col("tree") == F.col("of_tree")).select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("index"), "n", "digest"
    )
    top = raise_levels(staged(crowns, "subroots"), fanout)
    return Manifest(sources.select("tree", "source", F.col("size").alias("n")), documents, top)


def tampered_text() -> Column:
    """The text without line feeds where 2 divides the checksum of the doc_id."""
    even = F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def verified_documents(docs: DataFrame, altered: Column) -> DataFrame:
    """Leaf, roots, proof and verdict of every row, where a copy of it has the text ``altered``.

    A row is verified where its copy's leaf folds to the root. Null, empty and repeated
    rows are as in ``build_manifest``; an empty table gives an empty result.
    """
    found = build_manifest(docs, altered).paths()
    folded = found.select(
        "doc_id", "leaf", "subroot", "root",
        siblings_digest(F.col("path")).alias("proof_sha256"),
        fold(F.col("altered"), F.col("path")).alias("folded_root"),
    )
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
