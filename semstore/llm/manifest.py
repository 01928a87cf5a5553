"""A Merkle manifest of a dataset: one tree a source, one tree over the sources' roots.

A leaf is the digest of a row's columns. The nodes of a tree are numbered at every level, so the siblings of a node have
numbers that can be computed: its number with the last bit turned (XOR) in a binary tree, else the offsets 1 to
`fan_out` - 1 from slot zero of its run. At every level the slot-zero nodes look their siblings up by an equijoin of the
level with itself, and emit the parents. A level is a table in the shared folder; all that reaches the driver is the
number of nodes of the largest tree, and the root.

Proofs go from the top down: the siblings of a node, then the path of its parent, which is shared by its whole run.
Folding a leaf with its path gives the root again, or shows that the row is not the one that was entered.

Numbers of leaves: rows are dealt to ranges of (group, order), sorted there and counted; a range's first number is the
sum of the counts before it in its group. So a group of any size is spread over tasks.

Defined cases: a null in any column is `-`, a value its length and itself, so no two rows run together; texts of any
length are hashed whole. Rows without a group come first and form one; rows without an id come first in their group; rows
with the same id are ordered by their digest, equal rows follow each other. An empty table has no nodes and no root.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semstore.llm.common import staged

FAN_OUT = 16
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(*parts: Column) -> Column:
    """Lower-case hexadecimal sha256 of texts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def row_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: `-` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    texts = [v.cast("string") for v in values]
    return digest(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts))


def numbered(rows: DataFrame, group: str | None, order: Sequence[str], name: str) -> DataFrame:
    """`rows` (narrow ones) with `tree`, the number of their group, `at`, theirs within it (both from 0, nulls first), and
    `of`, the number of rows in the group.

    Rows that agree in all of `order` should be equal: which of them comes first is left open.
    """
    # the place in the input parts equal rows, so that any number of them is spread; written, as it must never change
    placed = staged(rows.withColumn("_row", F.monotonically_increasing_id()), f"{name}-rows")
    sort = [F.asc_nulls_first(k) for k in (*([group] if group else []), *order, "_row")]
    dealt = placed.repartitionByRange(*sort).sortWithinPartitions(*sort)
    dealt = dealt.withColumns({"_part": F.spark_partition_id(), "_place": F.monotonically_increasing_id()})
    dealt = staged(dealt, f"{name}-sorted")
    own = F.col(group) if group else F.lit(0)
    parts = dealt.groupBy(own.alias("_group"), "_part").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    # a row per range and group: a group's rows here are at most the ranges
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")
    total = F.sum("_n").over(Window.partitionBy("_group")).alias("of")
    parts = staged(parts.select("_group", F.col("_part").alias("_range"), shift.alias("_shift"), total), f"{name}-parts")
    if group:
        trees = numbered(parts.select(F.col("_group").alias("_named")).distinct(), None, ["_named"], f"{name}-groups")
        trees = trees.select("_named", F.col("at").alias("tree"))
        parts = parts.join(trees, F.col("_group").eqNullSafe(F.col("_named"))).drop("_named")
    else:
        parts = parts.withColumn("tree", F.lit(0).cast("long"))
    met = dealt.join(parts, (F.col("_part") == F.col("_range")) & own.eqNullSafe(F.col("_group")))
    return met.select(*[dealt[c] for c in rows.columns], "tree", (F.col("_place") + F.col("_shift")).alias("at"), "of")


@dataclass
class Trees:
    """Trees over numbered leaves: the leaves, the runs of siblings at each level (leaves' first), the roots.

    leaves: tree, at, of, digest and more; runs: tree, run, of, members (slot, digest and, of leaves, more), digest
    of the parent; roots: tree, digest, height (0 for a lone leaf).
    """

    leaves: DataFrame
    levels: list[DataFrame]
    roots: DataFrame
    fan_out: int
    more: tuple[str, ...]


def grow(leaves: DataFrame, fan_out: int = FAN_OUT, more: Sequence[str] = ()) -> Trees:
    """All levels over leaves with tree (long), at (0, 1, 2 ... in each tree), of (how many there are), digest and `more`."""
    if fan_out < 2:
        raise ValueError("a node has two children at least")
    leaves = staged(leaves.select("tree", "at", "of", "digest", *more), "leaves")
    nodes, levels = leaves, []
    largest = leaves.agg(F.max("of")).first()[0] or 0
    # every node knows how many there are on its level of its tree, so a large tree is never brought together to see
    done = [_roots(leaves, 0)]
    while largest > 1:
        levels.append(staged(_runs(nodes.where("of > 1"), fan_out, () if levels else more), f"level-{len(levels)}"))
        nodes = levels[-1].select("tree", F.col("run").alias("at"), F.ceil(F.col("of") / fan_out).cast("long").alias("of"), "digest")
        done.append(_roots(nodes, len(levels)))
        largest = -(-largest // fan_out)
    roots = done[0]
    for some in done[1:]:
        roots = roots.unionByName(some)
    return Trees(leaves, levels, staged(roots, "roots"), fan_out, tuple(more))


def _roots(nodes: DataFrame, height: int) -> DataFrame:
    """The nodes without siblings; in other trees every run gives a parent, even one of a single node."""
    return nodes.where("of = 1").select("tree", "digest", F.lit(height).alias("height"))


def _runs(nodes: DataFrame, fan_out: int, more: Sequence[str]) -> DataFrame:
    """Slot-zero nodes ask for the nodes with the numbers of their siblings, and emit the parents."""
    zero = nodes.where(F.col("at") % fan_out == 0).select(F.col("tree").alias("_tree"), F.col("at").alias("_zero"))
    slot = F.explode(F.sequence(F.lit(0), F.lit(fan_out - 1)))
    asked = zero.select("_tree", "_zero", slot.alias("slot")).withColumn("_at", F.col("_zero") + F.col("slot"))
    met = nodes.join(asked, (F.col("tree") == F.col("_tree")) & (F.col("at") == F.col("_at")))
    members = F.sort_array(F.collect_list(F.struct("slot", "digest", *more)))
    runs = met.groupBy("tree", "_zero").agg(members.alias("members"), F.max("of").alias("of"))
    parent = digest(F.array_join(F.transform("members", lambda m: m["digest"]), ""))
    return runs.select("tree", (F.col("_zero") / fan_out).cast("long").alias("run"), "of", "members", parent.alias("digest"))


NO_PATH = "array<struct<left:string,right:string>>"


def paths(trees: Trees, above: DataFrame | None = None, carried: Sequence[str] = ()) -> DataFrame:
    """tree, at, digest, `more` and path (siblings to the left and right, level by level to the root) of every leaf.

    `above` (tree, path and the columns `carried`) goes on where the roots' own paths end.
    """
    tops = trees.roots.select("tree", "height", F.lit(0).cast("long").alias("at"))
    if above is None:
        tops = tops.withColumn("path", F.array().cast(NO_PATH))
    else:
        tops = tops.join(above.select("tree", "path", *carried), "tree")
    keys = ("tree", "at", "path", *carried)
    below = tops.where("false").select(*keys)
    for level in range(len(trees.levels) - 1, -1, -1):
        known = below.unionByName(tops.where(F.col("height") == level + 1).select(*keys))
        below = _below(trees.levels[level], known, trees.fan_out, carried, () if level else ("digest", *trees.more))
        if level:
            below = staged(below, f"paths-{level}")
    lone = trees.leaves.where("of = 1").join(tops.where("height = 0").drop("at", "height"), "tree")
    names = [*keys, "digest", *trees.more]
    return lone.select(*names).unionByName(below.select(*names)) if trees.levels else lone.select(*names)


def _below(runs: DataFrame, known: DataFrame, fan_out: int, carried: Sequence[str], wanted: Sequence[str]) -> DataFrame:
    """The paths of the members of all runs, from those of their parents."""
    known = known.withColumnsRenamed({"tree": "_tree", "at": "_at", "path": "_path"})
    met = runs.drop("digest", "of").join(known, (F.col("tree") == F.col("_tree")) & (F.col("run") == F.col("_at")))
    digests = F.transform("members", lambda m: m["digest"])
    each = met.select("tree", "run", "_path", *carried, digests.alias("_all"), F.explode("members").alias("own"))
    slot = F.col("own.slot")
    left = F.array_join(F.slice("_all", F.lit(1), slot), "").alias("left")
    right = F.array_join(F.slice("_all", slot + 2, F.lit(fan_out)), "").alias("right")
    return each.select(
        "tree", (F.col("run") * fan_out + slot).alias("at"), F.concat(F.array(F.struct(left, right)), F.col("_path")).alias("path"),
        *carried, *[F.col("own")[name].alias(name) for name in wanted],
    )


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf has by its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof_digest(path: Column) -> Column:
    """Digest of the siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""))


@dataclass
class Manifest:
    """The sources' trees, the tree of their roots, and its root (null for an empty table)."""

    sources: Trees
    whole: Trees
    root: str | None


def build(
    rows: DataFrame,
    columns: Sequence[str] = COLUMNS,
    *,
    group: str = "source",
    id_col: str = "doc_id",
    fan_out: int = FAN_OUT,
    more: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of a table: leaves over `columns`, a tree for each value of `group` in the order of `id_col`.

    `more` are columns to keep with the leaves, next to `id` and `source`.
    """
    more = more or {}
    leaves = rows.select(
        F.col(group).cast("string").alias("source"), F.col(id_col).alias("id"),
        row_digest([F.col(c) for c in columns]).alias("digest"), *[c.alias(name) for name, c in more.items()],
    )
    sources = grow(numbered(leaves, "source", ["id", "digest"], "leaves"), fan_out, ("source", "id", *more))
    # the trees are numbered in the order of their sources
    of = F.lit(sources.roots.count()).cast("long")
    whole = grow(sources.roots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("at"), of.alias("of"), "digest"), fan_out)
    root = whole.roots.first()
    return Manifest(sources, whole, root["digest"] if root else None)


def prove(manifest: Manifest) -> DataFrame:
    """id, source, digest, subroot, path and what else was kept, of every leaf."""
    above = paths(manifest.whole).select(F.col("at").alias("tree"), "path", F.col("digest").alias("subroot"))
    return paths(manifest.sources, staged(above, "source-paths"), ("subroot",)).drop("tree", "at")


def tampering(id_col: str = "doc_id", text_col: str = "text", columns: Sequence[str] = COLUMNS) -> Column:
    """A trial of the proofs: leaves of the rows whose texts are lower-cased, where 5 divides the crc32 of the id."""
    small = F.translate(text_col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0
    return F.when(chosen, row_digest([small if c == text_col else F.col(c) for c in columns]))


def audit(docs: DataFrame, *, fan_out: int = FAN_OUT) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root (of the tampered row, if it is one), verified."""
    manifest = build(docs, fan_out=fan_out, more={"tampered": tampering()})
    folded = fold(F.coalesce("tampered", "digest"), F.col("path"))
    proved = prove(manifest).select(
        F.col("id").cast("long").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", F.lit(manifest.root).cast("string").alias("root"),
        proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"),
    )
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
