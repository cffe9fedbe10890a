"""A Merkle manifest of a table: one hash tree per group of rows, one more over the groups' roots, and proofs.

Rows become leaves, leaves of a group stand in the order of an id, and every two consecutive nodes become the hash
of their digests as hex text; a node without a partner becomes the hash of itself alone. Trees grow ``STEP`` levels
a round: a block of ``2 ** STEP`` neighbouring nodes is one bounded group of one task, whatever the size of its tree.

Proofs are made for blocks, not for rows (octopus multiproof). A block works out the smallest set of node
coordinates that its wanted leaves need and cannot derive from each other, all blocks fetch theirs in one join, and
each then derives the interior nodes its rows share and spells out every row's own path.

Defined cases: a NULL field is hashed as ``-``, so it differs from an empty text; rows without a group form the first
group; rows without id come first in theirs; rows of equal ids are ordered by their leaves, and identical rows are
leaves of their own; an empty table gives no rows and no root; of the
input only the id, the hashed fields and what is carried are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import written

STEP = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NODES = "tree string, level int, at long, size long, digest binary"


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the carried columns, ``tree``, ``at``, ``size``, ``block`` and ``digest`` of each row; ``nodes``: all
    interior nodes, ``upper`` marks those at and above the roots of the blocks; ``trees``: ``subroot``, ``root`` and the path
    from one to the other, per tree."""

    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame


def leaf_hash(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields: ``-`` if NULL, else UTF-8 byte count, ``:`` and the value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _above(digests: list[bytes]) -> list[bytes]:
    """The next level: pairs become the hash of their hex texts, a last one without partner that of its own."""
    return [hashlib.sha256(b"".join(digests[i:i + 2]).hex().encode()).digest() for i in range(0, len(digests), 2)]


def _binary(digests: list[bytes | None]) -> pa.Array:
    return pa.array(digests, pa.binary())


def _grown(level: int, step: int):
    """A function of one block of neighbouring nodes of a level: the nodes above them, up to the block's root."""

    def grow(block: pa.Table) -> pa.Table:
        block = block.sort_by("at")
        tree, size, first = block["tree"][0].as_py(), block["size"][0].as_py(), block["at"][0].as_py()
        digests, out = block["digest"].to_pylist(), []
        for up in range(1, step + 1):
            if size == 1:
                break
            digests, size, first = _above(digests), (size + 1) // 2, first >> 1
            out.append(pa.table({
                "tree": pa.array([tree] * len(digests), pa.string()), "level": pa.array([level + up] * len(digests), pa.int32()),
                "at": pa.array(range(first, first + len(digests)), pa.int64()),
                "size": pa.array([size] * len(digests), pa.int64()), "digest": _binary(digests)}))
        return pa.concat_tables(out)

    return grow


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at`` (place in the tree, without gaps) and ``size`` (leaves of the tree).

    Rows are dealt out by ranges and counted per range, so no tree is ordered in one task.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    stored = written(ranged.withColumn("mark", F.monotonically_increasing_id()), "placed")
    part = F.shiftright("mark", 33).alias("part")
    runs = stored.groupBy("tree", part).agg(F.min("mark").alias("first"), F.count("*").alias("rows")).selectExpr(
        "tree", "part", "first", "sum(rows) OVER (PARTITION BY tree) AS size",
        "sum(rows) OVER (PARTITION BY tree ORDER BY part ROWS UNBOUNDED PRECEDING) - rows AS before")
    return stored.withColumn("part", part).join(runs, ["tree", "part"]).withColumn(
        "at", F.expr("before + mark - first")).drop("part", "mark", "first", "before")


def _forest(leaves: DataFrame, step: int) -> DataFrame | None:
    """All interior nodes (tree, level, at, size, digest, upper) above leaves (tree, at, size, digest)."""
    nodes, level = None, 0
    current = leaves.select("tree", "at", "size", "digest")
    while (current.agg(F.max("size")).first()[0] or 0) > 1:
        blocks = current.where("size > 1").groupBy("tree", F.shiftright("at", step).alias("block"))
        grown = blocks.applyInArrow(_grown(level, step), _NODES)
        stored = written(grown.withColumn("upper", (F.col("level") >= step) | (F.col("size") == 1)), "nodes", ["upper"])
        nodes = stored if nodes is None else nodes.unionByName(stored)
        level += step
        current = stored.where((F.col("level") == level) & F.col("upper"))
    return nodes


def missing_nodes(places: np.ndarray, size: int) -> list[tuple[int, np.ndarray]]:
    """(level, places): the nodes that leaves at ``places`` of a tree of ``size`` leaves need and cannot derive."""
    known, level, out = np.unique(places), 0, []
    while size > 1:
        partners = known ^ 1
        needed = partners[(partners < size) & ~np.isin(partners, known, assume_unique=True)]
        if len(needed):
            out.append((level, needed))
        known, size, level = np.unique(known >> 1), (size + 1) // 2, level + 1
    return out


def _missing(block: pa.Table) -> pa.Table:
    tree, number, size = (block[c][0].as_py() for c in ("tree", "block", "size"))
    found = missing_nodes(block["at"].to_numpy(), size)
    levels = np.concatenate([np.full(len(p), level) for level, p in found] or [np.empty(0)])
    places = np.concatenate([p for _, p in found] or [np.empty(0)])
    n = len(places)
    return pa.table({"tree": pa.array([tree] * n, pa.string()), "block": pa.array([number] * n, pa.int64()),
                     "level": pa.array(levels, pa.int32()), "at": pa.array(places, pa.int64())})


def _expanded(carried: list[str]):
    """A function of a block's wanted leaves and its fetched nodes: each leaf with its own path to the root."""

    def expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        size, places = leaves["size"][0].as_py(), leaves["at"].to_numpy()
        given: dict[int, dict[int, bytes]] = {}
        for level, at, digest in zip(*(fetched[c].to_pylist() for c in ("level", "at", "digest")), strict=True):
            given.setdefault(level, {})[at] = digest
        known = dict(zip(places.tolist(), leaves["digest"].to_pylist(), strict=True))
        digests, lefts, level = [], [], 0
        while size > 1:
            known |= given.get(level, {})
            here = (places >> level).tolist()
            digests.append([known.get(i ^ 1) for i in here])
            lefts.append([bool(i & 1) for i in here])
            parents = {}
            for i in {i >> 1 for i in here}:
                pair = [known[2 * i], known[2 * i + 1]] if 2 * i + 1 < size else [known[2 * i]]
                parents[i] = _above(pair)[0]
            known, size, level = parents, (size + 1) // 2, level + 1
        steps = pa.StructArray.from_arrays(
            [_binary([d[r] for r in range(len(places)) for d in digests]),
             pa.array([s[r] for r in range(len(places)) for s in lefts], pa.bool_())], ["digest", "left"])
        path = pa.ListArray.from_arrays(pa.array(np.arange(len(places) + 1) * level, pa.int32()), steps)
        return leaves.select(carried).append_column("path", path)

    return expand


_PATH = T.ArrayType(T.StructType([T.StructField("digest", T.BinaryType()), T.StructField("left", T.BooleanType())]))


def _paths(wanted: DataFrame, leaves: DataFrame, nodes: DataFrame | None, step: int) -> DataFrame:
    """``wanted`` with ``path``: bottom up, the sibling's digest (NULL where there is none) and whether it stands left."""
    if nodes is None:
        return wanted.withColumn("path", F.array().cast(_PATH))
    missing = written(wanted.groupBy("tree", "block").applyInArrow(
        _missing, "tree string, block long, level int, at long"), "missing")
    # Whole blocks need nothing from inside a block; then only the few upper nodes are read.
    columns = ["tree", "level", "at", "digest"]
    if (missing.agg(F.min("level")).first()[0] or 0) < step:
        source = nodes.select(*columns).unionByName(leaves.withColumn("level", F.lit(0)).select(*columns))
    else:
        source = nodes.where("upper").select(*columns)
    fetched = missing.join(source, ["tree", "level", "at"])
    schema = T.StructType([*wanted.schema.fields, T.StructField("path", _PATH)])
    return wanted.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(
        _expanded(wanted.columns), schema)


def _rooted(leaves: DataFrame, nodes: DataFrame | None) -> DataFrame:
    """(tree, digest): the root of each tree; a lone leaf is its own."""
    lone = leaves.where("size = 1").select("tree", "digest")
    return lone if nodes is None else lone.unionByName(nodes.where("upper AND size = 1").select("tree", "digest"))


def manifest(df: DataFrame, by: str = "lang", id: str = "doc_id", fields: Sequence[str] = FIELDS,
             carry: dict[str, Column] | None = None, step: int = STEP) -> Manifest:
    """The manifest of ``df``: a tree per value of ``by`` (NULL first, by UTF-8 bytes) and one over their roots.

    ``carry`` names further expressions over ``df`` that stay with the leaves; the id is always kept, as ``id``.
    """
    group = F.col(f"`{by}`").cast("string")
    leaf = F.unhex(leaf_hash(*[F.col(f"`{c}`") for c in fields]))
    hashed = df.select(
        F.when(group.isNull(), "").otherwise(F.concat(F.lit("+"), group)).alias("tree"), F.col(f"`{id}`").alias("id"),
        leaf.alias("digest"), *[v.alias(k) for k, v in (carry or {}).items()])
    # Identical rows are told apart by a number of their own, so that many of them do not meet in one range.
    rows = written(hashed.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = _placed(rows, ["id", "digest", "row"]).drop("row").withColumn("block", F.shiftright("at", step))
    nodes = _forest(leaves, step)
    subroots = _rooted(leaves, nodes).select(F.lit("").alias("tree"), F.col("tree").alias("group"), "digest")
    tops = _placed(subroots, ["group"]).withColumn("block", F.shiftright("at", step))
    above = _forest(tops, step)
    root = _rooted(tops, above).select("tree", F.col("digest").alias("root"))
    trees = _paths(tops, tops, above, step).join(root, "tree").select(
        F.col("group").alias("tree"), F.col("digest").alias("subroot"), "root", F.col("path").alias("upward"))
    return Manifest(leaves, nodes, written(trees, "trees"))


def prove(made: Manifest, wanted: DataFrame | None = None, step: int = STEP) -> DataFrame:
    """The wanted rows of ``made.leaves`` (all by default) with ``path`` up to the root, ``subroot`` and ``root``."""
    own = _paths(made.leaves if wanted is None else wanted, made.leaves, made.nodes, step)
    return own.join(made.trees, "tree").withColumn("path", F.concat("path", "upward")).drop("upward")


def siblings_hash(path: Column) -> Column:
    """Hex hash of the siblings' hex texts, bottom up."""
    given = F.filter(path, lambda s: s["digest"].isNotNull())
    return F.sha2(F.array_join(F.transform(given, lambda s: F.lower(F.hex(s["digest"]))), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root, as hex, that a leaf (hex) and a path lead to."""

    def up(node: Column, s: Column) -> Column:
        other = F.lower(F.hex(s["digest"]))
        return F.sha2(F.when(other.isNull(), node).when(s["left"], F.concat(other, node)).otherwise(
            F.concat(node, other)), 256)

    return F.aggregate(path, leaf, up)


def proofs(df: DataFrame, by: str = "lang", id: str = "doc_id", fields: Sequence[str] = FIELDS,
           presented: Column | None = None) -> DataFrame:
    """Every row's id, leaf, subroot, root and siblings, and whether ``presented`` (a leaf as hex, the row's own by
    default) folds to the root; digests are hex."""
    own = leaf_hash(*[F.col(f"`{c}`") for c in fields])
    other = F.unhex(own if presented is None else presented)
    shown = F.lower(F.hex("digest"))
    out = prove(manifest(df, by, id, fields, {"presented": F.nullif(other, F.unhex(own))}))
    out = out.withColumn("folded_root", folded(F.coalesce(F.lower(F.hex("presented")), shown), F.col("path")))
    return out.select(
        F.col("id").alias(id), shown.alias("leaf"), F.lower(F.hex("subroot")).alias("subroot"),
        F.lower(F.hex("root")).alias("root"), siblings_hash(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.lower(F.hex("root"))).alias("verified"), "path")
