"""A Merkle manifest of a dataset, and proofs of all its leaves by octopus multiproofs.

Every row is a leaf: the digest of its fields, each written with its length. The
leaves of a group stand in the order of their ids; while several nodes remain, every
two neighbours become the digest of both, a last one without a neighbour the digest
of itself. The subroots of the groups form one more tree, whose top is the root.

Positions come from ranks over range partitions, so a group of any size is spread
over tasks. A leaf partition is an aligned block of ``2 ** BLOCK_BITS`` leaves of one
group. Blocks are raised to one node each, those nodes again in blocks, until one
remains; only nodes above the leaf partitions are stored. To prove its leaves, a
partition works out the smallest set of nodes that it can't derive from them, fetches
these once by a join on their coordinates, derives the nodes that its leaves share,
and expands the proof of each leaf where it lies.

A null group is a group of its own and comes first, then groups in the order of their
UTF-8 bytes. Null ids come first in a group; rows equal in id stand in the order of
their digests, so equal rows are leaves like others. A null field is written ``-``,
an empty text is not null. Texts are hashed whole. An empty table has no root and no
rows. Only the named fields are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm import words
from feedloom.operators.ranking import spread_rank
from feedloom.staging import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 12
#: The tree over the subroots of the groups, which are trees 0, 1, 2...
TOP = -1
_NODE = "tree long, size long, level int, pos long, digest string"


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def height(size: int) -> int:
    """Levels above the leaves of a tree."""
    return max(size - 1, 0).bit_length()


def width(size: int, level: int) -> int:
    """Nodes of a level."""
    return -(-size >> level)


def raised(nodes: list[str]) -> list[str]:
    """The next level of neighbouring nodes, the first of which is a left one."""
    up = [digest(a + b) for a, b in zip(nodes[::2], nodes[1::2])]
    return [*up, digest(nodes[-1])] if len(nodes) % 2 else up


def missing(positions: np.ndarray, size: int) -> list[tuple[int, int]]:
    """(level, position) of the nodes that the proofs of some leaves need and their leaves don't give.

    This is the smallest such set: siblings of nodes that can be derived, where they
    exist and can't be derived themselves.
    """
    out = []
    known = np.unique(positions)
    for level in range(height(size)):
        beside = known ^ 1
        wanted = beside[(beside < width(size, level)) & ~np.isin(beside, known)]
        out += [(level, int(p)) for p in wanted]
        known = np.unique(known >> 1)
    return out


def field_text(column: Column) -> Column:
    """A field as it enters a leaf: its length in bytes and its value, or ``-``."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


@dataclass
class Manifest:
    """Written tables: leaves with their places, and the nodes above the leaf partitions."""

    leaves: DataFrame
    nodes: DataFrame
    trees: int
    root: str | None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (tree, block) of a sorted stream, one block held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("tree", "block")], axis=1)
        edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        firsts = [0, *edges.tolist()]
        for a, b in zip(firsts, [*firsts[1:], batch.num_rows], strict=True):
            if held and tuple(keys[a]) != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = tuple(keys[a])
    if held:
        yield pa.Table.from_batches(held)


def _raise_blocks(nodes: DataFrame, level: int, interiors: bool) -> DataFrame:
    """The nodes above blocks of a level: their tops, with ``interiors`` all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches):
            tree, size = block.column("tree")[0].as_py(), block.column("size")[0].as_py()
            first, at = block.column("pos")[0].as_py(), level
            here = block.column("digest").to_pylist()
            top = min(level + BLOCK_BITS, height(size))
            levels, places, digests = [], [], []
            while at < top:
                here, first, at = raised(here), first >> 1, at + 1
                if interiors or at == top:
                    levels += [at] * len(here)
                    places += range(first, first + len(here))
                    digests += here
            if at == level:  # a tree of one leaf
                levels, places, digests = [at], [first], here
            n = len(levels)
            columns = [pa.array([tree] * n, pa.int64()), pa.array([size] * n, pa.int64()), pa.array(levels, pa.int32())]
            columns += [pa.array(places, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["tree", "size", "level", "pos", "digest"])

    block = F.shiftright("pos", BLOCK_BITS).alias("block")
    rows = nodes.select("tree", "size", "pos", "digest", block)
    dealt = rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    return words.bounded(dealt).mapInArrow(run, _NODE)


def _forest(leaves: DataFrame, largest: int, label: str) -> DataFrame:
    """All nodes above the leaf blocks of some trees, the largest of which has so many leaves."""
    found = stage(_raise_blocks(leaves, 0, interiors=False), f"{label}-0")
    rounds, level = [found], BLOCK_BITS
    while level < height(largest):
        below = rounds[-1].where((F.col("level") == level) & (F.col("size") > 1 << level))
        rounds.append(stage(_raise_blocks(below, level, interiors=True), f"{label}-{level}"))
        level += BLOCK_BITS
    out = rounds[0]
    for more in rounds[1:]:
        out = out.unionByName(more)
    return out


def _levels(size: Column) -> Column:
    """``height`` of a column of sizes."""
    return F.when(size > 1, F.length(F.bin(size - 1))).otherwise(0).cast("int")


def build(hashed: DataFrame, id_col: str = "id", group_col: str = "grp") -> Manifest:
    """The manifest of a written table of ids, groups and digests ``leaf``; other columns stay with the leaves."""
    kept = [c for c in hashed.columns if c not in (id_col, group_col)]
    leaves = hashed.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), *kept)
    sizes = stage(leaves.groupBy("grp").agg(F.count(F.lit(1)).alias("size")), "merkle-sizes")
    order = [F.col("grp").asc_nulls_first()]
    trees = spread_rank(sizes, [], order, "tree", "merkle-trees").withColumn("tree", F.col("tree") - 1)
    trees = stage(trees.withColumnRenamed("grp", "of"), "merkle-groups")
    n_trees, largest = trees.agg(F.count(F.lit(1)), F.max("size")).first()
    placed = spread_rank(leaves, ["grp"], [F.col("id").asc_nulls_first(), F.col("leaf")], "pos", "merkle-leaves")
    placed = placed.join(trees, F.col("grp").eqNullSafe(F.col("of"))).drop("of").withColumn("pos", F.col("pos") - 1)
    placed = stage(placed, "merkle-placed")
    if not n_trees:
        return Manifest(placed, hashed.sparkSession.createDataFrame([], _NODE), 0, None)
    nodes = _forest(placed.withColumnRenamed("leaf", "digest"), largest, "merkle-nodes")
    tops = nodes.where(F.col("level") == _levels(F.col("size")))
    subroots = tops.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_trees).cast("long").alias("size"), F.col("tree").alias("pos"), "digest")
    above = _forest(subroots, n_trees, "merkle-top")
    root = above.where(F.col("level") == height(n_trees)).first().digest
    # Subroots are the leaves of the top tree; its own lowest levels are stored too, as they serve every partition.
    lowest = _top_interiors(subroots, n_trees)
    return Manifest(placed, stage(nodes.unionByName(above).unionByName(lowest), "merkle-all"), n_trees, root)


def _top_interiors(subroots: DataFrame, n_trees: int) -> DataFrame:
    """Leaves of the top tree, and its nodes below the tops of its blocks."""
    below = min(BLOCK_BITS, height(n_trees))
    inner = _raise_blocks(subroots, 0, interiors=True).where((F.col("level") < below) & (F.col("level") > 0))
    lone = subroots.withColumn("level", F.lit(0)).where(F.lit(n_trees > 1))
    return inner.unionByName(lone.select(inner.columns))


def _wanted(leaves: DataFrame, trees: int) -> DataFrame:
    """Coordinates that each leaf partition lacks: (tree, block, of, level, pos), its subroot among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, block, size in zip(*[batch.column(c).to_pylist() for c in ("tree", "block", "size")], strict=True):
                # A partition has all leaves of its block, so it stands for one node of their level.
                bottom = min(BLOCK_BITS, height(size))
                up = missing(np.array([block]), width(size, bottom))
                rows += [(tree, block, tree, bottom + k, p) for k, p in up]
                rows += [(tree, block, TOP, k, p) for k, p in missing(np.array([tree]), trees)]
                rows.append((tree, block, tree, height(size), 0))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            names = ["tree", "block", "of", "level", "pos"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    parts = leaves.groupBy("tree", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(F.max("size").alias("size"))
    return parts.mapInArrow(run, "tree long, block long, of long, level int, pos long")


def fold(node: str, place: int, size: int, siblings: dict[int, str], bottom: int = 0) -> str:
    """The top of a tree from one node of the level ``bottom`` and its siblings by level."""
    for level in range(bottom, height(size)):
        other = siblings.get(level)
        if other is None:
            node = digest(node)
        else:
            node = digest(node + other if place % 2 == 0 else other + node)
        place >>= 1
    return node


class _Part:
    """A leaf partition: its leaves, the nodes it has fetched, and what follows from them."""

    def __init__(self, block: pa.Table, trees: int):
        fetched = block.filter(pc.is_valid(block.column("of"))).to_pylist()
        self.leaves = block.filter(pc.is_null(block.column("of")))
        self.tree, self.block = block.column("tree")[0].as_py(), block.column("block")[0].as_py()
        self.size, self.trees = self.leaves.column("size")[0].as_py(), trees
        top = height(self.size)
        self.subroot = next(r["digest"] for r in fetched if r["of"] != TOP and r["level"] == top)
        self.up = {r["level"]: r["digest"] for r in fetched if r["of"] != TOP and r["level"] < top}
        self.over = {r["level"]: r["digest"] for r in fetched if r["of"] == TOP}
        self.levels = [self.leaves.column("digest").to_pylist()]
        for _ in range(min(BLOCK_BITS, top)):
            self.levels.append(raised(self.levels[-1]))

    def folded(self) -> str:
        """The root that all its leaves lead to."""
        return self._root(self.levels[-1][0], len(self.levels) - 1, self.block, self.up)

    def _root(self, node: str, bottom: int, place: int, siblings: dict[int, str]) -> str:
        return fold(fold(node, place, self.size, siblings, bottom), self.tree, self.trees, self.over)

    def proofs(self) -> list[str]:
        """The siblings of every leaf, joined from the lowest level to the root."""
        paths = ["".join([self.up[k] for k in sorted(self.up)] + [self.over[k] for k in sorted(self.over)])]
        for nodes in self.levels[-2::-1]:
            paths = [(nodes[k ^ 1] if k ^ 1 < len(nodes) else "") + paths[k >> 1] for k in range(len(nodes))]
        return paths

    def folded_with(self, k: int, leaf: str) -> str:
        """The root that another digest in the place of leaf ``k`` leads to."""
        inner = {n: nodes[(k >> n) ^ 1] for n, nodes in enumerate(self.levels[:-1]) if (k >> n) ^ 1 < len(nodes)}
        return self._root(leaf, 0, (self.block << BLOCK_BITS) + k, inner | self.up)


def prove(manifest: Manifest, other: str | None = None) -> DataFrame:
    """Id, ``leaf``, ``subroot``, ``root``, ``proof`` digest and ``folded_root`` of every leaf.

    ``other`` names a column of the leaves whose digests, where not null, are folded
    with the leaf's siblings in its place.
    """
    leaves = manifest.leaves
    kind = leaves.schema["id"].dataType.simpleString()
    block = F.shiftright("pos", BLOCK_BITS).alias("block")
    asked = _wanted(leaves, manifest.trees).alias("a")
    nodes = manifest.nodes.select(F.col("tree").alias("of"), "level", "pos", "digest").alias("n")
    fetched = asked.join(nodes, ["of", "level", "pos"]).select(
        "tree", "block", "of", "pos", "digest", "level",
        F.lit(None).cast("long").alias("size"), F.lit(None).cast(kind).alias("id"), F.lit(None).cast("string").alias("other"),
    )
    own = leaves.select(
        "tree", block, F.lit(None).cast("long").alias("of"), "pos", F.col("leaf").alias("digest"),
        F.lit(None).cast("int").alias("level"), "size", "id", (F.col(other) if other else F.lit(None)).cast("string").alias("other"),
    )
    trees, root = manifest.trees, manifest.root

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            part = _Part(rows, trees)
            n, whole = part.leaves.num_rows, part.folded()
            others = part.leaves.column("other").to_pylist()
            folded = [whole if x is None else part.folded_with(k, x) for k, x in enumerate(others)]
            proofs = [digest(p) for p in part.proofs()]
            texts = [part.levels[0], [part.subroot] * n, [root] * n, proofs, folded]
            columns = [part.leaves.column("id").combine_chunks(), *[pa.array(t, pa.string()) for t in texts]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "leaf", "subroot", "root", "proof", "folded_root"])

    dealt = own.unionByName(fetched).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
    schema = f"id {kind}, leaf string, subroot string, root string, proof string, folded_root string"
    return words.bounded(dealt).mapInArrow(run, schema)


def tampered(id_col: str = "doc_id", fields: Sequence[str] = FIELDS, field: str = "n_chars", every: int = 7) -> Column:
    """The digest of a row with 1 added to a field, where ``every`` divides the checksum of its id."""
    columns = [F.try_add(F.col(c), F.lit(1)) if c == field else F.col(c) for c in fields]
    chosen = F.crc32(F.col(id_col).cast("string").cast("binary")) % every == 0
    return F.when(chosen, leaf_digest(columns))


def verified_documents(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS) -> DataFrame:
    """Every row with its place in the manifest, and whether a tampered copy of it is found out."""
    hashed = docs.select(
        F.col(id_col).alias("id"),
        F.col(group_col).alias("grp"),
        leaf_digest([F.col(c) for c in fields]).alias("leaf"),
        tampered(id_col, fields).alias("other"),
    )
    manifest = build(stage(hashed, "merkle-hashed"))
    found = prove(manifest, "other")
    verified = F.col("folded_root") == F.col("root")
    return found.select(
        F.col("id").alias(id_col), "leaf", "subroot", "root", F.col("proof").alias("proof_sha256"), "folded_root", verified.alias("verified")
    )
