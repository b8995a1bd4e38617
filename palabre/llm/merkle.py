"""A Merkle manifest of a dataset: SHA-256 trees whose parents keep hash states.

Rows are leaves. The leaves of a group (a language, say) in order of their id form a tree:
every eight neighbours become their hash until one node is left, the group's root. The
groups' roots, in order, form the last tree, whose root names the dataset.

A parent feeds its children to one running SHA-256 and keeps a copy of the state before
each child's slot. So to see what a changed child does to the parent, the state of its slot
is resumed with the replacement and the children to its right; those to its left are never
hashed again.

At scale: leaves are digested by Spark and only digests are sorted, by range. Trees are built
in blocks of 4,096 neighbours, each by one task, whose roots are the leaves of the next
level; a level is 4,096 times smaller than the one below. For folding, each block gets the
path above it once, which all its leaves share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palabre.llm.common import stage

#: Children of a parent, and levels of a tree that one task builds.
FANOUT, LEVELS = 8, 4


class Parent:
    """A hash of its children's hex digests that can be resumed at any slot."""

    def __init__(self, children: list[str]) -> None:
        self.children = children
        running = hashlib.sha256()
        self._before = []
        for child in children:
            self._before.append(running.copy())
            running.update(child.encode())
        self.digest = running.hexdigest()

    def replaced(self, slot: int, child: str) -> str:
        """The digest with another child in a slot."""
        state = self._before[slot].copy()
        state.update(child.encode())
        state.update("".join(self.children[slot + 1 :]).encode())
        return state.hexdigest()

    def siblings(self, slot: int) -> str:
        return "".join(self.children[:slot]) + "".join(self.children[slot + 1 :])


def grow(nodes: list[str], fanout: int = FANOUT, levels: int | None = None) -> list[list[Parent]]:
    """The parents above ``nodes``, level by level: up to one node, or so many levels."""
    tree: list[list[Parent]] = []
    while len(tree) < levels if levels is not None else len(nodes) > 1:
        tree.append([Parent(nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)])
        nodes = [p.digest for p in tree[-1]]
    return tree


def path_above(tree: list[list[Parent]], place: int, fanout: int = FANOUT) -> list[tuple[Parent, int]]:
    """Each parent above a node, with the slot the path comes through."""
    steps = []
    for level in tree:
        place, slot = divmod(place, fanout)
        steps.append((level[place], slot))
    return steps


def fold(digest: str, steps: list[tuple[Parent, int]]) -> str:
    """The root above a node if that node were ``digest``."""
    for parent, slot in steps:
        digest = parent.replaced(slot, digest)
    return digest


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(columns: list[Column]) -> Column:
    """Hex SHA-256 of fields, each ``-`` if null, else its length in bytes, ``:`` and itself."""
    return F.sha2(F.concat(*map(_field, columns)), 256)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the partition and each row's place among those of its tree there; rows come sorted."""
    part = TaskContext.get().partitionId()
    tree, place = object(), 0
    for batch in batches:
        places = []
        for name in batch.column("tree").to_pylist():
            tree, place = (tree, place + 1) if name == tree else (name, 0)
            places.append(place)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([part] * len(batch), pa.int64()), pa.array(places, pa.int64())],
            names=[*batch.schema.names, "part", "place"],
        )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with each one's ``place`` within its ``tree``, counted from 0, and the tree's ``size``.

    Rows are sorted by range and numbered within each range; what comes before a range is
    added from a table of counts for each range and tree. No task holds a whole tree.
    """
    parts = rows.sparkSession.conf.get("spark.sql.shuffle.partitions")
    by = [F.col("tree").asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    ranged = rows.repartitionByRange(int(parts), *by).sortWithinPartitions(*by)
    numbered = stage(ranged.mapInArrow(_number, f"{_ddl(rows)}, part long, place long"), "numbered")
    counts = numbered.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("n"))
    # One row for each range and tree.
    each = Window.partitionBy("tree")
    before = each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select(
        F.col("tree").alias("t"), F.col("part").alias("p"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(each).alias("size"),
    )
    placed = numbered.join(firsts, F.col("tree").eqNullSafe(F.col("t")) & (F.col("part") == F.col("p")))
    return placed.select(*rows.columns, (F.col("place") + F.col("first")).alias("place"), "size")


def _blocks(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[dict]]:
    """Whole blocks of rows that come sorted by tree, block and place."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.select(names).to_pylist():
            if held and (row["tree"], row["block"]) != (held[0]["tree"], held[0]["block"]):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _dealt(nodes: DataFrame, block: int) -> DataFrame:
    """Blocks of neighbours of a tree, each in one task and in order."""
    named = nodes.withColumn("block", F.expr(f"place div {block}"))
    return named.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _height(rows: list[dict], levels: int, fanout: int) -> int | None:
    """Levels to build: a tree that is one block is built up to its root."""
    return levels if rows[0]["size"] > fanout**levels else None


_NODE = "tree string, place long, size long, digest string"


def _roots(nodes: DataFrame, levels: int, fanout: int) -> DataFrame:
    """``tree, place, digest`` of the root of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ["tree", "block", "place", "size", "digest"]):
            tree = grow([r["digest"] for r in rows], fanout, _height(rows, levels, fanout))
            top = tree[-1][0].digest if tree else rows[0]["digest"]
            size = -(-rows[0]["size"] // fanout**levels)
            values = [[rows[0]["tree"]], [rows[0]["block"]], [size], [top]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names=["tree", "place", "size", "digest"]
            )

    return _dealt(nodes, fanout**levels).mapInArrow(run, _NODE)


#: A path upwards: for each level the children of the parent and the slot, from below.
_PATH = "array<struct<children:array<string>,slot:int>>"
_PATH_TYPE = pa.list_(pa.struct([("children", pa.list_(pa.string())), ("slot", pa.int32())]))


def _paths(nodes: DataFrame, above: DataFrame, levels: int, fanout: int) -> DataFrame:
    """``tree, place, path``: the way from each node to the dataset's root.

    ``above`` has the path of each block's root.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ["tree", "block", "place", "size", "digest", "above"]):
            tree = grow([r["digest"] for r in rows], fanout, _height(rows, levels, fanout))
            paths = []
            for i, row in enumerate(rows):
                own = [{"children": p.children, "slot": slot} for p, slot in path_above(tree, i, fanout)]
                paths.append(own + row["above"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["tree"] for r in rows], pa.string()), pa.array([r["place"] for r in rows], pa.int64()),
                 pa.array(paths, _PATH_TYPE)],
                names=["tree", "place", "path"],
            )

    return _with_above(nodes, above, fanout**levels).mapInArrow(run, f"tree string, place long, path {_PATH}")


def _with_above(nodes: DataFrame, above: DataFrame, block: int) -> DataFrame:
    """Blocks of nodes in order, each with the path above it."""
    tops = above.select(F.col("tree").alias("t"), F.col("place").alias("b"), F.col("path").alias("above"))
    named = nodes.withColumn("block", F.expr(f"place div {block}"))
    joined = named.join(tops, F.col("tree").eqNullSafe(F.col("t")) & (F.col("block") == F.col("b"))).drop("t", "b")
    return joined.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def _folded(leaves: DataFrame, above: DataFrame, levels: int, fanout: int) -> DataFrame:
    """Each leaf's proof, the dataset's root and what it becomes with the tampered leaf."""
    names = ["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches, ["id", "tree", "block", "place", "size", "digest", "tampered", "subroot", "above"]):
            tree = grow([r["digest"] for r in rows], fanout, _height(rows, levels, fanout))
            # The states of the parents above the block are made once for all its leaves.
            upper = [(Parent(step["children"]), step["slot"]) for step in rows[0]["above"]]
            beyond = "".join(p.siblings(slot) for p, slot in upper)
            top = tree[-1][0].digest if tree else rows[0]["digest"]
            root = upper[-1][0].digest if upper else top
            out = []
            for i, row in enumerate(rows):
                steps = path_above(tree, i, fanout)
                proof = "".join(p.siblings(slot) for p, slot in steps) + beyond
                folded = fold(row["tampered"], steps + upper)
                digest = hashlib.sha256(proof.encode()).hexdigest()
                out.append((row["id"], row["digest"], row["subroot"], root, digest, folded, folded == root))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names
            )

    schema = (
        "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    )
    return _with_above(leaves, above, fanout**levels).mapInArrow(run, schema)


def manifest(leaves: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """Trees over ``leaves (id, tree, digest, tampered)`` and the proof of each leaf.

    Leaves of a tree ascend by id (rows without one first, equal ids by their digest); trees
    are in order of their name (bytewise, the null one first). Returns ``id, leaf, subroot,
    root, proof_sha256, folded_root, verified``: the tree's root, the dataset's, the hash of all
    siblings on the way up, and the dataset's root with ``tampered`` in the leaf's place.
    Each row is a leaf, repeated ones too. A tree of one leaf is that leaf, without siblings.
    """
    nodes = stage(in_order(leaves, ["id", "digest", "tampered"]), "leaves")
    below: list[DataFrame] = []
    level = nodes
    while True:
        below.append(level)
        if not level.limit(1).count() or level.agg(F.max("size")).first()[0] == 1:
            break
        level = stage(_roots(level, levels, fanout), "nodes")
    # The last level has one node for each tree; those are the leaves of the dataset's tree.
    roots = level.select("tree", "digest")
    named = roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    trees = stage(in_order(named, ["name"]), "trees")
    tops, top = [], trees
    while True:
        tops.append(top)
        if not top.limit(1).count() or top.agg(F.max("size")).first()[0] == 1:
            break
        top = stage(_roots(top, levels, fanout), "nodes")
    empty = F.expr(f"cast(array() as {_PATH})")
    path = top.select("tree", "place", empty.alias("path"))
    for nodes_ in reversed(tops[:-1]):
        path = stage(_paths(nodes_, path, levels, fanout), "paths")
    found = path.select(F.col("tree").alias("t"), F.col("place").alias("p"), "path")
    path = trees.join(found, (F.col("tree") == F.col("t")) & (F.col("place") == F.col("p"))).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("place"), "path"
    )
    for nodes_ in reversed(below[1:-1]):
        path = stage(_paths(nodes_, path, levels, fanout), "paths")
    subroots = roots.select(F.col("tree").alias("s"), F.col("digest").alias("subroot"))
    whole = nodes.join(subroots, F.col("tree").eqNullSafe(F.col("s"))).drop("s")
    if len(below) == 1:  # every tree is a lone leaf
        return _folded(whole, path, 0, fanout)
    return _folded(whole, path, levels, fanout)


def document_manifest(docs: DataFrame, tampered: Column, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """The manifest of documents: a tree for each language, leaves in order of the doc_id.

    A leaf is the hash of ``doc_id, source, lang, n_chars, text``; ``tampered`` says for which
    rows the text's A-Z are lower-cased to make the leaf that is folded. Columns that are
    missing from ``docs`` count as null, further ones are not read; null and empty texts
    differ. An empty table gives no rows.
    """
    fields = ("doc_id", "source", "lang", "n_chars", "text")
    have = {c: (F.col(f"`{c}`") if c in docs.columns else F.lit(None)) for c in fields}
    lower = F.translate(have["text"].cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.when(F.coalesce(tampered, F.lit(False)), lower).otherwise(have["text"].cast("string"))
    changed = {**have, "text": text}
    leaves = docs.select(
        have["doc_id"].cast("long").alias("id"),
        have["lang"].cast("string").alias("tree"),
        leaf_digest([have[c] for c in fields]).alias("digest"),
        leaf_digest([changed[c] for c in fields]).alias("tampered"),
    )
    # Sorting by range reads its input twice; texts are digested once.
    return manifest(stage(leaves, "digests"), fanout, levels).withColumnRenamed("id", "doc_id")
