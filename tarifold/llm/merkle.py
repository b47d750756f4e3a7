"""Merkle manifest of a dataset: one tree a source, one tree over the sources, a witness for every row."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

FAN = 16
#: Levels that one block of leaves folds by itself; a block is ``FAN ** HEIGHT`` aligned leaves.
HEIGHT = 2
BLOCK = FAN ** HEIGHT
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Subtree:
    """A finished node that waits for its siblings, with the leaves below and its partial witness."""

    __slots__ = ("node", "first", "last", "left", "right")

    def __init__(self, node: str, first: int, last: int, left: str):
        self.node, self.first, self.last, self.left, self.right = node, first, last, left, []


class Frontier:
    """Append-only tree: leaves come in order, only unfinished runs stay open.

    A node that joins a run gets its left siblings at once; each sibling finished later is added
    to the partial witnesses of those before it. When the run closes, the leaves below take them.
    """

    def __init__(self, fan: int = FAN):
        self.fan = fan
        self.open: list[list[Subtree]] = [[]]
        self.witnesses: list[list[tuple[str, str]]] = []

    def append(self, leaf: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._join(0, leaf, at, at + 1)

    def _join(self, level: int, node: str, first: int, last: int) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        for sibling in run:
            sibling.right.append(node)
        run.append(Subtree(node, first, last, "".join(s.node for s in run)))
        if len(run) == self.fan:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for s in run:
            step = (s.left, "".join(s.right))
            for leaf in range(s.first, s.last):
                self.witnesses[leaf].append(step)
        self._join(level + 1, digest("".join(s.node for s in run)), run[0].first, run[-1].last)

    def finish(self, height: int | None = None) -> str:
        """Close what is open, up to ``height`` levels or until one node is left; returns that node."""
        level = 0
        while level < height if height is not None else (len(self.open[level]) != 1 or any(self.open[level + 1:])):
            if self.open[level]:
                self._close(level)
            level += 1
        return self.open[level][0].node


def fold(leaf: str, witness) -> str:
    """The root that a leaf and its siblings give."""
    for left, right in witness:
        leaf = digest(left + leaf + right)
    return leaf


def leaf_hash(*values: Column) -> Column:
    """Hex sha256 over the values, each as ``-`` (NULL) or its UTF-8 length, ``:`` and itself."""

    def part(c: Column) -> Column:
        c = c.cast("string")
        return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))

    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def positions(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``pos`` (from 0 within ``tree``, by ``order``) and ``n``, the rows of the tree.

    Rows are dealt into ranges of (tree, order), so a tree with a third of all rows is many ranges; only
    the row counts of (tree, range) are summed up, one row each.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, tree, *order).sortWithinPartitions(tree, *order).select(
        "*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().alias("at"))
    ranged = stored(ranged, name)
    runs = ranged.groupBy(tree, "range").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(tree, "range", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"),
                          F.sum("rows").over(whole).alias("n"))
    return ranged.join(offsets, [tree, "range"]).withColumn(
        "pos", F.col("before") + F.col("at") - F.col("first")).drop("range", "at", "first", "before")


WITNESS = "array<struct<l:string,r:string>>"


def _blocks(nodes: DataFrame, *columns: str) -> DataFrame:
    """Nodes dealt by block and in the order of appending."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return nodes.repartition(parts, "tree", "block").sortWithinPartitions("tree", "block", "at").select("tree", "block", "at", *columns)


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]):
    """(tree, block) and its rows, one block at a time, whatever the batches' bounds."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in ["tree", "block", *columns]], strict=True):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row[2:])
    if rows:
        yield key, rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    part = []
    for row in rows:
        part.append(row)
        if len(part) == size:
            yield _batch(part, schema)
            part = []
    if part:
        yield _batch(part, schema)


def _appended(leaves: list[str], n: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of a block and the leaves' partial witnesses; a block that is the whole tree ends at one node."""
    tree = Frontier()
    for leaf in leaves:
        tree.append(leaf)
    return tree.finish(HEIGHT if n > BLOCK else None), tree.witnesses


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("n", pa.int64()), ("node", pa.binary())])

    def rows():
        for (tree, block), members in _groups(batches, ["n", "node"]):
            n = members[0][0]
            root, _ = _appended([node.hex() for _, node in members], n)
            yield tree, block, -(-n // BLOCK), bytes.fromhex(root)

    return _in_batches(rows(), schema)


def _handed_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Witnesses of nodes: their own part in the block, then what the block's root has. Row ``at`` -1 brings the latter."""
    step = pa.struct([("l", pa.string()), ("r", pa.string())])
    schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("witness", pa.list_(step)), ("subroot", pa.string()), ("root", pa.string())])

    def rows():
        for (tree, block), (head, *members) in _groups(batches, ["n", "node", "witness", "subroot", "root"]):
            above, subroot, root = head[2:]
            _, witnesses = _appended([m[1].hex() for m in members], members[0][0])
            for at, own in enumerate(witnesses):
                yield tree, block * BLOCK + at, [{"l": left, "r": right} for left, right in own] + above, subroot, root

    return _in_batches(rows(), schema, 256)


def _proved(id_type: pa.DataType):
    """Rows with their proofs; one block's witnesses are in memory at a time."""
    schema = pa.schema([("id", id_type), ("tree", pa.string()), ("pos", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()),
                        ("root", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (tree, block), (head, *members) in _groups(batches, ["n", "node", "witness", "subroot", "root", "id", "claimed"]):
                above, subroot, root = [(s["l"], s["r"]) for s in head[2]], *head[3:5]
                leaves = [m[1].hex() for m in members]
                _, witnesses = _appended(leaves, members[0][0])
                for at, (own, leaf, member) in enumerate(zip(witnesses, leaves, members, strict=True)):
                    witness = own + above
                    folded = fold(leaf if member[6] is None else member[6].hex(), witness)
                    yield (member[5], tree, block * BLOCK + at, leaf, subroot, root,
                           digest("".join(left + right for left, right in witness)), folded, folded == root)

        return _in_batches(rows(), schema)

    return run


def _grow(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Fold trees block by block; block roots are the next round's leaves. Returns the rounds and one root a tree.

    The number of rounds is the logarithm of the largest tree to the base ``BLOCK``.
    """
    rounds = []
    while True:
        nodes = nodes.withColumns({"block": F.floor(F.col("pos") / BLOCK), "at": F.col("pos") % BLOCK})
        rounds.append(nodes)
        roots = stored(_blocks(nodes, "n", "node").mapInArrow(_roots, "tree string, pos long, n long, node binary"), name)
        if (roots.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds, roots
        nodes = roots


def _headed(nodes: DataFrame, above: DataFrame, *carried: str) -> DataFrame:
    """Blocks with the witness of their root as a first row, so that it travels once a block."""
    types = dict(nodes.dtypes)
    heads = above.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("at"), F.lit(None).cast("long").alias("n"),
                         F.lit(None).cast("binary").alias("node"), "witness", "subroot", "root",
                         *[F.lit(None).cast(types[c]).alias(c) for c in carried])
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("witness", WITNESS), ("subroot", "string"), ("root", "string"))]
    rows = nodes.select("tree", "block", "at", "n", "node", *nothing, *carried).unionByName(heads)
    return _blocks(rows, "n", "node", "witness", "subroot", "root", *carried)


def _hand_down(nodes: DataFrame, above: DataFrame) -> DataFrame:
    return _headed(nodes, above).mapInArrow(_handed_down, f"tree string, pos long, witness {WITNESS}, subroot string, root string")


@dataclass
class Manifest:
    """``leaves``: tree, pos, n, node (the leaf), id, claimed; ``subroots``: tree, node; ``root``: hex, None without rows;
    ``rounds`` and ``top``: the nodes that were appended, round by round, of the sources' trees and of the one over them."""

    leaves: DataFrame
    subroots: DataFrame
    root: str | None
    rounds: list[DataFrame]
    top: list[DataFrame]


def build_manifest(docs: DataFrame, claimed: Column | None = None, columns: tuple[str, ...] = COLUMNS,
                   id_col: str = "doc_id", tree_col: str = "source") -> Manifest:
    """Trees over the rows of ``docs``, one for each value of ``tree_col``, and one over their roots.

    A row's leaf hashes ``columns``. In a tree leaves ascend by id (NULL first), then by leaf; every 16 consecutive
    nodes become one, until one is left. Blocks of 256 aligned leaves are appended in one task each; the blocks'
    roots are appended likewise, so no tree passes through one task, however large. ``claimed`` is a leaf hash that
    somebody claims for the row (NULL: the row's own); :func:`prove` folds it.

    Texts are read once, for hashing; what moves are 32-byte digests. Equal rows are leaves each. NULL is a value of
    its own in every column, also in the tree column (its tree comes first). An empty table has no root. Other columns
    play no part.
    """
    tree = F.coalesce(F.concat(F.lit("="), F.col(tree_col).cast("string")), F.lit(""))
    leaves = docs.select(
        tree.alias("tree"), F.col(id_col).alias("id"), F.unhex(leaf_hash(*[F.col(c) for c in columns])).alias("node"),
        F.unhex(F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"), F.monotonically_increasing_id().alias("row"))
    leaves = stored(leaves, "merkle-leaves")
    leaves = stored(positions(leaves, "tree", ["id", "node", "row"], "merkle-ranges").drop("row"), "merkle-placed")
    rounds, subroots = _grow(leaves, "merkle-roots")
    nodes = positions(subroots.select(F.lit("").alias("all"), F.col("tree").alias("of"), "node"), "all", ["of"], "merkle-subroots")
    top, root = _grow(stored(nodes.select(F.col("all").alias("tree"), "pos", "n", "node", "of"), "merkle-top"), "merkle-root")
    last = root.first()
    return Manifest(leaves, subroots.select("tree", "node"), None if last is None else bytes(last["node"]).hex(), rounds, top)


def prove(manifest: Manifest) -> DataFrame:
    """A row for each leaf: ``id, tree, pos, leaf, subroot, root, proof_sha256, folded_root, verified``.

    Witnesses go from the top round down, one row a block; a leaf's whole witness exists in memory only.
    ``proof_sha256`` hashes its siblings, level by level, left to right.
    """
    spark = manifest.leaves.sparkSession
    above = spark.range(0 if manifest.root is None else 1).select(
        F.lit("").alias("tree"), F.col("id").alias("pos"), F.array().cast(WITNESS).alias("witness"), F.lit(None).cast("string").alias("subroot"),
        F.lit(manifest.root).cast("string").alias("root"))
    for nodes in reversed(manifest.top):
        above = _hand_down(nodes, above)
    names = manifest.top[0].select("pos", F.col("of").alias("tree"), F.lower(F.hex("node")).alias("subroot"))
    above = above.drop("tree", "subroot").join(names, "pos").select("tree", F.lit(0).cast("long").alias("pos"), "witness", "subroot", "root")
    above = stored(above, "merkle-sources")
    for nodes in reversed(manifest.rounds[1:]):
        above = stored(_hand_down(nodes, above), "merkle-handed")
    lowest = _headed(manifest.rounds[0], above, "id", "claimed")
    id_type = manifest.leaves.schema["id"].dataType
    return lowest.mapInArrow(_proved(to_arrow_type(id_type)), (
        f"id {id_type.simpleString()}, tree string, pos long, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean"))
