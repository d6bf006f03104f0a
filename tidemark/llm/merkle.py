"""A Merkle manifest of a dataset: hashes that prove a row is the one that was listed.

Each row is a leaf.  The leaves of a source, in order of ids, are the bottom of a tree
in which every ``FAN`` consecutive nodes have their hash as parent (the last run may be
shorter, even one node) until one is left, the source's subroot; the subroots, in order
of sources, are the bottom of one more such tree, whose top is the dataset's root.

A tree is cut into *blocks*: aligned subtrees of ``LEVELS`` levels of edges, 4,096
leaves.  A task builds a block and stores it as one array of digests in van Emde Boas
order: the upper half of the subtree's levels first, then the subtrees hanging from it,
each laid out in the same way.  ``address`` computes a node's place from its depth and
index alone, for whole arrays of nodes at once; it serves both the construction and the
retrieval of siblings.  The roots of the blocks are the leaves of the next round's
blocks, until every tree is one block.  Siblings are handed down the other way: a
block's own path to the root comes from its parent's block, so a proof needs its leaf's
block and that path, whatever the size of the dataset, and no task more than one block.

Positions of leaves come from a range partitioning in order of (source, id, leaf) and
from prefix sums over (partition, source), so a source with a third of all rows is
spread like any other.

Rows: one per row.  A null field is written ``-``; a null id comes first in its source
and is never tampered with; a null source is a source of its own, the first.  Rows that
repeat an id are ordered by their leaves, so equal rows have the same proofs up to their
place.  Texts are hashed whole, whatever their length.  An empty table has no leaves, no
root and an empty result.  Only the five columns of the leaf are read, so other columns
may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.native import ascii_lower
from tidemark.llm.store import ship_package, stored
from tidemark.operators.ordering import with_row_index

FAN = 16
#: Levels of edges in a block: FAN ** LEVELS leaves.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_SIZE = 32


# ------------------------------------------------------------------- layout

def nodes(levels: int, fan: int = FAN) -> int:
    """Nodes of a complete subtree with ``levels`` levels of nodes."""
    return (fan ** levels - 1) // (fan - 1)


def address(depth: int, index: np.ndarray, levels: int, fan: int = FAN) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes ``index`` (from the left) at ``depth``
    of a subtree with ``levels`` levels of nodes: the upper levels // 2 of them are laid
    out first, then the subtrees below, left to right, each in the same order."""
    base = np.zeros(len(index), np.int64)
    index = np.asarray(index, np.int64)
    while levels > 1:
        upper = levels // 2
        if depth < upper:
            levels = upper
            continue
        depth -= upper
        below = fan ** depth
        base += nodes(upper, fan) + index // below * nodes(levels - upper, fan)
        index, levels = index % below, levels - upper
    return base


class Block:
    """A subtree in van Emde Boas order, its first ``count`` leaves filled."""

    def __init__(self, layout: np.ndarray, count: int, height: int, fan: int = FAN):
        self.layout, self.count, self.height, self.fan = layout, count, height, fan

    @classmethod
    def build(cls, leaves: np.ndarray, height: int, fan: int = FAN) -> Block:
        """From digests (rows of 32 bytes): every run of ``fan`` nodes is hashed as hex text."""
        count = len(leaves)
        used = [-(-count // fan ** up) for up in range(height + 1)]
        places = [address(height - up, np.arange(used[up]), height + 1, fan) for up in range(height + 1)]
        out = cls(np.zeros((int(max(p.max() for p in places)) + 1, _SIZE), np.uint8), count, height, fan)
        out.layout[places[0]] = leaves
        for up in range(height):
            text = out.layout[places[up]].tobytes().hex().encode()
            size = 2 * _SIZE * fan
            digests = b"".join(hashlib.sha256(text[a:a + size]).digest() for a in range(0, len(text), size))
            out.layout[places[up + 1]] = np.frombuffer(digests, np.uint8).reshape(-1, _SIZE)
        return out

    @property
    def root(self) -> str:
        return self.layout[int(address(0, np.zeros(1, np.int64), self.height + 1, self.fan)[0])].tobytes().hex()

    def siblings(self, leaf: int) -> list[tuple[str, str]]:
        """Per level, from the leaf up: the hex digests left and right of the path's node."""
        out, at = [], leaf
        for up in range(self.height):
            used = -(-self.count // self.fan ** up)
            first = at // self.fan * self.fan
            run = np.arange(first, min(first + self.fan, used))
            digests = self.layout[address(self.height - up, run, self.height + 1, self.fan)].tobytes().hex()
            cut = 2 * _SIZE * (at - first)
            out.append((digests[:cut], digests[cut + 2 * _SIZE:]))
            at //= self.fan
        return out


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in path:
        leaf = hashlib.sha256((left + leaf + right).encode()).hexdigest()
    return leaf


def proof_digest(path: list[tuple[str, str]]) -> str:
    return hashlib.sha256("".join(left + right for left, right in path).encode()).hexdigest()


# ------------------------------------------------------------------- leaves

def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(fields: list[Column]) -> Column:
    """sha256, in hex, of the fields: ``-`` for a null, else byte length, colon and value."""
    return F.sha2(F.concat(*(_field(f) for f in fields)), 256)


def _tree(source: Column) -> Column:
    """A source as a key that isn't null and keeps the order, null first."""
    return F.coalesce(F.concat(F.lit("+"), source.cast("string")), F.lit(""))


def _positions(rows: DataFrame) -> DataFrame:
    """Stored rows (tree, id, leaf, ...) with ``pos`` in their tree and its size ``n``."""
    ordered = rows.repartitionByRange("tree", "id", "leaf").sortWithinPartitions("tree", "id", "leaf") \
        .withColumn("part", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    ordered = stored(ordered, "leaves")
    parts = ordered.groupBy("tree", "part").agg(F.min("row").alias("first"), F.count("*").alias("c"))
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("tree", "part", "first", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("base"),
                         F.sum("c").over(Window.partitionBy("tree")).alias("n"))
    # a key of this join is one tree in one partition
    return ordered.join(parts, ["tree", "part"]) \
        .withColumn("pos", F.col("base") + F.col("row") - F.col("first")).drop("part", "row", "first", "base")


# ------------------------------------------------------------------- blocks

_BLOCKS = "tree string, block bigint, n bigint, count bigint, height int, layout binary, root string"
_PATH = "array<struct<left:string,right:string>>"
_PATH_ARROW = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def _built(fan: int, levels: int):
    def run(key, table):
        order = np.argsort(table.column("pos").to_numpy(), kind="stable")
        hexes = "".join(table.column("digest").take(pa.array(order)).to_pylist())
        leaves = np.frombuffer(bytes.fromhex(hexes), np.uint8).reshape(-1, _SIZE)
        n = table.column("n")[0].as_py()
        height = 0
        while fan ** height < min(n, fan ** levels):
            height += 1
        block = Block.build(leaves, height, fan)
        return pa.table({"tree": [key[0].as_py()], "block": pa.array([key[1].as_py()], pa.int64()),
                         "n": pa.array([n], pa.int64()), "count": pa.array([len(leaves)], pa.int64()),
                         "height": pa.array([height], pa.int32()),
                         "layout": pa.array([block.layout.tobytes()], pa.binary()), "root": [block.root]})

    return run


def build(bottom: DataFrame, fan: int = FAN, levels: int = LEVELS) -> list[DataFrame]:
    """Blocks of trees, from the bottom up, of nodes (tree, pos, digest, n): the rounds'
    stored tables.  A tree of more than one block goes on in the next one, its blocks'
    roots being the nodes."""
    ship_package(bottom.sparkSession)
    size, rounds = fan ** levels, []
    while True:
        grouped = bottom.select("tree", F.floor(F.col("pos") / size).cast("bigint").alias("block"), "pos", "digest", "n")
        blocks = stored(grouped.groupBy("tree", "block").applyInArrow(_built(fan, levels), _BLOCKS), "merkle-blocks")
        rounds.append(blocks)
        open_ = blocks.where(F.col("n") > size)
        if open_.isEmpty():
            return rounds
        bottom = open_.select("tree", F.col("block").alias("pos"), F.col("root").alias("digest"),
                              F.ceil(F.col("n") / size).cast("bigint").alias("n"))


def _read(row: dict, fan: int) -> Block:
    layout = np.frombuffer(row["layout"], np.uint8).reshape(-1, _SIZE)
    return Block(layout, row["count"], row["height"], fan)


def _handed_down(fan: int, levels: int):
    """Blocks with the path above their root -> the path above each of their leaves."""

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                block = _read(row, fan)
                above = [(s["left"], s["right"]) for s in row["path"]]
                first = row["block"] * fan ** levels
                for start in range(0, block.count, 256):
                    own = range(start, min(start + 256, block.count))
                    paths = [[{"left": a, "right": b} for a, b in block.siblings(i) + above] for i in own]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["tree"]] * len(own)), pa.array([first + i for i in own], pa.int64()),
                         pa.array(paths, _PATH_ARROW)], names=["tree", "pos", "path"])

    return run


def _paths(rounds: list[DataFrame], tops: DataFrame, fan: int, levels: int) -> DataFrame:
    """The blocks of the first round with the ``path`` above their roots; ``tops`` has the
    path above each tree's root."""
    size, above = fan ** levels, None
    for k in reversed(range(len(rounds))):
        top = rounds[k].where(F.col("n") <= size).join(tops, "tree")
        own = top if above is None else top.unionByName(
            rounds[k].where(F.col("n") > size).join(above.withColumnRenamed("pos", "block"), ["tree", "block"]))
        if k == 0:
            return own
        above = stored(own.mapInArrow(_handed_down(fan, levels), f"tree string, pos bigint, path {_PATH}"), "merkle-paths")
    raise ValueError("no rounds")


def _proved(fan: int, levels: int):
    def run(rows, blocks):
        row = blocks.to_pylist()[0]
        block = _read(row, fan)
        above = [(s["left"], s["right"]) for s in row["path"]]
        base = row["block"] * fan ** levels
        proofs, folded = [], []
        for pos, leaf, altered in zip(*(rows.column(c).to_pylist() for c in ("pos", "digest", "altered"))):
            path = block.siblings(pos - base) + above
            proofs.append(proof_digest(path))
            folded.append(fold(altered or leaf, path))
        return pa.table({"id": rows.column("id"), "leaf": rows.column("digest"),
                         "subroot": pa.array([row["subroot"]] * len(proofs), pa.string()),
                         "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})

    return run


def merkle_manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
                    source_col: str = "source", altered: Column | None = None, fan: int = FAN, levels: int = LEVELS):
    """(leaves, rounds of the sources' blocks, subroots, rounds of the root's blocks).

    ``leaves`` holds tree, id, pos, digest, n and ``altered``, the hash of a leaf as it
    would be after tampering (null where there is none).  ``subroots`` holds tree, pos,
    digest.  The root is the ``root`` of the only block of the last round; an empty table
    has no rows in any of them."""
    rows = documents.select(_tree(F.col(source_col)).alias("tree"), F.col(id_col).alias("id"),
                            leaf_hash([F.col(c) for c in fields]).alias("leaf"),
                            (F.lit(None).cast("string") if altered is None else altered).alias("altered"))
    leaves = stored(_positions(rows).withColumnRenamed("leaf", "digest"), "merkle-leaves")
    rounds = build(leaves, fan, levels)
    tops = None
    for blocks in rounds:
        own = blocks.where(F.col("n") <= fan ** levels).select("tree", F.col("root").alias("digest"))
        tops = own if tops is None else tops.union(own)
    subroots = stored(with_row_index(tops, ["tree"], "pos"), "subroots")
    many = subroots.count()
    upper = build(subroots.select(F.lit("").alias("tree"), "pos", "digest", F.lit(many).cast("bigint").alias("n")),
                  fan, levels)
    return leaves, rounds, subroots, upper


def verified(documents: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             source_col: str = "source", altered: Column | None = None, fan: int = FAN, levels: int = LEVELS) -> DataFrame:
    """Per row: ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of the leaf's siblings),
    ``folded_root`` (from the altered leaf where there is one) and ``verified``."""
    leaves, rounds, subroots, upper = merkle_manifest(documents, fields, id_col, source_col, altered, fan, levels)
    spark, size = documents.sparkSession, fan ** levels
    id_type = documents.schema[id_col].dataType
    nothing = spark.createDataFrame([("", [])], f"tree string, path {_PATH}")
    top = _paths(upper, nothing, fan, levels)
    above = stored(top.mapInArrow(_handed_down(fan, levels), f"tree string, pos bigint, path {_PATH}"), "merkle-paths")
    tops = stored(subroots.join(above.select("pos", "path"), "pos").select("tree", "digest", "path"), "tops")
    blocks = _paths(rounds, tops.select("tree", "path"), fan, levels) \
        .join(tops.select("tree", F.col("digest").alias("subroot")), "tree")
    own = leaves.withColumn("block", F.floor(F.col("pos") / size).cast("bigint"))
    schema = f"id {id_type.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string"
    proved = own.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")) \
        .applyInArrow(_proved(fan, levels), schema)
    root = upper[-1].select("root").first()  # one row, or none
    return proved.withColumn("root", F.lit(root[0] if root else None).cast("string")) \
        .select(F.col("id").alias(id_col), "leaf", "subroot", "root", "proof_sha256", "folded_root",
                (F.col("folded_root") == F.col("root")).alias("verified"))


def lower_cased(documents: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text",
                share: int = 5) -> Column:
    """Tampering for tests of a manifest: the leaf with its text's A-Z in lower case, for rows
    whose crc32 of the decimal id is divisible by ``share``; null for all others."""
    columns = [ascii_lower(F.col(c)) if c == text_col else F.col(c) for c in fields]
    return F.when(F.crc32(F.col(id_col).cast("string").cast("binary")) % share == 0, leaf_hash(columns))
