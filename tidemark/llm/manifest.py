"""Merkle manifest of a table of documents (operator 12).

A leaf is the digest of a row's fields. In each source the leaves ascend by
doc_id; while several nodes remain, every 16 consecutive ones become the digest of
their digests, as hex text. The nodes that remain, one for each source, are joined
likewise in order of source, and leave the root.

Method: a tree of SHA midstates. A parent keeps a copy of its hash state before
each child's slot. To replace a child, the state of its slot is resumed with the
replacement and the siblings to the right; those to the left are never hashed again.

1. Spark hashes the rows where they are; only (doc_id, source, leaf, altered leaf)
   goes on. Leaves are numbered within their source by ``sequence_number``, which
   splits a hot source over many tasks.
2. 256 consecutive nodes of a tree, a whole subtree of height ``HEIGHT``, make a
   block. Rows are dealt by (tree, block), so that no group has more than a block's
   rows, and pass in order through their task, one block at a time. The blocks' tops
   are the next nodes: a 256th as many, until each tree is one block.
3. From the top down each block gets its path: for every parent above it the
   digests of the parent's children and the block's slot among them. It travels as
   one row ahead of the block's own.
4. A block's task builds the midstates of its own parents and of those on its path
   once, and folds each of its leaves through them to the root.

Defined cases: a null field is "-" in the leaf; a null source comes first, an empty
one after it. Leaves with a null doc_id come first in their source; those that
repeat a doc_id follow in order of their digests. An empty table has no root and
gives no rows. Columns that are not fields are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import sequence_number
from ..session import materialize
from ._ship import ready

RUN = 16
HEIGHT = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = T.ArrayType(T.StructType([T.StructField("slot", T.IntegerType()), T.StructField("kids", T.ArrayType(T.BinaryType()))]))
_ROWS = 4096  # rows of a batch that leaves a task


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field "-" if null, else its UTF-8 length, a colon and itself."""
    shown = []
    for name in FIELDS:
        text = fields[name].cast("string")
        shown.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*shown), 256))


# --- parents and their midstates --------------------------------------------

class Parent:
    """The run of children under one node, with the hash state before each slot."""

    __slots__ = ("states", "text", "digest")

    def __init__(self, kids: list[bytes]):
        self.text = "".join(k.hex() for k in kids).encode()
        self.states = []
        state = hashlib.sha256()
        for at in range(0, len(self.text), 64):
            self.states.append(state.copy())
            state.update(self.text[at:at + 64])
        self.digest = state.digest()

    def fold(self, slot: int, kid: bytes) -> bytes:
        """This node's digest with another child in a slot."""
        state = self.states[slot].copy()
        state.update(kid.hex().encode() + self.text[64 * (slot + 1):])
        return state.digest()

    def siblings(self, slot: int) -> bytes:
        return self.text[:64 * slot] + self.text[64 * (slot + 1):]


def levels(n: int, most: int) -> int:
    """How often n nodes are joined until one remains, ``most`` times at most."""
    k = 0
    while n > 1 and k < most:
        n, k = -(-n // RUN), k + 1
    return k


def subtree(block: int, kids: list[bytes], height: int) -> list[list[Parent]]:
    """The parents of a block's nodes, level by level. The first block of a tree is
    all of it unless it is full; a later one is joined to its full height."""
    out, nodes = [], kids
    for _ in range(height if block else levels(len(kids), height)):
        out.append([Parent(nodes[k:k + RUN]) for k in range(0, len(nodes), RUN)])
        nodes = [p.digest for p in out[-1]]
    return out


# --- blocks, one after the other --------------------------------------------

def _by_block(rows: DataFrame, work: Callable[[dict[str, list]], dict[str, list]], schema: T.StructType) -> DataFrame:
    """``work`` on the rows of each (tree, block), in order of pos."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.field(f.name, _arrow(f.dataType)) for f in schema.fields]
        made: dict[str, list] = {f.name: [] for f in schema.fields}
        left: dict[str, list] = {}

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(made[k.name], k.type) for k in kinds], schema.names)
            for column in made.values():
                column.clear()
            return out

        def done(group: dict[str, list]) -> None:
            for name, values in work(group).items():
                made[name] += values

        for batch in batches:
            new = {n: c.to_pylist() for n, c in zip(batch.schema.names, batch.columns)}
            rows_ = {n: left.get(n, []) + new[n] for n in new}
            key = list(zip(rows_["tree"], rows_["block"]))
            a = 0
            for b in range(1, len(key)):
                if key[b] != key[a]:
                    done({n: v[a:b] for n, v in rows_.items()})
                    a = b
                    if len(made["tree"]) >= _ROWS:
                        yield flush()
            left = {n: v[a:] for n, v in rows_.items()}
        if left and left["tree"]:
            done(left)
        yield flush()

    return (rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")
            .mapInArrow(run, schema))


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(kind)


_TOPS = T.StructType([T.StructField("tree", T.StringType()), T.StructField("pos", T.LongType()), T.StructField("digest", T.BinaryType())])
_PATHS = T.StructType([*_TOPS.fields[:2], T.StructField("path", _PATH)])


def _tops(height: int):
    def work(group: dict[str, list]) -> dict[str, list]:
        kids, block = group["digest"], group["block"][0]
        up = subtree(block, kids, height)
        return {"tree": group["tree"][:1], "pos": [block], "digest": [up[-1][0].digest if up else kids[0]]}

    return work


def _local(i: int, up: list[list[Parent]]) -> Iterator[tuple[int, Parent]]:
    """Slot and parent of a block's i-th node, upwards."""
    for parents in up:
        yield i % RUN, parents[i // RUN]
        i //= RUN


def _paths(height: int):
    def work(group: dict[str, list]) -> dict[str, list]:
        above, kids, block = group["path"][0], group["digest"][1:], group["block"][0]
        up = subtree(block, kids, height)
        runs = {id(p): [bytes.fromhex(p.text[k:k + 64].decode()) for k in range(0, len(p.text), 64)] for level in up for p in level}
        path = [[{"slot": s, "kids": runs[id(p)]} for s, p in _local(i, up)] + above for i in range(len(kids))]
        return {"tree": group["tree"][1:], "pos": group["pos"][1:], "path": path}

    return work


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / RUN ** height).cast("long"))


def _headed(nodes: DataFrame, paths: DataFrame, height: int) -> DataFrame:
    """Nodes and, ahead of each block's, the block's path (tree, pos: block, path, ...)."""
    head = paths.withColumnRenamed("pos", "block").withColumn("pos", F.lit(-1).cast("long"))
    return _in_blocks(nodes, height).unionByName(head, allowMissingColumns=True)


def climb(nodes: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """Join nodes (tree, pos, digest; pos from 0 in each tree) up to one for each
    tree: those (tree, digest), and the path (tree, pos, path) of each block."""
    tops = materialize(_by_block(_in_blocks(nodes.select("tree", "pos", "digest"), height), _tops(height), _TOPS), "tops")
    if not (tops.agg(F.max("pos")).first()[0] or 0):
        return tops.drop("pos"), tops.select("tree", "pos", F.array().cast(_PATH).alias("path"))
    roots, above = climb(tops, height)
    return roots, materialize(node_paths(tops, above, height), "paths")


def node_paths(nodes: DataFrame, above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The path (tree, pos, path) of each node, from those of the blocks."""
    return _by_block(_headed(nodes.select("tree", "pos", "digest"), above, height), _paths(height), _PATHS)


# --- documents --------------------------------------------------------------

def _answers(root: bytes, height: int):
    def work(group: dict[str, list]) -> dict[str, list]:
        kids, n = group["digest"][1:], len(group["pos"]) - 1
        up = subtree(group["block"][0], kids, height)
        above = [(x["slot"], Parent(x["kids"])) for x in group["path"][0]]
        higher = b"".join(p.siblings(s) for s, p in above)
        proof, folded = [], []
        for i, (kid, other) in enumerate(zip(kids, group["altered"][1:])):
            own = list(_local(i, up))
            proof.append(hashlib.sha256(b"".join(p.siblings(s) for s, p in own) + higher).hexdigest())
            node = other or kid
            for s, p in [*own, *above]:
                node = p.fold(s, node)
            folded.append(node)
        return {"tree": [None] * n, "doc": group["doc"][1:], "leaf": [k.hex() for k in kids],
                "subroot": [group["subroot"][0].hex()] * n, "root": [root.hex()] * n, "proof_sha256": proof,
                "folded_root": [f.hex() for f in folded], "verified": [f == root for f in folded]}

    return work


def subroots(leaves: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of numbered leaves: the subroots (tree, digest, pos in order of source), the
    blocks' paths up to their subroot, and the subroots' paths up to the root."""
    tops, paths = climb(leaves, height)
    trees = materialize(sequence_number(tops, ["tree"], "pos"), "trees")
    alone = trees.select(F.lit("").alias("tree"), "pos", "digest")
    _, above = climb(alone, height)
    to_root = node_paths(alone, above, height).select("pos", F.col("path").alias("higher"))
    return trees, paths, materialize(to_root.join(trees.withColumnRenamed("digest", "subroot"), "pos"), "to_root")


def manifest(docs: DataFrame, altered: dict[str, Column] | None = None, where: Column | None = None,
             height: int = HEIGHT) -> DataFrame:
    """One row for each of ``docs`` (``FIELDS``, any others): doc_id, leaf, subroot,
    root, proof_sha256 (of the leaf's siblings up to the root), and, for a row with
    ``altered`` fields where ``where`` holds, folded_root: the root that the altered
    leaf and the siblings lead to, and whether it is the root (verified). Blocks are
    subtrees of the given height."""
    spark = ready(docs.sparkSession)
    own = {n: F.col(f"`{n}`") for n in FIELDS}
    other = F.when(where if where is not None else F.lit(True), leaf_digest(own | altered)) if altered else F.lit(None).cast("binary")
    rows = materialize(docs.select(
        own["doc_id"].alias("doc"), F.coalesce(F.concat(F.lit("s"), own["source"].cast("string")), F.lit("")).alias("tree"),
        leaf_digest(own).alias("digest"), other.alias("altered")), "rows")
    leaves = materialize(sequence_number(rows, ["doc", "digest", "altered"], "pos", ["tree"]), "leaves")
    trees, paths, to_root = subroots(leaves, height)
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("doc", docs.schema["doc_id"].dataType)] + [
        T.StructField(n, T.StringType()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    ] + [T.StructField("verified", T.BooleanType())])
    top = to_root.filter("pos = 0").first()
    if top is None:
        return spark.createDataFrame([], schema).drop("tree").withColumnRenamed("doc", "doc_id")
    root = bytes(top["subroot"])
    for x in top["higher"]:
        root = Parent([bytes(k) for k in x["kids"]]).digest
    heads = paths.join(to_root.select("tree", "higher", "subroot"), "tree").select(
        "tree", "pos", F.concat("path", "higher").alias("path"), "subroot")
    return (_by_block(_headed(leaves.select("tree", "pos", "doc", "digest", "altered"), heads, height), _answers(root, height), schema)
            .drop("tree").withColumnRenamed("doc", "doc_id"))
