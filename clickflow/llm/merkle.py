"""Merkle manifest of a table, with a witness for every row, built by distributed incremental append.

Each row is a leaf: the SHA-256 of its fields, each as its UTF-8 length, a colon and its value. The leaves
of one language make a tree by ascending doc_id: runs of WIDTH consecutive nodes become their hash, level
by level, until one node is left, the subroot. The subroots, ordered by language, make the root likewise.

Leaves get their position in their tree and are dealt to tasks by aligned blocks of WIDTH ** DEPTH positions. A task
appends a block's nodes to a frontier of open subtrees, one run a level. A node comes with a partial
witness of its own; when its run completes (or the block ends), the run's digests extend the witness of
every member of it, and the run's hash is appended one level up. What a block leaves is one digest, the
root of a subtree: block roots are appended like leaves, in a later round of WIDTH ** DEPTH times fewer
nodes, until every tree is one block. Then the witnesses go down again: a block's own witness is the first
row of its second append, and extends what its members have. So no task or row holds more than a block,
however large a language is; the driver sees one number a round.

A witness is a byte string: for each level the node's place in its run, the run's size and the digests of
the run's others. ``folded`` recomputes the root from any leaf and a witness.

A null field is ``-``; a null doc_id comes first in its tree, and rows with one doc_id follow the order of
their digests (equal rows have equal leaves and each its own place). A null language is a tree of its own,
the first. An empty table gives no rows. Columns beside the five fields do not matter.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickflow.llm.common import python_path, written
from clickflow.operators.sequence import with_position

WIDTH, DEPTH = 8, 4
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
DIGEST = 32


def leaf_digest(fields: list[Column]) -> Column:
    """Binary SHA-256 of the fields."""
    texts = [f.cast("string") for f in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*framed), 256))


def hashed(digests: list[bytes]) -> bytes:
    """SHA-256 of the digests as hexadecimal text, joined."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def levels(nodes: int) -> int:
    """Levels from that many nodes up to one."""
    n = 0
    while nodes > 1:
        nodes, n = -(-nodes // WIDTH), n + 1
    return n


class Frontier:
    """Open subtrees of an append of up to WIDTH ** height nodes. With ``witnesses``
    each node appended gets its witness extended by every run it becomes part of."""

    def __init__(self, height: int, witnesses: bool):
        self.height, self.witnesses = height, witnesses
        self.runs: list[list[bytes]] = [[] for _ in range(height + 1)]
        self.members: list[list[list[bytearray]]] = [[] for _ in range(height + 1)]  # of each node of a run

    def append(self, digest: bytes, witness: bytearray | None = None, level: int = 0,
               members: list[bytearray] | None = None) -> None:
        if self.witnesses:
            self.members[level].append(members if members is not None else [witness])
        self.runs[level].append(digest)
        if level < self.height and len(self.runs[level]) == WIDTH:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, members = self.runs[level], self.members[level]
        self.runs[level], self.members[level] = [], []
        below = []
        for place, own in enumerate(members):
            others = bytes((place, len(run))) + b"".join(run[:place] + run[place + 1:])
            for witness in own:
                witness += others
            below += own
        self.append(hashed(run), None, level + 1, below)

    def root(self) -> bytes:
        """Completes all open runs and gives the digest of the whole."""
        for level in range(self.height):
            if self.runs[level]:
                self._complete(level)
        return self.runs[self.height][0]


def siblings(witness: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(digests before, digests after) of each level, as joined bytes."""
    at = 0
    while at < len(witness):
        place, size = witness[at], witness[at + 1]
        at += 2
        yield witness[at:at + place * DIGEST], witness[at + place * DIGEST:at + (size - 1) * DIGEST]
        at += (size - 1) * DIGEST


def folded(leaf: bytes, witness: bytes) -> bytes:
    """The root that a leaf and its witness lead to."""
    for left, right in siblings(witness):
        leaf = hashlib.sha256((left.hex() + leaf.hex() + right.hex()).encode()).digest()
    return leaf


NODES = "tree string, pos bigint, nodes bigint, digest binary"


def _in_blocks(nodes: DataFrame, depth: int, *first: Column) -> DataFrame:
    """``nodes`` dealt by aligned blocks, a block's rows together and in order. A block is bounded, so no
    tree is hot."""
    return (nodes.withColumn("block", F.floor(F.col("pos") / WIDTH ** depth).cast("bigint")).repartition("tree", "block")
            .sortWithinPartitions("tree", "block", *first, "pos"))


def _round(nodes: DataFrame, depth: int) -> DataFrame:
    """One round up: the roots of the blocks as nodes. A tree of one node stays as it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, frontier = None, None

        def done() -> pa.RecordBatch:
            tree, block, nodes = at
            values = [[tree], [block], [-(-nodes // WIDTH ** depth)], [frontier.root()]]
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], ["tree", "pos", "nodes", "digest"])

        for batch in batches:
            for tree, block, nodes, digest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if at != (tree, block, nodes):
                    if at is not None:
                        yield done()
                    at, frontier = (tree, block, nodes), Frontier(min(depth, levels(nodes)), witnesses=False)
                frontier.append(digest)
        if at is not None:
            yield done()

    return _in_blocks(nodes.select("tree", "pos", "nodes", "digest"), depth).select("tree", "block", "nodes", "digest").mapInArrow(run, NODES)


def climbed(nodes: DataFrame, depth: int = DEPTH) -> list[DataFrame]:
    """Rounds of block roots over ``nodes`` (tree string, pos bigint from 0, nodes bigint of the tree, digest
    binary, ...), from ``nodes`` up to one node a tree. Each is a written table."""
    python_path(nodes.sparkSession)
    rounds = [nodes]
    while True:
        rounds.append(written(_round(rounds[-1], depth), "block-roots"))
        if (rounds[-1].agg(F.max("nodes")).first()[0] or 1) == 1:
            return rounds


HEAD = ["witness", "subroot", "root"]


def descended(rounds: list[DataFrame], heads: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The columns of ``rounds[0]`` and witness, subroot and root (binary) of each of its nodes. ``heads``:
    (tree, pos, witness, subroot, root) for the nodes of ``rounds[-1]``; the head of a block comes first in
    it, its witness extends what the block's nodes have, the other two are theirs too."""
    for nodes in reversed(rounds[:-1]):
        heads = _with_heads(nodes, heads, depth)
        if nodes is not rounds[0]:
            heads = written(heads.select("tree", "pos", *HEAD), "block-witnesses")
    return heads


def _with_heads(nodes: DataFrame, heads: DataFrame, depth: int) -> DataFrame:
    own = nodes.columns
    schema = T.StructType([*nodes.schema.fields, *(T.StructField(c, T.BinaryType()) for c in HEAD)])
    heads = heads.select("tree", (F.col("pos") * WIDTH ** depth).alias("pos"), *HEAD)
    rows = _in_blocks(heads.unionByName(nodes, allowMissingColumns=True), depth, F.col("root").isNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        head, witnesses, frontier = None, [], None

        def done() -> pa.RecordBatch:
            frontier.root()
            block = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ends = [bytes(w) + head[0] for w in witnesses]
            return pa.RecordBatch.from_arrays(
                [*block.columns, *(pa.array(x, pa.binary()) for x in (ends, [head[1]] * len(ends), [head[2]] * len(ends)))],
                [*own, *HEAD])

        for batch in batches:
            given = list(zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in HEAD)))
            digests, sizes = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("digest", "nodes"))
            rows, begin = batch.select(own), 0
            for i, (witness, subroot, root) in enumerate(given):
                if root is not None:  # the head of the next block
                    if begin < i:
                        held.append(rows.slice(begin, i - begin))
                    if witnesses:
                        yield done()
                    held, begin = [], i + 1
                    head, witnesses, frontier = (witness, subroot, root), [], None
                    continue
                frontier = frontier or Frontier(min(depth, levels(sizes[i])), witnesses=True)
                witnesses.append(bytearray())
                frontier.append(digests[i], witnesses[-1])
            if begin < len(given):
                held.append(rows.slice(begin))
        if witnesses:
            yield done()

    return rows.select(*own, *HEAD).mapInArrow(run, schema)


def _placed(rows: DataFrame, order: str) -> DataFrame:
    """``rows`` (tree, digest, ``order``, ...) with pos (from 0, by ``order``, then digest) and nodes."""
    placed = with_position(rows, ["tree"], order, "digest", name="pos", split="range").withColumn("pos", F.col("pos") - 1)
    sizes = written(rows.groupBy(F.col("tree").alias("__tree")).agg(F.count("*").alias("nodes")), "tree-sizes")
    return placed.join(sizes, F.col("tree").eqNullSafe(F.col("__tree"))).drop("__tree")


def manifest(docs: DataFrame, keep: list[str] | None = None, depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id, the columns of ``keep``, tree (its
    lang), pos (its place there, from 0), nodes (leaves of the tree), digest (its leaf), witness, subroot and
    root, the last four binary. A block is ``depth`` levels high."""
    leaves = docs.select("doc_id", *(keep or []), F.col("lang").cast("string").alias("tree"),
                         leaf_digest([F.col(c) for c in FIELDS]).alias("digest"))
    rounds = climbed(written(_placed(written(leaves, "leaves"), "doc_id"), "placed"), depth)
    names = rounds[-1].select(F.lit("").alias("tree"), "digest", F.col("tree").alias("name"))
    top = climbed(written(_placed(names, "name"), "subroots"), depth)
    whole = top[-1].select("tree", "pos", F.lit(b"").alias("witness"), F.col("digest").alias("subroot"), F.col("digest").alias("root"))
    subroots = written(descended(top, whole, depth).select(
        F.col("name").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "witness", F.col("digest").alias("subroot"), "root"),
        "subroot-witnesses")
    return descended(rounds, subroots, depth)


def tampered(docs: DataFrame) -> Column:
    """The leaf of a row whose text has its A-Z lower-cased, where 3 divides the CRC-32 of its doc_id in
    decimal; else null."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    changed = leaf_digest([F.col(c) for c in FIELDS[:-1]] + [lower])
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, changed)


def digest(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256 (of its siblings up to the root), all of
    the rows as they are; folded_root, from the ``tampered`` leaf where there is one; verified (it is the
    root). Digests as lowercase hexadecimal text."""
    docs = docs.select(*FIELDS)
    rows = manifest(docs.withColumn("other", tampered(docs)), ["other"], depth)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for leaf, other, witness, subroot, root in zip(*(batch.column(i).to_pylist() for i in range(1, 6))):
                proof = hashed([left + right for left, right in siblings(witness)])
                fold = folded(other or leaf, witness)
                out.append((leaf.hex(), subroot.hex(), root.hex(), proof.hex(), fold.hex(), fold == root))
            columns = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.string()) for c in columns[:5]), pa.array(columns[5], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.select("doc_id", "digest", "other", "witness", "subroot", "root").mapInArrow(
        run, f"doc_id {dict(docs.dtypes)['doc_id']}, leaf string, subroot string, root string, proof_sha256 string, "
             "folded_root string, verified boolean")
