"""Merkle manifest of a dataset, written as a postorder append log.

Rows are the leaves of one tree per group; on each level every eight consecutive nodes become
their hash, and the groups' roots are the leaves of a tree of their own.  Builders take aligned
blocks of leaves and append a block's nodes in the order in which they are completed.  Where a
node stands in that order follows from the sizes of subtrees alone, so the siblings of a proof
are read from the log by place, without pointers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import stored

#: Nodes that one hash covers.
ARITY = 8
#: Levels that a builder adds: a block has up to ``ARITY ** LEVELS`` leaves.
LEVELS = 3
#: Columns that a leaf covers, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_SIZE = 32


def node_hash(digests: bytes) -> bytes:
    """SHA-256 over digests as lowercase hex text."""
    return hashlib.sha256(digests.hex().encode()).digest()


def leaf_column(fields: Sequence[Column]) -> Column:
    """The digest (binary) of the fields: each ``-`` if null, else byte count, ``:`` and value."""
    parts = []
    for field in fields:
        value = field.cast("string")
        told = F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)
        parts.append(F.coalesce(told, F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


# --- places -------------------------------------------------------------------------


def positions(level: int, index: np.ndarray, leaves: int) -> np.ndarray:
    """Places, from 0, of nodes of one level in the postorder of a tree over ``leaves`` leaves.

    When a node is completed, so are, up to its own level, all nodes over leaves up to its last
    one, and above it those that end before its first leaf.
    """
    index = np.asarray(index, dtype=np.int64)
    first, end = index * ARITY**level, np.minimum((index + 1) * ARITY**level, leaves)
    done = sum(-(-end // ARITY**k) for k in range(level + 1)) - 1
    k = level + 1
    while ARITY**k <= leaves:
        done = done + first // ARITY**k
        k += 1
    return done


def height(leaves: int) -> int:
    """Levels above the leaves until one node remains."""
    levels = 0
    while leaves > 1:
        leaves = -(-leaves // ARITY)
        levels += 1
    return levels


def postorder_log(leaves: Sequence[bytes], levels: int) -> bytes:
    """Digests of the nodes over ``leaves``, ``levels`` levels high, in order of completion."""
    out: list[bytes] = []
    pending: list[list[bytes]] = [[] for _ in range(levels)]

    def append(level: int, digest: bytes) -> None:
        out.append(digest)
        if level < levels:
            pending[level].append(digest)
            if len(pending[level]) == ARITY:
                close(level)

    def close(level: int) -> None:
        digest = node_hash(b"".join(pending[level]))
        pending[level].clear()
        append(level + 1, digest)

    for leaf in leaves:
        append(0, leaf)
    for level in range(levels):  # the last run of a level may be shorter
        if pending[level]:
            close(level)
    return b"".join(out)


class Segment:
    """A block's part of the log."""

    def __init__(self, nodes: bytes, leaves: int, levels: int):
        self.nodes, self.levels = np.frombuffer(nodes, np.uint8).reshape(-1, _SIZE), levels
        self.places = [positions(k, np.arange(-(-leaves // ARITY**k)), leaves) for k in range(levels + 1)]
        self.runs: dict[tuple[int, int], list[bytes]] = {}

    def run(self, level: int, run: int) -> list[bytes]:
        found = self.runs.get((level, run))
        if found is None:
            at = self.places[level][run * ARITY : (run + 1) * ARITY]
            found = self.runs[level, run] = [x.tobytes() for x in self.nodes[at]]
        return found

    def proof(self, leaf: int) -> bytes:
        """Per level: the place of the node over ``leaf`` in its run, how many others the run has, and these."""
        steps = []
        for level in range(self.levels):
            leaf, place = divmod(leaf, ARITY)
            nodes = self.run(level, leaf)
            steps += [bytes([place, len(nodes) - 1]), *nodes[:place], *nodes[place + 1 :]]
        return b"".join(steps)


def siblings(proof: bytes) -> list[tuple[int, bytes]]:
    """The steps of a proof: place in the run, and the others of the run."""
    steps, at = [], 0
    while at < len(proof):
        end = at + 2 + proof[at + 1] * _SIZE
        steps.append((proof[at], proof[at + 2 : end]))
        at = end
    return steps


def fold(leaf: bytes, steps: Sequence[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and the steps of its proof lead to."""
    for place, others in steps:
        at = place * _SIZE
        leaf = node_hash(others[:at] + leaf + others[at:])
    return leaf


# --- numbering ------------------------------------------------------------------------


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Write the rows with ``place``, from 0 in each ``tree`` (a string, not null), in ``order``.

    They are range partitioned by tree and order, so a tree of any size spreads over tasks.  A
    partition counts each of its trees from 0; the driver gets one row per partition, by which
    the partition's first tree goes on where those before left it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tree, run, at = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            n = batch.num_rows
            names = batch.column(0).to_pylist()
            edge = [i for i in range(n) if i == 0 or names[i] != names[i - 1]] + [n]
            runs, places = np.empty(n, np.int64), np.empty(n, np.int64)
            for s, e in zip(edge[:-1], edge[1:]):
                if names[s] != tree:
                    tree, run, at = names[s], run + 1, 0
                runs[s:e], places[s:e] = run, np.arange(at, at + e - s)
                at += e - s
            more = [pa.array(np.full(n, part, np.int64)), pa.array(runs), pa.array(places)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], [*batch.schema.names, "_part", "_run", "_at"])

    rows = rows.select("tree", *[c for c in rows.columns if c != "tree"])
    schema = T.StructType([*rows.schema, *(T.StructField(c, T.LongType()) for c in ("_part", "_run", "_at"))])
    keys = ["tree", *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    counted = stored(ordered.mapInArrow(count, schema), "manifest-leaves")
    ends = counted.groupBy("_part").agg(
        F.min_by("tree", "_run").alias("head"), F.max_by("tree", "_run").alias("tail"), F.max("_run").alias("last"),
        (F.max_by("_at", F.struct("_run", "_at")) + 1).alias("n_tail"))
    before, tree, n = [], None, 0
    for row in ends.orderBy("_part").collect():
        first = n if row["head"] == tree else 0
        before.append((row["_part"], first))
        n = row["n_tail"] + (0 if row["last"] else first)
        tree = row["tail"]
    known = F.broadcast(rows.sparkSession.createDataFrame(before, "_part long, _before long"))
    place = F.col("_at") + F.when(F.col("_run") == 0, F.col("_before")).otherwise(0)
    return counted.join(known, "_part").withColumn("place", place).select(*rows.columns, "place")


# --- building and proving ---------------------------------------------------------------

_ARROW = pa.schema([
    ("tree", pa.string()), ("tier", pa.int32()), ("block", pa.int64()), ("leaves", pa.int64()), ("first", pa.int64()),
    ("items", pa.int32()), ("levels", pa.int32()), ("done", pa.bool_()), ("nodes", pa.binary())])
LOG = ("tree string, tier int, block long, leaves long, first long, items int, levels int, done boolean, "
       "nodes binary")


def in_blocks(rows: DataFrame) -> DataFrame:
    return rows.withColumn("block", F.expr(f"place div {ARITY**LEVELS}"))


def append_blocks(rows: DataFrame, tier: int) -> DataFrame:
    """The log of aligned blocks of ``tree, place, digest, leaves``, one row per block.

    The rows are nodes ``tier * LEVELS`` levels above the leaves of their trees, each over
    ``leaves`` of them.  ``nodes`` holds the block's digests in postorder; ``first`` is the place
    of the first node that the block adds, in the postorder of the whole tree.  A tree that ends
    in its first block is ``done``; every other block is built as high as a full one.
    """
    size = ARITY**LEVELS

    def append(key: tuple, table: pa.Table) -> pa.Table:
        tree, block = (k.as_py() for k in key)
        table = table.sort_by("place")
        n, leaves = table.num_rows, sum(table["leaves"].to_pylist())
        done = block == 0 and n < size
        levels = height(n) if done else LEVELS
        level, end = tier * LEVELS + (tier > 0), block * size * ARITY ** (tier * LEVELS) + leaves
        first = positions(level, block * size // (ARITY if tier else 1), end).item() if levels or not tier else None
        row = (tree, tier, block, leaves, first, n, levels, done, postorder_log(table["digest"].to_pylist(), levels))
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

    rows = in_blocks(rows).select("tree", "block", "place", "digest", "leaves")
    return rows.groupBy("tree", "block").applyInArrow(append, LOG)


def root_of(nodes: str = "nodes") -> Column:
    """The last digest of a block's log."""
    return F.substring(nodes, -_SIZE, _SIZE)


@dataclass(frozen=True)
class Forest:
    """The log of several trees, tier by tier."""

    tiers: list[DataFrame]

    def roots(self) -> DataFrame:
        """``tree, digest`` of every tree."""
        ended = [t.where("done").select("tree", root_of().alias("digest")) for t in self.tiers]
        out = ended[0]
        for more in ended[1:]:
            out = out.unionAll(more)
        return out

    def proofs(self, above: DataFrame) -> DataFrame:
        """``tree, block, subroot, above``: the proofs of the lowest tier's blocks, up from their roots.

        ``above`` has ``tree, subroot, above``: the proof of each tree's root, up to the root of all.
        """
        lower = None
        for tier in reversed(self.tiers):
            known = tier.where("done").select("tree", "block").join(above, "tree").select("tree", "block", "subroot", "above")
            if lower is not None:
                known = known.unionAll(lower)
            if tier is self.tiers[0]:
                return known
            lower = stored(self._below(tier, known), "manifest-proofs")
        raise ValueError("a forest has at least one tier")

    @staticmethod
    def _below(tier: DataFrame, above: DataFrame) -> DataFrame:
        """The proofs of a tier's blocks, from those of the blocks of the tier over it."""

        def extend(table: pa.Table) -> pa.Table:
            row = {c: table[c][0].as_py() for c in table.column_names}
            segment = Segment(row["nodes"], row["items"], row["levels"])
            first = row["block"] * ARITY**LEVELS
            rows = [(row["tree"], first + i, row["subroot"], segment.proof(i) + row["above"]) for i in range(row["items"])]
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
            return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["tree", "block", "subroot", "above"])

        joined = tier.select("tree", "block", "items", "levels", "nodes").join(above, ["tree", "block"])
        return joined.groupBy("tree", "block").applyInArrow(extend, "tree string, block long, subroot binary, above binary")


def build_forest(rows: DataFrame) -> Forest:
    """The log over ``tree, place, digest``: blocks of leaves, then blocks of their roots, and so on.

    The number of tiers is the logarithm of the largest tree to the base of a block's leaves.
    """
    rows, tiers = rows.select("tree", "place", "digest", F.lit(1).cast("long").alias("leaves")), []
    while True:
        tiers.append(stored(append_blocks(rows, len(tiers)), "manifest-log"))
        rows = tiers[-1].where(~F.col("done")).select(
            "tree", F.col("block").alias("place"), root_of().alias("digest"), "leaves")
        if rows.isEmpty():
            return Forest(tiers)


@dataclass(frozen=True)
class Manifest:
    """A dataset's leaves in their places, the log over them, and the log over the trees' roots.

    ``subroots`` has ``tree, place, digest``; ``root`` is None for a dataset without rows.
    """

    leaves: DataFrame
    forest: Forest
    subroots: DataFrame
    top: Forest
    root: bytes | None

    def log(self) -> DataFrame:
        """All segments, those over the roots of trees under the tree null."""
        parts = [*self.forest.tiers, *(t.withColumn("tree", F.lit(None).cast("string")) for t in self.top.tiers)]
        out = parts[0]
        for more in parts[1:]:
            out = out.unionAll(more)
        return out

    def block_proofs(self) -> DataFrame:
        """``tree, block, subroot, above``: proofs of all blocks of leaves, up to ``root``."""
        none = self.top.roots().select("tree", F.col("digest").alias("subroot"), F.lit(b"").alias("above"))
        blocks = self.top.proofs(none).select("block", "above")
        inner = self._expanded(self.top.tiers[0], blocks)
        above = self.subroots.join(inner, "place").select("tree", F.col("digest").alias("subroot"), "above")
        return self.forest.proofs(above)

    @staticmethod
    def _expanded(tier: DataFrame, blocks: DataFrame) -> DataFrame:
        both = Forest._below(tier, blocks.select(F.lit("").alias("tree"), "block", F.lit(b"").alias("subroot"), "above"))
        return both.select(F.col("block").alias("place"), "above")

    def verify(self, claimed: str = "digest") -> DataFrame:
        """Per leaf: ``proof_sha256``, the ``folded`` root from the digest in ``claimed``, ``subroot``.

        ``claimed`` names a column of ``leaves`` (null: the leaf's own digest).  A block's rows
        meet its segment and its proof in one task; other columns of the leaves are kept.
        """
        keep = [c for c in self.leaves.columns if c not in ("tree", "place")]
        rows = in_blocks(self.leaves).select("tree", "block", "place", F.coalesce(claimed, "digest").alias("_claimed"), *keep)
        logs = self.forest.tiers[0].select("tree", "block", "items", "levels", "nodes").join(
            self.block_proofs(), ["tree", "block"])

        def prove(left: pa.Table, right: pa.Table) -> pa.Table:
            log = {c: right[c][0].as_py() for c in right.column_names}
            segment = Segment(log["nodes"], log["items"], log["levels"])
            over = siblings(log["above"])
            rest = b"".join(own for _, own in over).hex()
            hashes, folded = [], []
            for place, digest in zip(left["place"].to_pylist(), left["_claimed"].to_pylist()):
                steps = siblings(segment.proof(place % ARITY**LEVELS))
                told = b"".join(own for _, own in steps).hex() + rest
                hashes.append(hashlib.sha256(told.encode()).hexdigest())
                folded.append(fold(fold(digest, steps), over))
            out = left.select(keep)
            for name, column in (("proof_sha256", pa.array(hashes, pa.string())), ("folded", pa.array(folded, pa.binary())),
                                 ("subroot", pa.array([log["subroot"]] * len(hashes), pa.binary()))):
                out = out.append_column(name, column)
            return out

        kinds = self.leaves.schema
        schema = T.StructType([*(kinds[c] for c in keep), T.StructField("proof_sha256", T.StringType()),
                               T.StructField("folded", T.BinaryType()), T.StructField("subroot", T.BinaryType())])
        return rows.groupBy("tree", "block").cogroup(logs.groupBy("tree", "block")).applyInArrow(prove, schema)


def build_manifest(rows: DataFrame, tree: str = "lang", order: str = "doc_id", keep: Sequence[str] = ()) -> Manifest:
    """The manifest of rows with a ``digest`` (binary), a tree per value of ``tree``.

    In a tree, leaves ascend by ``order`` (null first), rows with equal ``order`` by digest; trees
    ascend by name (null first, then the bytes of the name).  Equal rows are leaves of their own.
    A tree of one row is its leaf; a dataset without rows has no root.  Columns of ``keep`` stay
    with the leaves; only they, the digest and the two keys are shuffled.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    chosen = rows.select(name.alias("tree"), F.col(order).alias("_order"), "digest", *keep)
    # Written first: range partitioning reads its input twice, and texts should be hashed once.
    leaves = numbered(stored(chosen, "manifest-rows"), ["_order", "digest"])
    forest = build_forest(leaves)
    roots = forest.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    subroots = numbered(roots, ["name"])
    top = build_forest(subroots)
    root = top.roots().first()
    return Manifest(leaves, forest, subroots.select(F.col("name").alias("tree"), "place", "digest"), top,
                    None if root is None else bytes(root["digest"]))


def changed(doc_id: str = "doc_id") -> Column:
    """Rows that ``prove_documents`` tampers with: 3 divides the checksum of the id; null ids stay."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def prove_documents(docs: DataFrame, fields: Sequence[str] = FIELDS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of every row of ``docs``.

    The manifest covers ``fields`` of all rows, with a tree per ``lang``.  Rows marked by
    ``changed`` then claim a leaf with ``text`` lower-cased (A-Z only; null texts stay), all others
    their own, and ``folded_root`` is what that leaf and the original siblings lead to.  Texts are
    hashed where they are read and never shuffled, however long; null and empty values differ.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    own = leaf_column([F.col(c) for c in fields])
    other = leaf_column([F.translate(c, upper, lower) if c == "text" else F.col(c) for c in fields])
    rows = docs.select("doc_id", "lang", own.alias("digest"), F.when(changed(), other).alias("claimed"))
    made = build_manifest(rows.withColumn("id", F.col("doc_id")), keep=["id", "claimed"])
    root = "" if made.root is None else made.root.hex()
    hexed = lambda c: F.lower(F.hex(c))
    return made.verify("claimed").select(
        F.col("id").alias("doc_id"), hexed("digest").alias("leaf"), hexed("subroot").alias("subroot"),
        F.lit(root).alias("root"), "proof_sha256", hexed("folded").alias("folded_root"),
        (hexed("folded") == root).alias("verified"))
