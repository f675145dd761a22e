"""Merkle manifest of a table: a digest for every row, a tree over each group, a proof for every leaf.

Nodes are labelled (group, level, number) and handled in the order of labels, time-forward: a node's
digest is sent, as a message addressed to its parent's label, to a priority queue, and the parent is
computed when its messages come up. Then the nodes are swept in reverse, each delivering to its
children what a proof needs from there up to the root.

The queue is external. A block of FAN ** LEVELS consecutive nodes is a whole subtree; messages to a
block go through Spark's sorted, spilling shuffle, and the block's own from a heap of that bounded
size. The blocks' roots are the nodes of the next round, so a group of any size, also one with a third
of all rows, is spread over tasks, and there are two rounds for 16 million rows, four for 10^14.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidewell.llm.shipping import shipped
from tidewell.session import materialize

#: Nodes of a run, and levels that one task sweeps.
FAN, LEVELS = 8, 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEPS = "array<struct<before: string, after: string>>"
_STEPS_TYPE = ArrayType(StructType().add("before", "string").add("after", "string"))
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


# -- leaves and proofs, as expressions ---------------------------------------------


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of some values: each as its count of UTF-8 bytes, a colon and itself; null is a dash."""
    texts = [v.cast("string") for v in values]
    parts = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(p, F.lit("-")) for p in parts]), 256)


def siblings(proof: Column) -> Column:
    """All digests of a proof, from the leaf's level to the root's, left to right."""
    return F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give; equal to the true one only for the true leaf."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


# -- numbers of leaves ----------------------------------------------------------------


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """`rows` (g, ...) with `rank`, from 0 in the given order in each g, and `size`, the rows of g.

    Rows are sorted by range; only the count of each range and group is added up in one place.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, "g", *order).sortWithinPartitions("g", *order)
    placed = materialize(placed.withColumn("_at", F.monotonically_increasing_id()), "in-order")
    part = F.shiftright("_at", 33)  # where that function keeps the partition
    runs = placed.groupBy("g", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    by_group = Window.partitionBy("g")
    earlier = by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "g",
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(by_group).alias("size"),
    )
    numbered = placed.withColumn("_part", part).join(runs, ["g", "_part"])
    return numbered.withColumn("rank", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


# -- one block -----------------------------------------------------------------------


def _hash(digests: Sequence[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _height(size: int, most: int) -> int:
    """Levels of a block's subtree, `most` at most, in a group of `size` nodes."""
    levels = 0
    while size > 1 and levels < most:
        size, levels = -(-size // FAN), levels + 1
    return levels


def _forward(nodes: Sequence[tuple[int, str]], height: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The root of a block, from (rank, digest) of its nodes, and the digests under each inner node."""
    if not height:
        return nodes[0][1], {}
    # Messages (level and number of the addressee, number of the sender, digest).
    queue = [(1, rank // FAN, rank, digest) for rank, digest in nodes]
    heapq.heapify(queue)
    runs: dict[tuple[int, int], list[str]] = {}
    while True:
        level, number = queue[0][:2]
        run = []
        while queue and queue[0][:2] == (level, number):
            run.append(heapq.heappop(queue)[3])
        runs[level, number] = run
        digest = _hash(run)
        if level == height:
            return digest, runs
        heapq.heappush(queue, (level + 1, number // FAN, number, digest))


def _backward(runs: dict[tuple[int, int], list[str]], height: int, top: list[dict]) -> dict[int, list[dict]]:
    """Proof of each node of a block, given that of its root."""
    delivered: dict[tuple[int, int], list[dict]] = {}
    for level, number in sorted(runs, reverse=True):
        rest = top if level == height else delivered.pop((level, number))
        run = runs[level, number]
        for place in range(len(run)):
            step = {"before": "".join(run[:place]), "after": "".join(run[place + 1 :])}
            delivered[level - 1, number * FAN + place] = [step, *rest]
    return {rank: proof for (_, rank), proof in delivered.items()}


def _block(levels: int) -> Column:
    return F.expr(f"rank div {FAN**levels}").alias("block")


def _read(nodes: pa.Table, levels: int) -> tuple[list[tuple[int, str]], int, int]:
    """A block's nodes, the height of its subtree, and how many blocks the group has."""
    ranks, digests = nodes.column("rank").to_pylist(), nodes.column("digest").to_pylist()
    size = nodes.column("size")[0].as_py()
    return list(zip(ranks, digests, strict=True)), _height(size, levels), -(-size // FAN**levels)


def _riser(levels: int):
    def rise(key: tuple, nodes: pa.Table) -> pa.Table:
        """A block to its root, a node of the next round."""
        found, height, blocks = _read(nodes, levels)
        columns = [key[0].as_py(), key[1].as_py(), blocks, _forward(found, height)[0]]
        return pa.table([[c] for c in columns], names=["g", "rank", "size", "digest"])

    return rise


def _sinker(levels: int, nodes_only: bool):
    def sink(nodes: pa.Table, above: pa.Table) -> pa.Table:
        """Proofs to a block's nodes, from that of its root."""
        found, height, _ = _read(nodes, levels)
        top = above.column("proof")[0].as_py()
        runs = _forward(found, height)[1]
        proofs = _backward(runs, height, top) if height else {found[0][0]: top}
        lists = pa.array([proofs[rank] for rank, _ in found], pa.list_(_STEP))
        tags = {n: pa.array([above.column(n)[0].as_py()] * len(found), pa.string()) for n in ("subroot", "root")}
        own = {n: nodes.column(n) for n in (("g", "rank") if nodes_only else ("carried", "digest"))}
        return pa.table({**own, "proof": lists, **tags})

    return sink


# -- trees -----------------------------------------------------------------------------


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """(g, rank, size, digest) of the nodes that each round starts from; in the last each g has one."""
    rounds = [nodes]
    while True:
        at = rounds[-1].select("g", "rank", "size", "digest")
        blocks = at.groupBy("g", _block(levels))
        higher = blocks.applyInArrow(_riser(levels), "g string, rank bigint, size bigint, digest string")
        rounds.append(materialize(higher, "blocks"))
        if (rounds[-1].agg(F.max("size")).first()[0] or 1) == 1:
            return rounds


def _proofs(rounds: list[DataFrame], top: DataFrame, levels: int) -> DataFrame:
    """(carried, digest, proof, subroot, root) of the first round's nodes.

    `top` holds (g, rank, proof, subroot, root) of each group's root.
    """
    above = top
    for depth in range(len(rounds) - 2, -1, -1):
        nodes = rounds[depth]
        own = nodes.select(*(("g", "rank") if depth else ("carried", "digest"))).schema
        for name, kind in (("proof", _STEPS_TYPE), ("subroot", "string"), ("root", "string")):
            own = own.add(name, kind)
        below = nodes.groupBy("g", _block(levels)).cogroup(above.groupBy("g", "rank"))
        above = below.applyInArrow(_sinker(levels, depth > 0), own)
    return above


def manifest(
    rows: DataFrame, group: str, order: Sequence[str], digest: str = "leaf", levels: int = LEVELS
) -> DataFrame:
    """`rows` as the column `carried`, with leaf, subroot, root and proof.

    `digest` names the column of leaf digests, `group` that of the groups, each a tree of its own: in
    the order of `order` (nulls first), every FAN consecutive nodes become the digest of theirs, until
    one, the subroot, is left. The subroots, by group (null first, else by bytes), give the root in the
    same way. `proof` has a step for each level: the digests of the run before and after the node.

    A null group is a group; a group of one row has its leaf as subroot, and a table of one group has
    that subroot as root. Rows equal in `order` are told apart by their leaves, so equal rows have the
    same leaf and neighbouring proofs. A task sweeps `levels` levels. Neither texts nor groups are held whole anywhere. An empty table
    gives an empty manifest. All columns are handed on inside `carried`, so that no name clashes.
    """
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit(""))
    names = [f"_order{i}" for i in range(len(order))]
    leaves = shipped(rows).select(
        F.struct("*").alias("carried"),
        key.alias("g"),
        *[F.col(c).alias(n) for c, n in zip(order, names, strict=True)],
        F.col(digest).alias("digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    # Stored before it is sorted, which takes a sample of its rows first.
    leaves = materialize(leaves, "leaves")
    rounds = _rounds(_numbered(leaves, [*names, "digest", "_row"]).drop(*names, "_row"), levels)

    subroots = rounds[-1].select(F.struct("g").alias("carried"), F.lit("").alias("g"), F.col("g").alias("_order"), "digest")
    upper = _rounds(_numbered(subroots, ["_order"]).drop("_order"), levels)
    empty = F.expr(f"CAST(array() AS {_STEPS})")
    top = upper[-1].select("g", "rank", empty.alias("proof"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    tops = _proofs(upper, top, levels).select(
        "carried.g", F.lit(0).cast("bigint").alias("rank"), "proof", F.col("digest").alias("subroot"), "root"
    )
    return _proofs(rounds, tops, levels).withColumnRenamed("digest", "leaf")
