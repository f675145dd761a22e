"""Nearest neighbours by inner product in a hierarchical k-means tree.

The tree is fitted on a bounded sample; every vector is indexed under the leaf it descends to. A
query walks the tree best bin first through a priority queue, and how many leaves it visits is
widened until the recall on sample queries reaches the target. Equal vectors are one entry with its
smallest ids, so a vector that a third of all rows hold costs no more than any other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewell.llm.shipping import shipped
from tidewell.session import materialize

#: Vectors that the tree is fitted on, and queries it is calibrated with.
SAMPLE, TRIALS = 20_000, 300
BRANCHES, LEAF = 8, 160
#: Recall of held-out sample queries that ends the widening.
TARGET = 0.98
#: Vectors and queries in one task.
CHUNK, QUERIES = 4096, 512


@dataclass
class Tree:
    """Nodes in order: the centres of the children and their numbers; a leaf has a leaf number."""

    centres: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def _node(self) -> int:
        self.centres.append(None)
        self.children.append([])
        self.leaf.append(-1)
        return len(self.leaf) - 1

    def grow(self, x: np.ndarray, random: np.random.Generator) -> int:
        node = self._node()
        groups = _clusters(x, random) if len(x) > LEAF else []
        if len(groups) < 2:
            self.leaf[node] = self.leaves
            self.leaves += 1
            return node
        self.centres[node] = np.stack([x[g].mean(0) for g in groups])
        self.children[node] = [self.grow(x[g], random) for g in groups]
        return node

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf that each vector descends to, by the nearest centre at each node."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if self.leaf[node] >= 0:
                out[rows] = self.leaf[node]
                continue
            side = _distances(x[rows], self.centres[node]).argmin(1)
            todo += [(c, rows[side == i]) for i, c in enumerate(self.children[node]) if (side == i).any()]
        return out

    def visit(self, q: np.ndarray, wanted: int, sizes: np.ndarray, least: int) -> list[int]:
        """`wanted` leaves, best bin first; more until they hold `least` entries, as far as there are."""
        queue, found, held = [(0.0, 0)], [], 0
        while queue and (len(found) < wanted or held < least):
            _, node = heapq.heappop(queue)
            if self.leaf[node] >= 0:
                found.append(self.leaf[node])
                held += int(sizes[self.leaf[node]])
                continue
            for score, child in zip((self.centres[node] @ q).tolist(), self.children[node], strict=True):
                heapq.heappush(queue, (-score, child))
        return found


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (centres**2).sum(1) - 2 * x @ centres.T


def _clusters(x: np.ndarray, random: np.random.Generator) -> list[np.ndarray]:
    centres = x[random.choice(len(x), BRANCHES, replace=False)]
    side = np.zeros(len(x), np.int64)
    for _ in range(12):
        side = _distances(x, centres).argmin(1)
        centres = np.stack([x[side == i].mean(0) if (side == i).any() else centres[i] for i in range(BRANCHES)])
    return [g for g in (np.flatnonzero(side == i) for i in range(BRANCHES)) if len(g)]


def fitted(x: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A tree on a sample but some of its rows, and which these are: queries to calibrate with."""
    held = np.arange(0, len(x), max(2, len(x) // TRIALS))
    rest = np.delete(x, held, 0)
    tree = Tree()
    tree.grow(rest if len(rest) else x, np.random.default_rng(3))
    return tree, held


def calibrated(tree: Tree, x: np.ndarray, held: np.ndarray, k: int) -> int:
    """Leaves to visit so that the held-out queries find TARGET of their `k` nearest others in the sample."""
    if len(x) < 2:
        return 1
    at = tree.assign(x)
    sizes = np.bincount(at, minlength=tree.leaves)
    queries = x[held]
    scores = queries @ x.T
    scores[np.arange(len(held)), held] = -np.inf
    best = np.argsort(-scores, 1)[:, : min(k, len(x) - 1)]
    orders = []
    for q in queries:
        place = np.empty(tree.leaves, np.int64)
        place[tree.visit(q, tree.leaves, sizes, 0)] = np.arange(tree.leaves)
        orders.append(place)
    # After how many leaves each true neighbour is met.
    met = np.stack([o[at[b]] for o, b in zip(orders, best, strict=True)])
    visits = 1
    while visits < tree.leaves and (met < visits).mean() < TARGET:
        visits += max(1, visits // 4)
    return min(visits, tree.leaves)


def _matrix(column, dtype=np.float64) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def usable(vector: Column) -> Column:
    """Not null, not empty, not zero, and without null or non-finite components."""
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vector, lambda v: v != 0)


def _searcher(k: int):
    def search(key: tuple, entries: pa.Table, queries: pa.Table) -> pa.Table:
        q, q2, score, ids = [], [], [], []
        if entries.num_rows and queries.num_rows:
            x, listed = _matrix(entries.column("v")), entries.column("ids").to_pylist()
            asked = _matrix(queries.column("v"))
            dots = asked @ x.T
            least = np.array([row[0] for row in listed], np.int64)
            n = min(k, len(x))
            # Rounding of a product is less than this; what may tie with the k-th is ranked by the exact sum.
            room = 4 * (x.shape[1] + 2) * np.finfo(np.float64).eps
            room = room * np.sqrt((asked**2).sum(1)) * np.sqrt((x**2).sum(1).max())
            cut = np.partition(dots, len(x) - n, 1)[:, len(x) - n] - room
            keys = zip(queries.column("q").to_pylist(), queries.column("q2").to_pylist(), strict=True)
            for i, (key_of, check) in enumerate(keys):
                near = np.flatnonzero(~(dots[i] < cut[i]))
                exact = (x[near] * asked[i]).sum(1)  # the same sum wherever the pair meets
                order = np.lexsort((least[near], -exact))[:k].tolist()
                q += [key_of] * len(order)
                q2 += [check] * len(order)
                score += exact[order].tolist()
                ids += [listed[near[j]] for j in order]
        return pa.table(
            [pa.array(q, pa.int64()), pa.array(q2, pa.int64()), pa.array(score, pa.float64()), pa.array(ids, pa.list_(pa.int64()))],
            names=["q", "q2", "score", "ids"],
        )

    return search


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest found of each query row, best first.

    `vectors` has vec_id and embedding; queries are the rows for which `is_query` holds, candidates
    all rows with another id. The score is the inner product in double precision; ties go to the
    smaller id. Vectors that are null, empty or zero, or hold null or non-finite components, take no
    part, nor do those of another length than most have, nor rows without an id. A row given twice
    counts once. With fewer candidates than `k`, all are returned. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = shipped(vectors).filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    rows = rows.select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast("array<double>").alias("v"), is_query.alias("asks")
    )
    width = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    rows = rows.filter(F.size("v") == width["n"]).withColumn("q", F.xxhash64("v"))
    rows = rows.withColumn("q2", F.xxhash64(F.lit(1), "v"))
    # The k + 1 smallest ids of each vector: all that any query can need.
    first = Window.partitionBy("q", "q2").orderBy("id")
    few = rows.select("q", "q2", "id", "v").distinct().withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    entries = few.groupBy("q", "q2").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("v").alias("v"))
    entries = materialize(entries, "entries")
    total = entries.count()
    chance = F.pmod(F.col("q2"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = entries.filter(chance < min(1.0, 1.2 * SAMPLE / total)).orderBy("q", "q2").limit(SAMPLE)
    x = np.array([r["v"] for r in sample.select("v").collect()], np.float64)
    if not len(x):
        x = np.array([entries.first()["v"]])
    tree, held = fitted(x)
    visits = calibrated(tree, x, held, k)

    sent = spark.sparkContext.broadcast(tree)  # SAMPLE vectors at most

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = sent.value.assign(_matrix(batch.column("v")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf, pa.int32())], names=[*batch.schema.names, "leaf"])

    placed = materialize(
        entries.mapInArrow(place, "q bigint, q2 bigint, ids array<bigint>, v array<double>, leaf int"), "placed"
    )
    sizes = np.zeros(tree.leaves, np.int64)
    for r in placed.groupBy("leaf").count().collect():  # one row for each leaf of the tree
        sizes[r["leaf"]] = r["count"]

    asking = materialize(rows.filter("asks").select("id", "q", "q2").distinct(), "asking")
    asked = asking.select("q", "q2").distinct().join(entries.select("q", "q2", "v"), ["q", "q2"])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.visit(v, visits, sizes, k + 1) for v in _matrix(batch.column("v"))]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("q", "q2", "v")), pa.array(found, pa.list_(pa.int32()))],
                names=["q", "q2", "v", "found"],
            )

    walked = asked.mapInArrow(walk, "q bigint, q2 bigint, v array<double>, found array<int>")
    walked = materialize(walked.select("q", "q2", "v", F.explode("found").alias("leaf")), "walked")
    asks = walked.groupBy("leaf").agg(F.count("*").alias("n_asks"))
    holds = placed.groupBy("leaf").agg(F.count("*").alias("n_holds"))
    cuts = materialize(
        asks.join(holds, "leaf").select(
            "leaf",
            F.ceil(F.col("n_asks") / QUERIES).cast("int").alias("a"),
            F.ceil(F.col("n_holds") / CHUNK).cast("int").alias("b"),
        ),
        "cuts",
    )
    # Each chunk of a leaf's entries meets each chunk of its queries in a task of its own.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = placed.join(cuts, "leaf").withColumn("j", F.pmod(F.col("q2"), F.col("b")).cast("int"))
    left = left.withColumn("i", every("a")).select("leaf", "i", "j", "ids", "v")
    right = walked.join(cuts, "leaf").withColumn("i", F.pmod(F.col("q"), F.col("a")).cast("int"))
    right = right.withColumn("j", every("b")).select("leaf", "i", "j", "q", "q2", "v")
    met = (
        left.groupBy("leaf", "i", "j")
        .cogroup(right.groupBy("leaf", "i", "j"))
        .applyInArrow(_searcher(k + 1), "q bigint, q2 bigint, score double, ids array<bigint>")
    )
    best = Window.partitionBy("q", "q2").orderBy(F.desc("score"), "id")
    listed = met.select("q", "q2", "score", F.explode("ids").alias("id"))
    listed = listed.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1)
    listed = listed.groupBy("q", "q2").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score"))).alias("found"))
    listed = materialize(listed, "found")
    answers = asking.join(listed, ["q", "q2"]).select(
        F.col("id").alias("query_id"),
        F.expr(f"posexplode(slice(filter(found, f -> f.id <> id), 1, {k})) AS (at, f)"),
    )
    return answers.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("f.id").alias("vec_id"), F.col("f.score").alias("score")
    )
