"""Approximate nearest neighbours by inner product: a forest of random-projection trees.

The trees are fitted on a bounded sample and index every vector. A query walks all trees at
once: one priority queue holds the branches not taken, nearest splitting plane first, and gives
the leaves in the order in which they are worth a look. Every leaf is a task of its own (a
large one several), where its candidates are scored exactly; the best per query and leaf are
merged. How many leaves a query visits is read off the sample, where the true neighbours are
known.
"""

from __future__ import annotations

import heapq
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cohortwise.llm.common import kept, tasks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TREES = 8
#: Vectors the forest is fitted on, and sampled vectors in a leaf.
SAMPLE, LEAF = 20_000, 128
#: Sampled queries and the recall among the sample that sets the number of leaves to visit.
PROBES, RECALL = 200, 0.97
#: Vectors of a leaf that one task scores.
BLOCK = 4096
SEED = 11
ROWS = "leaf int, salt int, kind int, id long, vector array<float>"
FOUND = "query_id long, vec_id long, score double"


@dataclass
class Forest:
    """Split planes of all trees. A child below zero is a leaf: its number is ``-child - 1``."""

    longest: float
    normals: list[np.ndarray] = field(default_factory=list)
    offsets: list[float] = field(default_factory=list)
    children: list[tuple[int, int]] = field(default_factory=list)
    roots: list[int] = field(default_factory=list)
    leaves: int = 0
    tree_of: list[int] = field(default_factory=list)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Candidates on a sphere, so that the largest inner product is the smallest angle."""
        left = np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0)
        return np.hstack([x, np.sqrt(left)[:, None]]) / self.longest

    def asked(self, q: np.ndarray) -> np.ndarray:
        return np.hstack([q / np.linalg.norm(q, axis=1, keepdims=True), np.zeros((len(q), 1))])

    def grow(self, points: np.ndarray, rng: np.random.Generator) -> int:
        """Add the subtree over some points and return its number.

        A plane lies between two points drawn at random, at the median of the projections.
        """
        for _ in range(3 if len(points) > LEAF else 0):
            a, b = points[rng.choice(len(points), 2, replace=False)]
            length = np.linalg.norm(a - b)
            if not length:
                continue
            normal = (a - b) / length
            along = points @ normal
            middle = float(np.median(along))
            right = along > middle
            if right.any():
                number = len(self.children)
                self.normals.append(normal)
                self.offsets.append(middle)
                self.children.append((0, 0))
                self.children[number] = (
                    self.grow(points[~right], rng), self.grow(points[right], rng)
                )
                return number
        self.leaves += 1
        self.tree_of.append(len(self.roots))
        return -self.leaves

    def fit(self, x: np.ndarray) -> Forest:
        points, rng = self.lifted(x), np.random.default_rng(SEED)
        for _ in range(TREES):
            self.roots.append(self.grow(points, rng))
        self.planes = np.array(self.normals).reshape(-1, points.shape[1])
        self.at = np.array(self.offsets)
        return self

    def margins(self, points: np.ndarray) -> np.ndarray:
        return points @ self.planes.T - self.at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree, a thousand vectors at a time."""
        out = np.zeros((len(x), len(self.roots)), dtype=np.int64)
        table = np.array(self.children).reshape(-1, 2)
        for at in range(0, len(x), 1000):
            right = self.margins(self.lifted(x[at:at + 1000])) > 0
            for t, root in enumerate(self.roots):
                node = np.full(len(right), root)
                while (inside := np.flatnonzero(node >= 0)).size:
                    here = node[inside]
                    node[inside] = table[here, right[inside, here].astype(int)]
                out[at:at + 1000, t] = -node - 1
        return out

    def leaves_of(self, margin: list[float]) -> Iterator[int]:
        """Leaves of all trees for a query, by the farthest plane between it and them."""
        queue = [(0.0, root) for root in self.roots]
        while queue:
            far, node = heapq.heappop(queue)
            while node >= 0:
                m = margin[node]
                near, other = self.children[node][::-1] if m > 0 else self.children[node]
                heapq.heappush(queue, (max(far, abs(m)), other))
                node = near
            yield -node - 1


def dense(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


def visits_needed(forest: Forest, x: np.ndarray, k: int) -> int:
    """Leaves to visit for the wanted recall of the sample's own nearest neighbours."""
    probes = x[:PROBES]
    wanted = np.zeros((len(probes), min(k, len(x) - 1)), dtype=np.int64)
    for i, probe in enumerate(probes):
        scores = x @ probe
        scores[i] = -np.inf
        wanted[i] = np.argsort(-scores, kind="stable")[:wanted.shape[1]]
    leaf = forest.assign(x)
    seen = np.zeros(forest.leaves + 1)
    margins = forest.margins(forest.asked(probes))
    for mine, margin in zip(wanted, margins):
        order = np.zeros(forest.leaves, dtype=np.int64)
        for turn, number in enumerate(forest.leaves_of(margin.tolist())):
            order[number] = turn
        np.add.at(seen, order[leaf[mine]].min(axis=1) + 1, 1)
    reached = np.cumsum(seen) / max(1, wanted.size)
    return int(np.argmax(reached >= RECALL)) if wanted.size else forest.leaves


def usable(vector: Column) -> Column:
    """Neither null nor zero, with finite components only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def best(scores: np.ndarray, k: int) -> np.ndarray:
    """Mask of the k largest scores of each row and of all that equal the last of them nearly."""
    if scores.shape[1] <= k:
        return np.isfinite(scores)
    last = np.partition(scores, -k, axis=1)[:, -k]
    return (scores >= (last - 1e-9 * (1 + np.abs(last)))[:, None]) & np.isfinite(scores)


def score_leaf(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int,
) -> pa.RecordBatch:
    """The k nearest of a leaf for each query; each score is one sum of products."""
    rough = q @ x.T
    rough[query_ids[:, None] == ids[None, :]] = -np.inf
    row, column = np.nonzero(best(rough, k))
    score = (q[row] * x[column]).sum(axis=1)
    order = np.lexsort((ids[column], -score, row))
    row, column, score = row[order], column[order], score[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids[row][keep]), pa.array(ids[column][keep]), pa.array(score[keep])],
        ["query_id", "vec_id", "score"],
    )


def score_leaves(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by leaf, salt and kind: first a block of vectors, then its queries."""
    place: tuple[int, int] | None = None
    ids: list[np.ndarray] = []
    vectors: list[np.ndarray] = []
    for batch in batches:
        leaf, salt, kind, number = (np.asarray(batch.column(i)) for i in range(4))
        values = dense(batch.column(4)) if batch.num_rows else None
        edges = np.flatnonzero((np.diff(leaf) != 0) | (np.diff(salt) != 0) | (np.diff(kind) != 0))
        cuts = [0, *(edges + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a == b:
                continue
            if place != (int(leaf[a]), int(salt[a])):
                place, ids, vectors = (int(leaf[a]), int(salt[a])), [], []
            if kind[a] == 0:
                ids.append(number[a:b])
                vectors.append(values[a:b])
            elif ids:
                ids, vectors = [np.concatenate(ids)], [np.concatenate(vectors)]
                for at in range(a, b, 512):
                    to = min(b, at + 512)
                    yield score_leaf(ids[0], vectors[0], number[at:to], values[at:to], k)


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every query row.

    Nearness is the inner product in double precision; ties go to the smaller id. Vectors that
    are null, zero, or hold null or non-finite components take no part, nor do rows without an
    id or with another dimension than most. Rows that repeat an id count once and are no
    candidates of their own query. With k or fewer candidates all are returned. No usable
    query or candidate, no rows. ``is_query`` is a condition on the id column.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    size = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if size is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = kept(rows.where(F.size("vector") == size.d).dropDuplicates(["id"]))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x)
    longest = float(np.sqrt(rows.agg(F.max(norm)).first()[0])) * (1 + 1e-9)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow()
    x = dense(sample["vector"].combine_chunks())
    forest = Forest(longest).fit(x)
    visits = visits_needed(forest, x, k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = forest.assign(dense(batch.column(1))) if batch.num_rows else np.zeros((0, 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(leaf.tolist(), pa.list_(pa.int32()))],
                ["id", "vector", "leaves"],
            )

    placed = rows.select("id", "vector").mapInArrow(
        place, "id long, vector array<float>, leaves array<int>"
    ).select("id", "vector", F.explode("leaves").alias("leaf"))
    # One number a leaf: the forest has as many leaves as the bounded sample allows.
    counts = {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}
    salts = [max(1, -(-counts.get(n, 0) // BLOCK)) for n in range(forest.leaves)]
    salt_of = F.element_at(F.lit(salts), F.col("leaf") + 1)
    index = placed.select(
        "leaf", F.pmod(F.xxhash64("id"), salt_of).cast("int").alias("salt"),
        F.lit(0).alias("kind"), "id", "vector",
    )

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for vector in dense(batch.column(1)) if batch.num_rows else []:
                margin = forest.margins(forest.asked(vector[None, :]))[0]
                mine: list[int] = []
                held = [0] * TREES
                for number in forest.leaves_of(margin.tolist()):
                    mine.append(number)
                    held[forest.tree_of[number]] += counts.get(number, 0)
                    if len(mine) >= visits and max(held) > k:
                        break
                found.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                ["id", "vector", "leaves"],
            )

    asked = rows.where("asks").select("id", "vector").mapInArrow(
        route, "id long, vector array<float>, leaves array<int>"
    ).select("id", "vector", F.explode("leaves").alias("leaf")).select(
        "leaf", F.explode(F.sequence(F.lit(0), (salt_of - 1).cast("int"))).alias("salt"),
        F.lit(1).alias("kind"), "id", "vector",
    )
    near = index.union(asked).repartition(tasks(spark), "leaf", "salt").sortWithinPartitions(
        "leaf", "salt", "kind"
    ).mapInArrow(lambda batches: score_leaves(batches, k), FOUND).distinct()
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
