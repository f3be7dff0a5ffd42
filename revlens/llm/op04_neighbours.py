"""Approximate nearest neighbours: hierarchical k-means tree, best-bin-first search.

The number of leaves follows from the number of vectors (one for every `PER_LEAF`, `LEAVES` at least), so that
a visited leaf holds about as many vectors in a table of any size. The tree is fitted on a bounded
sample (the vectors with the smallest id hash: 16 for each leaf, from `FEWEST` to `SAMPLE`, which
bounds the leaves to `SAMPLE` / 16; beyond 82 million vectors leaves grow instead); every
vector is then indexed by walking down to its leaf. A query walks the tree through a priority
queue of nodes by distance to their centres and visits the nearest leaves first. How many
leaves are visited is calibrated: for a bounded set of `CALIBRATION` queries the true
neighbours are found by brute force over all vectors, and visits are widened until their
recall reaches `RECALL`. A leaf is split into blocks of about `BLOCK` vectors and of about
`BLOCK` queries, so a leaf that holds a third of all vectors is many groups; every block of a
visited leaf is searched whole, by exact distances.

Defined results: for each query (vec_id divisible by `every`) its `k` nearest found, by distance
in double precision, ties to the smaller vec_id; fewer if there are fewer. Vectors that are
null, zero, or hold null or non-finite components take no part, nor do null ids or vectors of
another length than the most frequent one. Rows that repeat an id and vector count once, and a
query's own id is never its neighbour. An empty table gives none; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revlens.llm.shared import cut, smallest

K = 10
EVERY = 100
SAMPLE = 320_000
FEWEST = 20_000
LEAVES = 256
PER_LEAF = 4096
BRANCH = 8
CALIBRATION = 200
RECALL = 0.97
BLOCK = 4096


class Tree:
    """Nodes with their centres; node 0 is the root, leaves are numbered from 0."""

    def __init__(self, sample: np.ndarray, leaves: int, branch: int, seed: int = 7) -> None:
        self.children: list[list[int]] = [[]]
        self.centre: list[np.ndarray] = [sample.mean(0)]
        self.leaf: list[int] = [-1]
        random, members, open_nodes = np.random.default_rng(seed), {0: sample}, [(-len(sample), 0)]
        count = 1
        while open_nodes and count < leaves:
            size, node = heapq.heappop(open_nodes)
            points = members.pop(node)
            centres, owner = kmeans(points, min(branch, leaves - count + 1), random)
            if len(centres) < 2:
                members[node] = points
                continue
            for c, centre in enumerate(centres):
                self.children[node].append(len(self.children))
                members[len(self.children)] = points[owner == c]
                heapq.heappush(open_nodes, (-int((owner == c).sum()), len(self.children)))
                self.children.append([])
                self.centre.append(centre)
                self.leaf.append(-1)
            count += len(centres) - 1
        number = 0
        for node, below in enumerate(self.children):
            if not below:
                self.leaf[node] = number
                number += 1
        self.leaves = number
        self.centres = np.array(self.centre)

    def assign(self, points: np.ndarray) -> np.ndarray:
        """The leaf of every point, nearest child by nearest child."""
        out, queue = np.zeros(len(points), np.int32), [(0, np.arange(len(points)))]
        while queue:
            node, rows = queue.pop()
            below = self.children[node]
            if not below:
                out[rows] = self.leaf[node]
                continue
            nearest = squared(points[rows], self.centres[below]).argmin(1)
            queue += [(child, rows[nearest == c]) for c, child in enumerate(below) if (nearest == c).any()]
        return out

    def visit(self, query: np.ndarray, leaves: int) -> list[int]:
        """The first leaves met by best-bin-first search."""
        queue, out = [(0.0, 0)], []
        while queue and len(out) < leaves:
            _, node = heapq.heappop(queue)
            if not self.children[node]:
                out.append(self.leaf[node])
                continue
            below = self.children[node]
            for distance, child in zip(((self.centres[below] - query) ** 2).sum(1), below, strict=True):
                heapq.heappush(queue, (float(distance), child))
        return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T


def kmeans(points: np.ndarray, k: int, random: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Centres that have points, and each point's centre; a single one if all points are equal."""
    centres = points[random.choice(len(points), min(k, len(points)), replace=False)]
    centres = np.unique(centres, axis=0)
    for _ in range(rounds):
        owner = squared(points, centres).argmin(1)
        used, owner = np.unique(owner, return_inverse=True)
        centres = np.stack([points[owner == c].mean(0) for c in range(len(used))])
    return centres, owner


def choose_leaves(vectors: int, sample: int = SAMPLE) -> tuple[int, int]:
    """Leaves for a table of so many vectors, and the size of the sample they are fitted on."""
    leaves = max(1, min(max(LEAVES, vectors // PER_LEAF), sample // 16))
    return leaves, min(sample, max(FEWEST, 16 * leaves))


def usable(vectors: DataFrame) -> DataFrame:
    """id and vec (doubles) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
    rows = rows.where("forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vec, x -> x <> 0)")
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (sizes["n"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    column = pa.concat_arrays([column])
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def stacked(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def nearest(queries: np.ndarray, query_ids: np.ndarray, points: np.ndarray, ids: np.ndarray, k: int) -> pd.DataFrame:
    """The k nearest points of every query by exact distance, ties to the smaller id, its own id left out."""
    out = []
    ids, first = np.unique(np.rec.fromarrays([ids, [p.tobytes() for p in points]]), return_index=True)
    ids, points = ids["f0"], points[first]
    rough = squared(queries, points)
    rough[query_ids[:, None] == ids[None, :]] = np.inf
    slack = 1e-9 * ((queries * queries).sum(1) + (points * points).sum(1).max())
    for q in range(len(queries)):
        bound = np.partition(rough[q], min(k, len(ids)) - 1)[min(k, len(ids)) - 1]
        close = np.flatnonzero((rough[q] <= bound + slack[q]) & np.isfinite(rough[q]))
        exact = np.sqrt(((points[close] - queries[q]) ** 2).sum(1))
        order = np.lexsort((ids[close], exact))[:k]
        out.append(pd.DataFrame({"query_id": query_ids[q], "vec_id": ids[close][order], "score": exact[order]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(points: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """The true neighbours of a bounded set of queries over all points, in blocks of the scan."""
    shipped = points.sparkSession.sparkContext.broadcast((query_ids, queries))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, queries = shipped.value
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK):
                part = batch.slice(low, BLOCK)
                found = nearest(queries, query_ids, matrix(part.column("vec")), part.column("id").to_numpy(), k)
                yield pa.RecordBatch.from_pandas(found.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False)

    found = points.mapInArrow(task, "query_id long, vec_id long, score double").distinct()
    return top(found, k)


def neighbours(vectors: DataFrame, k: int = K, every: int = EVERY, recall: float = RECALL, sample: int = SAMPLE, leaves: int | None = None, branch: int = BRANCH, calibration: int = CALIBRATION, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every query."""
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    points = usable(vectors)
    fitting, size = choose_leaves(points.count(), sample)
    leaves = fitting if leaves is None else leaves
    chosen = smallest(points, F.xxhash64("id"), size).toArrow()
    if not chosen.num_rows:
        return spark.createDataFrame([], result)
    fitted = matrix(chosen.column("vec").combine_chunks())
    # in an order that doesn't depend on how rows came
    fitted = fitted[np.argsort(np.rec.fromarrays([chosen.column("id").to_numpy(), [v.tobytes() for v in fitted]]), kind="stable")]
    tree = Tree(fitted, max(1, min(leaves, len(fitted) // 16)), branch)
    shipped = spark.sparkContext.broadcast(tree)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("vec"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(shipped.value.assign(values), pa.int32()), pa.array([v.tobytes() for v in values], pa.binary())], ["id", "leaf", "point"])

    indexed = cut(points.mapInArrow(index, "id long, leaf int, point binary"))
    asked = points.where(F.col("id") % every == 0).dropDuplicates(["id"])

    tried = smallest(asked, F.xxhash64("id"), calibration).collect()
    if not tried:
        return spark.createDataFrame([], result)
    tried_ids, tried_vectors = np.array([r["id"] for r in tried]), np.array([r["vec"] for r in tried])
    # at most calibration * k rows
    truth = brute_force(points, tried_ids, tried_vectors, k).join(indexed.select(F.col("id").alias("vec_id"), "leaf"), "vec_id")
    order = {int(q): {leaf: n for n, leaf in enumerate(tree.visit(v, tree.leaves))} for q, v in zip(tried_ids, tried_vectors, strict=True)}
    needed = sorted(order[r["query_id"]][r["leaf"]] + 1 for r in truth.select("query_id", "leaf").collect())
    visits = needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)] if needed else tree.leaves

    def visited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = matrix(batch.column("vec"))
            met = [shipped.value.visit(v, visits) for v in values]
            row = np.repeat(np.arange(len(values)), [len(x) for x in met])
            points = pa.array([v.tobytes() for v in values], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), pa.array(np.concatenate([*met, []]).astype(np.int32)), points.take(pa.array(row))], ["id", "leaf", "point"])

    visiting = cut(asked.mapInArrow(visited, "id long, leaf int, point binary"))
    # one row for each leaf, at most `leaves`
    blocks = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("point_blocks"))
    blocks = blocks.join(visiting.groupBy("leaf").agg(F.ceil(F.count("*") / block).cast("int").alias("query_blocks")), "leaf")
    blocks = F.broadcast(blocks)
    spread = lambda own, other: [F.pmod(F.xxhash64("id"), F.col(own)).cast("int"), F.explode(F.sequence(F.lit(0), F.col(other) - 1))]
    mine, copy = spread("point_blocks", "query_blocks")
    left = indexed.join(blocks, "leaf").select("leaf", mine.alias("p"), copy.alias("q"), "id", "point")
    mine, copy = spread("query_blocks", "point_blocks")
    right = visiting.join(blocks, "leaf").select("leaf", copy.alias("p"), mine.alias("q"), "id", "point")

    def search(points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(points) or not len(queries):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        return nearest(stacked(queries["point"]), queries["id"].to_numpy(), stacked(points["point"]), points["id"].to_numpy(), k)

    found = left.groupBy("leaf", "p", "q").cogroup(right.groupBy("leaf", "p", "q")).applyInPandas(search, "query_id long, vec_id long, score double")
    return top(found, k)


def op4_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
