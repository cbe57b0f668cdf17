"""Centroid clustering with a vantage-point tree over the centroids, rebuilt every round.

The tree holds centroids, not data: it is built on the driver from a fixed number of them and sent
to the tasks. Every vector searches it best first. Subtrees wait with a lower bound of their
distance, the nearest is opened next, and the search ends when the nearest bound lies outside the
best distance so far; a bound that just equals it is still opened, so that of equally near
centroids the smallest number is found. A batch of vectors searches in step, each by its own queue.
Distances that decide are whole numbers; roots only serve as bounds, with slack for rounding.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.integer_vectors import GroupSums, matrix, summed, whole
from orderlens.workspace import stored

SCALE, WIDTH, CENTROIDS, ROUNDS, SEED = 256, 64, 40, 5, 2
LEAF = 4
#: Bounds held for a block of vectors: vectors times nodes.
HELD = 1 << 20


def squared(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Exact squared distances, points by centers."""
    apart = points[:, None, :] - centers[None, :, :]
    return np.einsum("pcd,pcd->pc", apart, apart)


class VantageTree:
    """Nodes are (vantage, None, [(child, least, most)]) or (None, members, []).

    ``least`` and ``most`` bound the distances of a child's centroids from the vantage point.
    """

    def __init__(self, centroids: np.ndarray, leaf: int = LEAF) -> None:
        self.centroids = centroids
        self.nodes: list[tuple[int | None, np.ndarray | None, list[tuple[int, float, float]]]] = []
        self.opened = 0
        if len(centroids):
            self._build(np.arange(len(centroids)), leaf)

    def _build(self, members: np.ndarray, leaf: int) -> int:
        number = len(self.nodes)
        self.nodes.append((None, np.sort(members), []))
        if len(members) <= leaf:
            return number
        points = self.centroids[members]
        # the vantage point sees the others at the most various distances: the farthest from their middle
        vantage = int(np.argmax(squared(points, points.mean(axis=0).astype(np.int64)[None, :])[:, 0]))
        rest = np.delete(members, vantage)
        away = np.sqrt(squared(self.centroids[rest], points[vantage][None, :])[:, 0].astype(np.float64))
        by_distance = np.argsort(away, kind="stable")
        half = len(rest) // 2
        children = []
        for side in (by_distance[:half], by_distance[half:]):
            if not len(side):
                continue
            child = self._build(rest[side], leaf)
            children.append((child, float(away[side].min()), float(away[side].max())))
        self.nodes[number] = (int(members[vantage]), None, children)
        return number

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid of each point; ties go to the smaller number."""
        step = max(1, HELD // max(1, len(self.nodes)))
        found = [self._search(points[a : a + step]) for a in range(0, len(points), step)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _search(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        best = np.full(len(points), np.iinfo(np.int64).max)
        who = np.full(len(points), len(self.centroids))
        bound = np.full((len(points), len(self.nodes)), np.inf)
        bound[:, 0] = 0
        live = np.arange(len(points))
        while len(live):
            node = bound[live].argmin(axis=1)
            within = bound[live, node] <= np.sqrt(best[live].astype(np.float64))
            live, node = live[within], node[within]
            for v in np.unique(node):
                rows = live[node == v]
                self.opened += len(rows)
                came = bound[rows, v]
                bound[rows, v] = np.inf
                vantage, members, children = self.nodes[v]
                tried = members if vantage is None else np.array([vantage])
                away = squared(points[rows], self.centroids[tried])
                first = away.argmin(axis=1)
                least, number = away[np.arange(len(rows)), first], tried[first]
                better = (least < best[rows]) | ((least == best[rows]) & (number < who[rows]))
                best[rows[better]], who[rows[better]] = least[better], number[better]
                if children:
                    root = np.sqrt(away[:, 0].astype(np.float64))
                for child, low, high in children:
                    lower = np.maximum(root - high, low - root) - 1e-12 * (root + high) - 1e-9
                    bound[rows, child] = np.maximum(lower, came)
        return who, best


def _partial_sums(tree: VantageTree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = tree.centroids.shape[1]
        sums = GroupSums(len(tree.centroids), width)
        for batch in batches:
            values = matrix(batch.column("values"), width)
            sums.add(tree.nearest(values)[0], values)
        yield sums.rows()

    return run


def learn(vectors: DataFrame, width: int, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids of stored ``vectors`` (vec_id, values), whole numbers.

    They start as the vectors with the smallest SHA-256 of ``<seed>:<vec_id>`` in order (equal ids by
    their values; rows without id start none) and move to the floored mean of their vectors, or stay.
    Fewer such vectors make fewer centroids.
    """
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = vectors.where("vec_id is not null").orderBy(order, "values").limit(centroids).select("values").collect()
    centers = np.array([r["values"] for r in first], np.int64).reshape(len(first), width)
    sums = ", ".join(f"s{d} long" for d in range(width))
    for _ in range(rounds if len(first) else 0):
        partial = vectors.select("values").mapInArrow(_partial_sums(VantageTree(centers)), f"g long, n long, {sums}")
        centers = centers.copy()
        for number, n, total in summed(partial, ["g"], width):
            centers[number] = [s // n for s in total]
    return centers


def assign(vectors: DataFrame, centers: np.ndarray) -> DataFrame:
    """vec_id, cluster and distance (squared) of every row of ``vectors``."""
    tree, kind = VantageTree(centers), vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, best = tree.nearest(matrix(batch.column("values"), centers.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(best, pa.int64())],
                names=["vec_id", "cluster", "distance"],
            )

    return vectors.select("vec_id", "values").mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def cluster(
    embeddings: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH, scale: int = SCALE
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every usable vector.

    Left out are rows whose vector is null, is not ``width`` long or holds a null or non-finite
    component. Repeated rows and ids are clustered row by row. Components beyond +-2 ** 24 / scale
    count as that bound; inertias stop at the largest long. An empty table, and one whose rows all
    lack an id, gives an empty result. Other columns of the input are ignored.
    """
    spark = embeddings.sparkSession
    vectors = stored(whole(embeddings, scale, width, "vec_id"), "whole-vectors")
    centers = learn(vectors, width, centroids, rounds, seed)
    if not len(centers):
        vectors = vectors.limit(0)
    told = stored(assign(vectors, centers), "clusters")
    # one row per centroid
    by_cluster = told.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    most, total = 2**63 - 1, sum(int(r["d"]) for r in by_cluster)
    about = [
        (r["cluster"], min(int(r["d"]), most), min(total, most), hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest())
        for r in by_cluster
    ]
    facts = spark.createDataFrame(about, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return told.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
