"""Centroid clustering by ball-tree filtering.

Vectors are cut into blocks where they lie, and each block becomes a metric tree: a node is a ball with its centre, its
radius, its number of vectors and their integer sum; the leaves hold the vectors themselves. The trees are built once and
written as a table of one row a block. A round goes down all trees: a centroid that cannot be the nearest of any vector
of a ball, by the triangle inequality, is dropped for all below it; a ball with one centroid left goes to it as a whole, by its
count and sum, and leaves that stay open are compared vector by vector. A task adds up what it has by centroid, so a round
shuffles a row a task, centroid and component at most, and the driver sees k rows.

All sums, distances and means are of integers. Only radii and the distances of centres are rounded, and there slack is
added, so that a ball goes to a centroid only where exact arithmetic would send each of its vectors.

Defined results: rows whose vector is null, of another length or holds a null or non-finite component take no part; repeated
rows count as often as they stand; a null id is hashed as an empty one; of equal hashes (repeated ids) the smaller vector comes
first as a starting centroid; fewer rows than k give as many centroids; an empty table gives no rows. Components beyond
32 768 in size raise an error, since distances would not fit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparquill.llm.common import stage
from sparquill.llm.vectors import integers, matrix, products, sound

K, ROUNDS, LENGTH = 40, 5, 64
BLOCK, LEAF = 8192, 32
FAR = np.iinfo(np.int64).max


@dataclass
class Tree:
    """A block as a tree. Node i holds the points lo[i] to hi[i]; its children are left[i] and the next, -1 at a leaf."""

    points: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    left: np.ndarray
    radius: np.ndarray
    center: np.ndarray
    total: np.ndarray


def grow(points: np.ndarray, leaf: int = LEAF) -> tuple[Tree, np.ndarray]:
    """The tree over integer points and the order in which it holds them. A ball is cut in halves along the line between two
    far points of it; one of equal points, or of at most `leaf`, is a leaf."""
    order, n = np.arange(len(points)), len(points)
    lo, hi, left, radius, center, total = [0], [n], [], [], [], []
    at = 0
    while at < len(lo):
        own = points[order[lo[at] : hi[at]]]
        total.append(own.sum(0))
        center.append(total[-1] // len(own))
        apart = ((own - center[-1]) ** 2).sum(1)
        radius.append(np.sqrt(float(apart.max())) * (1 + 1e-12))
        if len(own) > leaf and radius[-1] > 0:
            one = own[apart.argmax()]
            other = own[((own - one) ** 2).sum(1).argmax()]
            half = len(own) // 2
            order[lo[at] : hi[at]] = order[lo[at] : hi[at]][np.argpartition(own @ (other - one), half)]
            left.append(len(lo))
            lo += [lo[at], lo[at] + half]
            hi += [lo[at] + half, hi[at]]
        else:
            left.append(-1)
        at += 1
    return Tree(points[order], np.array(lo), np.array(hi), np.array(left), np.array(radius), np.array(center), np.array(total)), order


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows, exactly."""
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * products(a, b)


def descend(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(nodes that go to one centroid as wholes, their centroids, places of the other points, their centroids)."""
    whole, to, open_at, open_to = [], [], [], []
    front, fit = np.array([0]), np.zeros((1, len(centroids)), bool)
    fit[0, np.unique(centroids, axis=0, return_index=True)[1]] = True  # of equal centroids only the first is ever taken
    while len(front):
        exact = np.where(fit, apart(tree.center[front], centroids), FAR)
        nearest, away = exact.argmin(1), np.sqrt(exact.astype(np.float64))
        least, r = away.min(1), tree.radius[front]
        fit &= away <= (least + 2 * r + 1e-9 * (1 + least + r))[:, None]
        done = (r == 0) | (fit.sum(1) == 1)
        whole.append(front[done])
        to.append(nearest[done])
        leaf = ~done & (tree.left[front] < 0)
        if leaf.any():
            sizes = tree.hi[front[leaf]] - tree.lo[front[leaf]]
            places = np.repeat(tree.lo[front[leaf]] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            columns = np.flatnonzero(fit[leaf].any(0))
            open_at.append(places)
            open_to.append(columns[apart(tree.points[places], centroids[columns]).argmin(1)])
        down = ~done & ~leaf
        kids = tree.left[front[down]]
        front, fit = np.concatenate([kids, kids + 1]), np.concatenate([fit[down], fit[down]])
    none = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or none) for x in (whole, to, open_at, open_to))


def assigned(tree: Tree, centroids: np.ndarray) -> np.ndarray:
    """The centroid of each point."""
    whole, to, at, at_to = descend(tree, centroids)
    out = np.zeros(len(tree.points), np.int64)
    for node, c in zip(whole, to, strict=True):
        out[tree.lo[node] : tree.hi[node]] = c
    out[at] = at_to
    return out


def kept(df: DataFrame, id_col: str, vector: str, length: int) -> DataFrame:
    return df.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("v")).filter((F.size("v") == length) & sound("v"))


def trees(rows: DataFrame, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """A row for each block of (vec_id, v): the ids and the tree's arrays as bytes."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"ids array<{kind}>, points binary, lo binary, hi binary, left binary, radius binary, center binary, total binary"

    def rooted(rows: pa.Table) -> pa.RecordBatch:
        tree, order = grow(integers(matrix(rows["v"])), leaf)
        ids = rows["vec_id"].combine_chunks().take(pa.array(order))
        small = [x.astype(np.int32) for x in (tree.points, tree.lo, tree.hi, tree.left)] + [tree.radius, tree.center.astype(np.int32), tree.total]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays([0, len(ids)], ids), *(pa.array([x.tobytes()], pa.binary()) for x in (small[0], *small[1:]))], ["ids", "points", "lo", "hi", "left", "radius", "center", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block:
                rows = pa.Table.from_batches(held)
                yield rooted(rows.slice(0, block))
                held = rows.slice(block).to_batches()
        if sum(b.num_rows for b in held):
            yield rooted(pa.Table.from_batches(held))

    return rows.mapInArrow(run, schema)


def planted(batch: pa.RecordBatch, length: int) -> Iterator[tuple[pa.Array, Tree]]:
    """The trees of a batch of trees()."""
    kinds = {"points": np.int32, "lo": np.int32, "hi": np.int32, "left": np.int32, "radius": np.float64, "center": np.int32, "total": np.int64}
    for i in range(batch.num_rows):
        found = {n: np.frombuffer(batch.column(n)[i].as_buffer(), k) for n, k in kinds.items()}
        wide = {n: (x.reshape(-1, length) if n in ("points", "center", "total") else x) for n, x in found.items()}
        yield batch.column("ids")[i].values, Tree(**{n: x if n == "radius" else x.astype(np.int64) for n, x in wide.items()})


def first_centroids(rows: DataFrame, k: int) -> np.ndarray:
    """The k rows of smallest hash, in its order, as integers."""
    found = rows.select(F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return integers(np.array([r.v for r in found], np.float64)) if found else np.zeros((0, 0), np.int64)


def moved(planted_trees: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: exact floors of the means of their vectors; those without any stay."""
    k, length = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(k, np.int64), np.zeros((k, length), np.int64)
        for batch in batches:
            for _, tree in planted(batch, length):
                whole, to, at, at_to = descend(tree, centroids)
                np.add.at(n, to, tree.hi[whole] - tree.lo[whole])
                np.add.at(sums, to, tree.total[whole])
                np.add.at(n, at_to, 1)
                np.add.at(sums, at_to, tree.points[at])
        c, d = np.nonzero(np.repeat(n[:, None] > 0, length, 1))
        yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(n[c]), pa.array(sums[c, d])], ["cluster", "place", "n", "total"])

    added = planted_trees.mapInArrow(run, "cluster long, place long, n long, total long").groupBy("cluster", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    out = centroids.copy()
    for r in added.collect():  # k * length rows at most
        out[r.cluster, r.place] = r.total // r.n
    return out


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, length: int = LENGTH, id_col: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """((vec_id, cluster, distance) of every vector kept, the final centroids)."""
    rows = kept(df, id_col, vector, length)
    kind = rows.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(rows, k)
    if not len(centroids):
        return rows.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).limit(0), centroids
    grown = stage(trees(rows), "trees")
    for _ in range(rounds):
        centroids = moved(grown, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, tree in planted(batch, length):
                to = assigned(tree, centroids)
                yield pa.RecordBatch.from_arrays([ids, pa.array(to.astype(np.int32)), pa.array(((tree.points - centroids[to]) ** 2).sum(1))], ["vec_id", "cluster", "distance"])

    return stage(grown.mapInArrow(run, f"vec_id {kind}, cluster int, distance long"), "clusters"), centroids


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each row with its cluster's and the whole inertia and the SHA-256 of its centroid. The k sums go to all tasks: k rows at most."""
    sums = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    table = assigned.sparkSession.createDataFrame([(c, s, sum(sums.values()), digest[c]) for c, s in sorted(sums.items())], schema)
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
