"""Centroid clustering by ball-tree filtering: exact rounds of nearest centroids over integer vectors.

Vectors are made integers, and each task cuts its own into metric trees of TREE vectors at
most: a node is a ball with centre, radius, count and integer sum. Trees are written to the
shared folder once; every round reads them. A round sends the centroids to the tasks and
walks down the trees: by the triangle inequality a centroid whose least distance to a ball
is beyond another's largest can't own a vector of it, so it is dropped; a ball with one
centroid left is taken whole by its count and sum, others are opened, and leaves compare
their vectors with the centroids that are left in whole numbers. Radii are compared with a
slack for rounding, so only exact comparisons decide what is near a tie. Only counts and
sums by centroid leave a task, and only centroids reach the driver: their number and length
are parameters.

Defined results: vectors that are null, of another length, or with a null or non-finite
component are left out; ties go to the smaller centroid; repeated rows are vectors like
others, also among the first centroids; a null id is kept and comes last in the order of
first centroids, equal ids are ordered by their vectors; with fewer vectors than centroids
there are fewer of these; a component beyond LARGEST after scaling is an error, as squared
distances wouldn't fit a long; other columns aren't read; no vectors give no rows.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, map_batches, materialize, table

#: Vectors of a tree and of a leaf at most (a ball of equal vectors is a leaf of any size).
TREE, LEAF = 16_384, 64
#: Components after scaling; up to EXACT products and their sums are whole numbers in a double.
LARGEST, EXACT = 1 << 26, 1 << 22
SLACK = 1e-9


class BallTree:
    """Vectors in the order of the leaves, and the nodes, parents before children."""

    def __init__(self, points: np.ndarray):
        n, size = points.shape
        order = np.arange(n)
        spans, child, centre, radius, sums = [(0, n)], [], [], [], []
        for start, stop in spans:  # grows as nodes are split
            own = points[order[start:stop]]
            x = own.astype(np.float64)
            mean = x.mean(axis=0)
            off = ((x - mean) ** 2).sum(axis=1)
            centre.append(mean)
            radius.append(np.sqrt(off.max()))
            sums.append(own.sum(axis=0, dtype=np.int64))
            if stop - start <= LEAF or radius[-1] == 0:
                child.append(-1)
                continue
            one = x[off.argmax()]
            other = x[((x - one) ** 2).sum(axis=1).argmax()]
            half = (stop - start) // 2
            order[start:stop] = order[start:stop][np.argpartition(x @ (other - one), half)]
            child.append(len(spans))
            spans += [(start, start + half), (start + half, stop)]
        self.order, self.points = order, points[order].astype(np.int32)
        self.spans, self.child = np.array(spans), np.array(child)
        self.centre, self.radius, self.sums = np.array(centre), np.array(radius), np.array(sums)
        self.whole = np.float64 if np.abs(points).max(initial=0) <= EXACT else np.int64

    def distances(self, start: int, stop: int, centroids: np.ndarray) -> np.ndarray:
        """Squared distances as whole numbers."""
        x, c = self.points[start:stop].astype(self.whole), centroids.astype(self.whole)
        if self.whole is np.float64:
            return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
        return np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1)

    def walk(self, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray | None]]:
        """Nodes that together hold each vector once: the node, its centroids that are left, and for opened leaves each vector's centroid."""
        nodes, left = np.zeros(1, np.int64), np.ones((1, len(centroids)), bool)
        while len(nodes):
            far = np.sqrt(((self.centre[nodes][:, None] - centroids[None]) ** 2).sum(axis=2))
            r = self.radius[nodes][:, None]
            slack = SLACK * (1 + far + r)
            most = np.where(left, far + r + slack, np.inf).min(axis=1)
            left &= far - r - slack <= most[:, None]
            single, leaf = left.sum(axis=1) == 1, self.child[nodes] < 0
            for k in np.flatnonzero(single | leaf).tolist():
                some = np.flatnonzero(left[k])
                yield int(nodes[k]), some, None if single[k] else some[self.distances(*self.spans[nodes[k]], centroids[some]).argmin(axis=1)]
            opened = ~single & ~leaf
            first = self.child[nodes[opened]]
            nodes, left = np.concatenate([first, first + 1]), np.concatenate([left[opened]] * 2)

    def totals(self, centroids: np.ndarray) -> np.ndarray:
        """Sums of each centroid's vectors, and in the last column their number."""
        out = np.zeros((len(centroids), self.points.shape[1] + 1), np.int64)
        for node, some, owner in self.walk(centroids):
            start, stop = self.spans[node]
            if owner is None:
                out[some[0], :-1] += self.sums[node]
                out[some[0], -1] += stop - start
            else:
                np.add.at(out[:, :-1], owner, self.points[start:stop])
                out[:, -1] += np.bincount(owner, minlength=len(centroids))
        return out

    def owners(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The centroid of each vector and its squared distance, in the order of the points."""
        owner, distance = np.zeros(len(self.points), np.int32), np.zeros(len(self.points), np.int64)
        for node, some, each in self.walk(centroids):
            start, stop = self.spans[node]
            owner[start:stop] = some[0] if each is None else each
            d = self.distances(start, stop, centroids[some])
            distance[start:stop] = d[:, 0] if each is None else d.min(axis=1)
        return owner, distance


def integers(vector: Column, size: int, scale: int) -> tuple[Column, Column]:
    """Whether a vector is kept, and its components as whole numbers."""
    wide = vector.cast("array<double>")
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == size) & ~odd, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale))


def _trees(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def tree() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column(0) for b in held])
            points = np.concatenate([b.column(1).flatten().to_numpy(zero_copy_only=False) for b in held]).reshape(-1, size)
            if np.abs(points).max(initial=0) > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling")
            made = BallTree(points)
            ids = ids.take(pa.array(made.order))
            del made.order
            return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([pickle.dumps(made, 5)], pa.binary())], names=["ids", "tree"])

        for b in batches:
            if b.num_rows:
                held.append(b)
                rows += b.num_rows
            if rows >= TREE:
                yield tree()
                held, rows = [], 0
        if held:
            yield tree()

    return run


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, BallTree]]:
    for b in batches:
        for i in range(b.num_rows):
            yield b.column("ids")[i].values, pickle.loads(b.column("tree")[i].as_buffer())


def next_centroids(trees: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: each centroid becomes the floor of its vectors' mean; one without vectors stays."""
    now = trees.sparkSession.sparkContext.broadcast(np.array(centroids, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for _, tree in _rows_of(batches):
            total = total + tree.totals(now.value)
        if isinstance(total, np.ndarray):
            own = np.flatnonzero(total[:, -1])
            yield pa.RecordBatch.from_arrays([pa.array(own.astype(np.int32)), pa.array(total[own].tolist(), pa.list_(pa.int64()))], names=["cluster", "sums"])

    parts = map_batches(trees, run, "cluster int, sums array<bigint>").select("cluster", F.posexplode("sums").alias("pos", "x"))
    found = {(r["cluster"], r["pos"]): int(r["x"]) for r in parts.groupBy("cluster", "pos").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()}  # k x (size + 1) rows at most
    size = len(centroids[0])
    return [[found[c, i] // found[c, size] for i in range(size)] if (c, size) in found else old for c, old in enumerate(centroids)]


def cluster(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", size: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: str = "2:") -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector."""
    spark, kind = df.sparkSession, df.schema[vec_id].dataType
    keep, whole = integers(F.col(f"`{vector}`"), size, scale)
    kept = df.where(keep).select(F.col(f"`{vec_id}`").alias("vec_id"), whole.alias("v"))
    trees = materialize(map_batches(kept, _trees(size), T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("tree", T.BinaryType())])), "ball-trees")
    order = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    now = [list(r["v"]) for r in kept.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]
    for _ in range(rounds if now else 0):
        now = next_centroids(trees, now)
    last = spark.sparkContext.broadcast(np.array(now, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, tree in _rows_of(batches):
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, tree.owners(last.value))], names=["vec_id", "cluster", "distance"])

    schema = T.StructType([T.StructField("vec_id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    owned = materialize(map_batches(trees, run, schema), "clusters")
    discard(trees)
    sums = {r["cluster"]: int(r["x"]) for r in owned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("x")).collect()}  # k rows at most
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    small = spark.createDataFrame([(c, x, sum(sums.values()), digests[c]) for c, x in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return owned.join(F.broadcast(small), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_centroids(spark, sf_dir: str) -> DataFrame:
    """Every kept vector of ``embeddings`` after five rounds of forty centroids."""
    return cluster(table(spark, sf_dir, "embeddings"))


def sql(size: int = 64, scale: int = 256, k: int = 40, rounds: int = 5, seed: str = "2:") -> str:
    """All pairs of vectors and centroids in every round; ids are taken to be unique."""
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings "
        f"WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS c, v AS w FROM (SELECT sha256('{seed}' || vec_id) AS h, v FROM v ORDER BY h LIMIT {k}))",
    ]
    for r in range(rounds + 1):
        parts.append(f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c := c)) AS best FROM v, c{r} GROUP BY vec_id)")
        if r < rounds:
            parts.append(f"s{r} AS (SELECT best.c AS c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r})")
            parts.append(f"m{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM s{r} GROUP BY c, i)")
            parts.append(f"n{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS w FROM m{r} GROUP BY c)")
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n{r}.w, c{r}.w) AS w FROM c{r} LEFT JOIN n{r} USING (c))")
    out = (
        "SELECT vec_id, CAST(best.c AS INT) AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON c = best.c"
    )
    return f"WITH {', '.join(parts)} {out}"
