"""Centroid clustering on integer vectors, with a vantage-point tree over the centroids.

A component x becomes the integer floor(256 * x). The first centroids are the vectors
with the smallest SHA-256 of seed and id. In each round the driver builds a
vantage-point tree over the centroids (``clusters`` of them, a bound whatever the rows)
and broadcasts it; every vector searches it best first: of the nodes it has seen but not
opened, it opens the one with the least lower bound, until that bound is beyond the best
distance found. The bound is inclusive - a node that may hold an equal distance is opened
- and distances are exact integers, so ties go to the smaller centroid number
exactly. A batch's vectors search together: each has its own frontier, and those that
open the same node share one matrix product. Products run in doubles where all sums stay
below 2^53, else in 64-bit integers, so they are exact either way.

Each task sums its vectors by cluster and sends at most one row a cluster; Spark adds
them as decimals, and the driver gets ``clusters`` rows of sums. New centroids are the
exact floors of sum / count; empty clusters stay as they are.

Vectors that are null, of another length, or hold null or non-finite components take no
part. Rows without id take part; as centroids they come last, equal hashes in the order
of their integers. Repeated rows count each. Fewer vectors than ``clusters``: each starts
a centroid. An empty table gives an empty result. A component of size 2^27 or more ends
the job with an error, since squared distances would not fit in a long. Only the two
columns named are read, so further ones, whatever their names, don't matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stonefly.llm.common import run_dir, write_table

#: Integers of this size and above are refused: 64 squares of differences would pass 2^63.
LARGEST = 1 << 27
LEAF = 4
#: Vectors that a task searches for together.
ROWS = 4096
#: Rounding of square roots, relative to the distances they come from (they are right to 2^-52).
SLACK = 1e-12


def squares(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact squared distances (n, m) between integer rows."""
    largest = max(np.abs(vectors).max(initial=0), np.abs(points).max(initial=0))
    if vectors.shape[1] * (2 * int(largest)) ** 2 < 1 << 53:
        v, p = vectors.astype(np.float64), points.astype(np.float64)
        d = (v * v).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None] - 2 * (v @ p.T)
        return d.astype(np.int64)
    out = np.empty((len(vectors), len(points)), np.int64)
    for j, p in enumerate(points):
        step = vectors - p
        out[:, j] = (step * step).sum(axis=1)
    return out


class CentroidTree:
    """Vantage-point tree over the centroids: arrays by node, so that a batch can search it together.

    A node's members are centroid numbers that its visitors measure: the vantage point of
    an inner node, all centroids of a leaf. The children of a node carry the least and the
    greatest distance of their centroids to the node's vantage point.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        self.members: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        self._build(np.arange(len(centroids)))

    def _build(self, rows: np.ndarray) -> int:
        node = len(self.members)
        self.members.append(rows)
        self.children.append([])
        if len(rows) <= LEAF:
            return node
        # the centroid farthest from the first one lies at the edge, which separates best
        far = int(np.argmax(squares(self.centroids[rows[:1]], self.centroids[rows])[0]))
        vantage, others = rows[far], np.delete(rows, far)  # both halves keep ascending numbers
        d = np.sqrt(squares(self.centroids[[vantage]], self.centroids[others])[0].astype(np.float64))
        by = np.argsort(d, kind="stable")
        self.members[node] = np.array([vantage])
        for half in (np.sort(by[: len(by) // 2]), np.sort(by[len(by) // 2 :])):
            self.children[node].append((self._build(others[half]), float(d[half].min()), float(d[half].max())))
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each vector's nearest centroid, and how many distances it took.

        The smaller number wins ties.
        """
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids), np.int64)
        frontier = np.full((n, len(self.members)), np.inf)
        frontier[:, 0] = 0
        active, measured = np.arange(n), 0
        while len(active):
            node = frontier[active].argmin(axis=1)
            bound = frontier[active, node]
            # inclusive: a bound equal to the best distance is opened
            root = np.sqrt(best[active].astype(np.float64))
            open_ = np.isfinite(bound) & (bound <= root * (1 + SLACK))
            active, node, bound = active[open_], node[open_], bound[open_]
            frontier[active, node] = np.inf
            for k in np.unique(node):
                own = active[node == k]
                members = self.members[k]
                d = squares(vectors[own], self.centroids[members])
                measured += d.size
                # argmin takes the first of equal distances, and members of a leaf ascend
                at = d.argmin(axis=1)
                least, which = d[np.arange(len(own)), at], members[at]
                better = (least < best[own]) | (least == best[own]) & (which < number[own])
                best[own[better]], number[own[better]] = least[better], which[better]
                away = np.sqrt(d[:, 0].astype(np.float64))
                for child, low, high in self.children[k]:
                    gap = np.maximum(np.maximum(low - away, away - high) - SLACK * (away + high), 0)
                    frontier[own, child] = np.maximum(gap, bound[node == k])
        return number, best, measured


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, size: int) -> DataFrame:
    """(vec_id, v): the rows that take part, with v an array of longs."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    kept = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(v.isNotNull() & (F.size("v") == size) & finite)
    whole = lambda x: F.when(F.abs(x * 256) < LARGEST, F.floor(x * 256)).otherwise(F.raise_error(F.lit(f"a component times 256 is {LARGEST} or more in size")).cast("long"))
    return kept.select("vec_id", F.transform("v", whole).alias("v"))


def matrix(column: pa.Array, size: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, size)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def first_centroids(vectors: DataFrame, clusters: int, seed: str) -> np.ndarray:
    """The vectors with the smallest lower-case hex SHA-256 of seed and id, in the hashes' order."""
    named = vectors.withColumn("h", F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256))
    chosen = named.orderBy(F.col("h").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in chosen], np.int64)


def cluster_sums(vectors: DataFrame, tree: CentroidTree, size: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sums of each cluster that has vectors: one row a cluster and task is shuffled."""
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(tree)  # at most `clusters` centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(shared.value.centroids)
        counts, sums = np.zeros(k, np.int64), np.zeros((k, size), object)
        for batch in parts(batches):
            v = matrix(batch.column("v"), size)
            at, _, _ = shared.value.nearest(v)
            order = np.argsort(at, kind="stable")
            own, first = np.unique(at[order], return_index=True)
            counts += np.bincount(at, minlength=k)
            sums[own] += np.add.reduceat(v[order], first, axis=0).astype(object)  # ROWS times LARGEST fits in a long
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array([[str(x) for x in sums[c]] for c in some], pa.list_(pa.string()))], names=["cluster", "n", "sums"])

    found = vectors.select("v").mapInArrow(run, "cluster int, n long, sums array<string>")
    totals = found.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(size))).collect()
    shared.unpersist()
    return {r["cluster"]: (r["n"], [int(r[f"s{i}"]) for i in range(size)]) for r in totals}


def assign(vectors: DataFrame, tree: CentroidTree, size: int) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(tree)
    kind = vectors.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts(batches):
            at, d, _ = shared.value.nearest(matrix(batch.column("v"), size))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(at, pa.int32()), pa.array(d)], names=["vec_id", "cluster", "distance"])

    return vectors.mapInArrow(run, f"vec_id {kind}, cluster int, distance long")


def centroid_clusters(spark: SparkSession, rows: DataFrame, clusters: int = 40, rounds: int = 5, size: int = 64, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Assignment (vec_id, cluster, distance) of every vector that takes part, written, and the final centroids."""
    folder = run_dir(spark, "tree-kmeans")
    vectors = write_table(integer_vectors(rows, id_col, vector_col, size), f"{folder}/vectors")
    centroids = first_centroids(vectors, clusters, seed).reshape(-1, size)
    if not len(centroids):
        return spark.createDataFrame([], f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"), centroids
    for _ in range(rounds):
        for c, (n, sums) in cluster_sums(vectors, CentroidTree(centroids), size).items():
            centroids[c] = [s // n for s in sums]
    return write_table(assign(vectors, CentroidTree(centroids), size), f"{folder}/assigned"), centroids


def cluster_report(spark: SparkSession, rows: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    assigned, centroids = centroid_clusters(spark, rows, **options)
    total = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # at most `clusters` entries, so they go into the plan
    table = lambda values, kind: F.element_at(F.create_map(*(x for c in sorted(values) for x in (F.lit(c), F.lit(values[c]).cast(kind)))) if values else F.create_map().cast(f"map<int,{kind}>"), F.col("cluster"))
    return assigned.select("vec_id", "cluster", "distance", table(total, "long").alias("cluster_inertia"), F.lit(sum(total.values())).cast("long").alias("inertia"), table(dict(enumerate(digest)), "string").alias("centroid_sha256"))


def _rounds_sql(clusters: int, rounds: int, size: int, seed: str) -> str:
    kept = f"""e AS (SELECT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {size} AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}' || vec_id)) - 1 AS INTEGER) AS cluster, v AS c FROM e ORDER BY sha256('{seed}' || vec_id) LIMIT {clusters})"""
    steps = [kept]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS MATERIALIZED (SELECT vec_id, v, min(struct_pack(d := d, cluster := cluster)) AS best FROM (
  SELECT vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM e CROSS JOIN c{r}) GROUP BY vec_id, v)""")
        if r < rounds:
            steps.append(f"""s{r + 1} AS (SELECT cluster, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT best.cluster AS cluster, unnest(v) AS x, unnest(range({size})) AS i FROM a{r}) GROUP BY cluster, i),
n{r + 1} AS (SELECT cluster, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{r + 1} GROUP BY cluster),
c{r + 1} AS MATERIALIZED (SELECT o.cluster, coalesce(n.c, o.c) AS c FROM c{r} o LEFT JOIN n{r + 1} n USING (cluster))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, best.cluster AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.cluster = best.cluster
"""


#: The query's rows in DuckDB SQL: all distances, round by round (vec_id is unique there).
SQL = _rounds_sql(40, 5, 64, "2:")
