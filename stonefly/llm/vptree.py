"""Nearest neighbours by vantage-point trees, one for each shard of the vectors.

Rows are dealt to shards by a hash of their id, queries to blocks. Every (shard,
block) pair is a group of bounded size: it builds the shard's tree and searches it
for the block's queries; each query's best are then merged over the shards.

A node keeps one vector as vantage point and the others in two halves by distance,
with the least and greatest distance of each half. By the triangle inequality, a half
whose distances lie in [a, b] has nothing nearer than max(a - d, d - b) to a query at
distance d. It is skipped when ``factor`` times the query's k-th best distance is less.
Factor one skips only what can't hold a neighbour and is exact; smaller factors skip more.

Vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows without id; vectors of different lengths are not compared. Distances are
in double precision on the original components; ties go to the smaller id. Repeated
rows are candidates each. Fewer candidates than k are all returned; an empty table
gives an empty result. Columns other than those named are neither read nor met.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAF = 32
#: Rounding of distances: what lies this much (relatively) beyond a bound is still looked at.
SLACK = 1e-9


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances between rows of x and y, component by component, in one order of summation."""
    total = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        step = x[:, i, None] - y[None, :, i]
        step *= step
        total += step
    return np.sqrt(total, out=total)


class Tree:
    """Vantage-point tree over the rows of ``points``; ``ids`` break ties."""

    def __init__(self, points: np.ndarray, ids: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.points, self.ids = points[order], ids[order]
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> tuple:
        if len(rows) <= LEAF:
            return (rows,)
        # the row farthest from the first one lies at the edge, which separates best
        far = int(np.argmax(distances(self.points[rows[:1]], self.points[rows])[0]))
        vantage, others = rows[far], np.delete(rows, far)
        d = distances(self.points[vantage : vantage + 1], self.points[others])[0]
        by = np.argsort(d, kind="stable")
        half = len(by) // 2
        inner, outer = by[:half], by[half:]
        return vantage, (d[inner[0]], d[inner[-1]], self._build(others[inner])), (d[outer[0]], d[outer[-1]], self._build(others[outer]))

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Distances and ids (n, k) of each query's nearest, its own id left out; missing ones are infinite."""
        best_d = np.full((len(queries), k), np.inf)
        best_id = np.full((len(queries), k), np.iinfo(np.int64).max)

        def offer(active: np.ndarray, rows: np.ndarray) -> np.ndarray:
            d = distances(queries[active], self.points[rows])
            ids = np.broadcast_to(self.ids[rows], d.shape)
            shown = np.where(ids == own[active, None], np.inf, d)
            both_d = np.concatenate([best_d[active], shown], axis=1)
            both_id = np.concatenate([best_id[active], np.where(np.isinf(shown), np.iinfo(np.int64).max, ids)], axis=1)
            keep = np.lexsort((both_id, both_d), axis=1)[:, :k]
            best_d[active] = np.take_along_axis(both_d, keep, axis=1)
            best_id[active] = np.take_along_axis(both_id, keep, axis=1)
            return d

        def visit(node: tuple, active: np.ndarray) -> None:
            if not len(active):
                return
            if len(node) == 1:
                if len(node[0]):
                    offer(active, node[0])
                return
            vantage, inner, outer = node
            d = offer(active, np.array([vantage]))[:, 0]
            near = d <= (inner[1] + outer[0]) / 2
            for first, second, mine in ((inner, outer, near), (outer, inner, ~near)):
                for low, high, child in (first, second):
                    gap = np.maximum(np.maximum(low - d[mine], d[mine] - high), 0)
                    visit(child, active[mine][gap * (1 - SLACK) <= factor * best_d[active[mine], k - 1] * (1 + SLACK)])

        visit(self.root, np.arange(len(queries)))
        return best_d, best_id


def usable(column: str) -> F.Column:
    """Neither null nor zero, and all components finite."""
    c = F.col(column)
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return c.isNotNull() & finite & F.exists(c, lambda x: x != 0)


def nearest(rows: DataFrame, k: int = 10, factor: float = 1.0, every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = 8192, block_rows: int = 8192) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k nearest other rows (query_id, rank, vec_id, score)."""
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).filter(F.col("vec_id").isNotNull() & usable("v")).withColumn("size", F.size("v"))
    is_query = F.col("vec_id") % every == 0
    n = rows.agg(F.count("*").alias("rows"), F.count(F.when(is_query, 1)).alias("queries")).first()
    shards, blocks = max(1, -(-n["rows"] // shard_rows)), max(1, -(-n["queries"] // block_rows))
    deal = lambda seed, parts: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    # repeated ids of candidates spread by the vector too; a query row is searched once whatever its copies
    asked = rows.filter(is_query).groupBy("vec_id", "size").agg(F.min("v").alias("v"))
    data = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("query", F.lit(False))
    asked = asked.withColumn("block", deal(2, blocks)).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn("query", F.lit(True))
    columns = ["shard", "block", "size", "query", "vec_id", "v"]

    def search(group: pd.DataFrame) -> pd.DataFrame:
        asks, has = group[group["query"]], group[~group["query"]]
        if asks.empty or has.empty:
            return pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        own = asks["vec_id"].to_numpy(np.int64)
        d, ids = Tree(np.stack(has["v"].to_list()), has["vec_id"].to_numpy(np.int64)).search(np.stack(asks["v"].to_list()), own, k, factor)
        found = np.isfinite(d)
        return pd.DataFrame({"query_id": np.broadcast_to(own[:, None], d.shape)[found], "vec_id": ids[found], "score": d[found]})

    hits = data.select(columns).unionByName(asked.select(columns)).groupBy("shard", "block", "size").applyInPandas(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The query's rows in DuckDB SQL, by brute force.
SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
u AS (SELECT * FROM e WHERE len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
d AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, sqrt(list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))) AS score
  FROM u q JOIN u c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v) WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
