"""Connected components of links in a table, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stonefly.llm.common import write_table

#: Links that a task contracts at once (some 100 MB of numbers); fewer than that are one task's.
CHUNK = 1 << 21


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node) that connect what the links connect: hooking of roots to lesser ones, and pointer jumping."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            break
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[other], nodes[root[other]]


def contracted(links: DataFrame) -> DataFrame:
    """Links as stars, CHUNK links at a time in as few tasks as that takes: what a task holds is settled without a round."""
    tasks = max(1, -(-links.count() // CHUNK))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n = [], 0

        def flush() -> pa.RecordBatch:
            u, v = stars(*(np.concatenate([x.column(k).to_numpy() for x in kept]) for k in range(2)))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            kept.append(batch)
            n += batch.num_rows
            if n >= CHUNK:
                yield flush()
                kept, n = [], 0
        if n:
            yield flush()

    return links.select("u", "v").coalesce(tasks).mapInArrow(run, "u long, v long")


def settled(links: DataFrame) -> bool:
    """Are the links (u > v) stars already: each u with one v, which is no u itself?"""
    ends = links.select(F.col("u").alias("node"), F.col("v").alias("up")).unionByName(links.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("up")))
    ends = ends.groupBy("node").agg(F.min("up").alias("least"), F.max("up").alias("most"), F.max(F.col("up").isNull()).alias("root"))
    return ends.filter("least IS NOT NULL AND (root OR least <> most)").count() == 0


def connected(links: DataFrame, folder: str, rounds: int = 40) -> DataFrame:
    """Links (u, v; of written tables) of long node numbers to (node, root): each linked node and the least node it reaches.

    Every step reads a written table and writes the next one, so a lost executor costs a
    task, not the history; only a count comes to the driver. Least neighbours are
    aggregated before they are joined back, so a node with very many links
    is neither collected nor ordered in one task.
    """
    links = write_table(contracted(links), f"{folder}/links-0")
    for k in range(rounds):
        if settled(links):
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_table(large.distinct(), f"{folder}/large-{k}")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).filter("u <> v")
        links = write_table(small.distinct(), f"{folder}/small-{k}")
        links = write_table(contracted(links), f"{folder}/links-{k + 1}")
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    links = links.distinct()  # tasks can have made the same link
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
