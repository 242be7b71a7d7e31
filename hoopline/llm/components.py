"""Connected components by distributed union-find.

Each task runs union-find over its share of the edges and returns a forest. A node that has several roots, from
several tasks, ties those roots together; these ties are the edges of the next round. The number of tasks follows
the number of edges left, at most ``EDGES_PER_TASK`` for each; it ends when no node has two roots, and rounds are few
as ties are far fewer than edges. What a round finds is written to the shared folder.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopline.llm.frames import discard, stage

EDGES_PER_TASK = 1_000_000


def forest(edges: Iterator[tuple[int, int]]) -> dict[int, int]:
    """Each node's root, the smallest node it is tied to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges() -> Iterator[tuple[int, int]]:
        for batch in batches:
            yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

    found = forest(edges())
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["node", "root"]
    )


def connected_components(edges: DataFrame, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b, long): nodes of one component share one root.

    Loops and repeated edges do no harm; rows with a null end are left out. Nodes without an edge are not returned.
    """
    levels: list[DataFrame] = []
    forests: list[DataFrame] = []
    edges = edges.select("a", "b").filter("a is not null and b is not null")
    count = edges.count()
    ours = None  # edges stored here, deleted once the next forest is stored
    while True:
        tasks = max(1, math.ceil(count / per_task))
        found = stage(edges.repartition(tasks).mapInArrow(_forests, "node long, root long"), "forest")
        forests.append(found)
        discard(ours)
        least = found.groupBy("node").agg(F.min("root").alias("root"))
        levels.append(least)
        ties = found.join(least.withColumnRenamed("root", "least"), "node").filter("root <> least")
        edges = ours = stage(ties.select(F.col("least").alias("a"), F.col("root").alias("b")).distinct(), "ties")
        count = edges.count()
        if not count:
            break
    discard(ours)
    result = levels.pop()
    while levels:
        upper = result.select(F.col("node").alias("root"), F.col("root").alias("top"))
        result = levels.pop().join(upper, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    # Stored, so the forests of the rounds can go.
    result = stage(result, "components")
    discard(*forests)
    return result
