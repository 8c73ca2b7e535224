"""Connected components of an edge table."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditweave.llm.common import written

#: Up to so many edges (8 MB) one task joins them; beyond, the star steps run on the cluster. Same results.
ONE_TASK_EDGES = 500_000


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node around it."""
    both = edges.select(F.col("b").alias("a"), F.col("a").alias("b")).unionAll(edges)
    least = both.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("m"))
    around = both.join(least, F.col("a") == F.col("at")).filter(F.col("b") > F.col("a"))
    return around.select(F.col("b").alias("a"), F.least("m", F.col("a")).alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy(F.col("a").alias("at")).agg(F.min("b").alias("m"))
    below = edges.join(least, F.col("a") == F.col("at")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return below.filter("a > b").unionAll(least.select(F.col("at").alias("a"), F.col("m").alias("b"))).distinct()


def _joined(batches):
    """``node, label`` by union-find over all edges of one task."""
    parent: dict[int, int] = {}

    def root(node: int) -> int:
        while (above := parent.setdefault(node, node)) != node:
            parent[node] = node = parent.setdefault(above, above)
        return node

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(map(root, nodes), pa.int64())], ["node", "label"])


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` for every node of ``edges`` (``a, b``): the smallest node reachable from it.

    A small forest of edges is joined in one task. Otherwise two star steps alternate until nothing
    changes; each round is written to the shared folder, so its lineage ends there. A self-loop or a repeated edge changes nothing; no edges give no rows.
    """
    spark = edges.sparkSession
    loops = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("label"))
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(spark, now, "edges")
    if now.count() <= ONE_TASK_EDGES:
        return now.coalesce(1).mapInArrow(_joined, "node long, label long").unionAll(loops.distinct()).groupBy("node").agg(F.min("label").alias("label"))
    state = None
    while True:
        # A forest of stars is the fixed point; the sum of hashes tells whether a round changed anything.
        found = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if found["n"] == 0 or tuple(found) == state:
            break
        state = tuple(found)
        now = written(spark, _small_star(_large_star(now).filter("a > b").distinct()), "edges")
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label"))).unionAll(loops).groupBy("node").agg(F.min("label").alias("label"))
