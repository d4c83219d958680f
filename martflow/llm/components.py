"""Connected components of an edge list, at any size.

Every task first joins the edges it holds, a bounded number at a time, to
stars around the smallest node it sees. Where several tasks had edges,
large-star and small-star steps follow, until the edges are stars around the
smallest node of each component. Each step is a grouped minimum, which hot
nodes pre-aggregate, and one join that AQE may split. Every step's edges are
written to the shared folder, which cuts lineage; there are never more of them
than at first, so their number says how many tasks are worth it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import map_batches
from martflow.session import delete_folder, scratch_path

EDGES_A_TASK = 50_000


def _written(edges: DataFrame, old: str | None, tasks: int | None = None) -> tuple[DataFrame, str]:
    spark = edges.sparkSession
    path = scratch_path(spark, "edges")
    (edges.coalesce(tasks) if tasks else edges).write.parquet(path)
    if old:
        delete_folder(spark, old)
    return spark.read.schema(edges.schema).parquet(path), path


def _stars():
    """Edges to stars (node, smallest node), ``EDGES_A_TASK`` nodes at a time at least."""
    parent: dict[int, int] = {}

    def root(node):
        top = node
        while (above := parent.get(top, top)) != top:
            top = above
        while node != top:
            parent[node], node = top, parent.get(node, node)
        return top

    def sent():
        found = [(node, root(node)) for node in parent]
        parent.clear()
        found = [(node, top) for node, top in found if node != top]
        return {"u": [node for node, _ in found], "v": [top for _, top in found]}

    def work(batch):
        for u, v in zip(batch["u"], batch["v"], strict=True):
            x, y = root(u), root(v)
            low = min(x, y)
            parent[x] = parent[y] = parent[u] = parent[v] = low
        if len(parent) > 2 * EDGES_A_TASK:
            yield sent()

    work.last = sent
    return work


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node has one edge up, or only edges down."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    per_node = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not per_node.agg(F.max(F.col("up") + F.col("down")) > 1).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for each node of ``edges`` (``u``, ``v``) that
    is not the smallest of its component. Written."""
    both = edges.select(F.greatest("u", "v").cast("long").alias("u"), F.least("u", "v").cast("long").alias("v"))
    current, path = _written(both.filter("u <> v"), None)
    count = current.count()
    while True:
        tasks = max(1, -(-count // EDGES_A_TASK))
        current, path = _written(map_batches(current.coalesce(tasks), _stars, "u long, v long"), path)
        if tasks == 1 or _are_stars(current):
            break
        # Large star: neighbours above a node point to the least of its neighbourhood.
        around = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m"))
        least, least_path = _written(least.select("u", F.least("u", "m").alias("m")), None, tasks)
        large = around.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current, path = _written(large.distinct(), path, tasks)
        delete_folder(current.sparkSession, least_path)
        # Small star: a node's neighbours below it, and itself, point to the least of them.
        least, least_path = _written(current.groupBy("u").agg(F.min("v").alias("m")), None, tasks)
        joined = current.join(least, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        current, path = _written(small.filter("u <> v").distinct(), path, tasks)
        delete_folder(current.sparkSession, least_path)
        count = current.count()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
