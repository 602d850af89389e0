"""Connected components of a links table.

Large tables go through alternating large-star and small-star rounds.  A table
of a bounded number of links is solved by one task instead, which saves dozens
of small shuffles; both ways give the same rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakework.llm.common import staged

#: Links (two ids of 16 bytes, say) that one task may hold: a few MB.
TASK_LINKS = 100_000


def connected_components(links: DataFrame, max_rounds: int = 100, task_links: int = TASK_LINKS) -> DataFrame:
    """(node, root) for each node of ``links`` (columns a, b); root is the component's least node.

    Every round is one aggregation and one join per star, staged in the shared
    folder; the number of rounds grows with the logarithm of the longest path.
    Groups pre-aggregate to their least neighbour, so a hub's links are never in one
    task's memory.  Null ends and self-links are ignored; no links, no rows.
    """
    edges = links.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = staged(edges, "links")
    if edges.limit(task_links + 1).count() <= task_links:
        return _in_one_task(edges)
    before = None
    for _ in range(max_rounds):
        edges = staged(_small_star(_large_star(edges)), "stars")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"links didn't settle in {max_rounds} rounds")
    # settled: every edge leads from a node to its root
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _in_one_task(edges: DataFrame) -> DataFrame:
    """Union-find over all links; the caller has checked their number."""
    kind = edges.schema["u"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("root", kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        out = None
        for batch in batches:
            out = batch.schema
            for u, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = find(u), find(v)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if out is not None:
            nodes = list(parent)
            yield pa.RecordBatch.from_arrays([pa.array(nodes, out.field(0).type), pa.array([find(x) for x in nodes], out.field(0).type)], names=["node", "root"])

    return edges.coalesce(1).mapInArrow(run, schema)


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each node's larger neighbours to its least neighbour or itself."""
    both = edges.select("u", "v").union(edges.select(F.col("v"), F.col("u")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least.select(F.col("u").alias("c"), "m"), F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
