"""Connected components of an edge table: union-find inside partitions, then
min-label hooking with pointer jumping between them. Only a change count
reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import stage

#: Nodes that a union-find forest holds before it is emitted and begun anew.
FOREST_NODES = 1_000_000


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def emit() -> pa.RecordBatch:
        pairs = [(x, find(x)) for x in list(parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = find(a), find(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) >= FOREST_NODES:
            yield emit()
            parent.clear()
    yield emit()


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: long, no nulls) -> (node, component): the smallest node
    reachable, one row for each node that has an edge. Self-loops count as an
    edge; no edges give no rows.

    Partitions reduce their edges to union-find forests first, so a star of
    any size becomes one edge per node and the rounds that follow are few.
    """
    forest = stage(edges.select("a", "b").repartition("a", "b").mapInArrow(_forest, "u long, v long"),
                   "forest")
    both = forest.union(forest.select(F.col("v").alias("u"), F.col("u").alias("v")))
    labels = stage(both.groupBy(F.col("u").alias("node")).agg(
        F.least(F.min("v"), F.col("node")).alias("component")), "labels")
    loops = (edges.where("a = b").select(F.col("a").alias("node"))
             .distinct().join(labels, "node", "left_anti")
             .withColumn("component", F.col("node")))
    while True:
        lab_v = labels.select(F.col("node").alias("v"), F.col("component").alias("lv"))
        lab_u = labels.select(F.col("node").alias("u"), F.col("component").alias("lu"))
        seen = both.join(lab_v, "v").groupBy("u").agg(F.min("lv").alias("lv"))
        near = lab_u.join(seen, "u")
        # the node itself and its present root both learn the smaller label
        offers = (near.select(F.col("u").alias("node"), F.least("lu", "lv").alias("to"))
                  .union(near.where("lv < lu").select(F.col("lu").alias("node"),
                                                      F.col("lv").alias("to"))))
        hooked = stage(offers.groupBy("node").agg(F.min("to").alias("component")), "hooked")
        root = hooked.select(F.col("node").alias("component"),
                             F.col("component").alias("above"))
        jumped = (hooked.join(root, "component", "left")
                  .select("node", F.coalesce("above", "component").alias("component")))
        new = stage(jumped, "labels")
        changed = (new.join(labels.withColumnRenamed("component", "was"), "node")
                   .where("component < was").limit(1).count())
        labels = new
        if not changed:
            return labels.union(loops)
