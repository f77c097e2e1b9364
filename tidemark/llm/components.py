"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace the edges of a batch by links to the least node each one reaches within it."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            top = x
            while parent[top] != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
        pairs = np.array([(x, root(x)) for x in parent if parent[x] != x], dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with an edge; the component is its least node.

    `edges` has long columns u and v.  Null ends and loops are dropped; an
    empty table gives an empty result.  Each round is written to shared
    storage, so a lost executor repeats one round at most.  Hubs are safe:
    minima are combined before they are shuffled, and the joins are plain
    equi-joins that adaptive execution may split.
    """
    now = edges.select("u", "v").where("u is not null and v is not null and u != v")
    now = written(now.mapInArrow(_forest, "u long, v long").distinct())
    seen = None
    for _ in range(max_rounds):
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct())
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components: no fixed point after {max_rounds} rounds")
    nodes = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionAll(roots)
