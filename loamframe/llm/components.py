"""Connected components of an edge table, in rounds of star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamframe.llm.shared import discard, materialise, salted_join


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of a partition as stars: every node under the least node it reaches there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.get(top, top) != top:
            top = parent[top]
        while parent.get(x, x) != top:
            parent[x], x = top, parent[x]
        return top

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            parent.setdefault(u, u)
            parent.setdefault(v, v)
            a, c = root(u), root(v)
            if a != c:
                parent[max(a, c)] = min(a, c)
    stars = [(x, root(x)) for x in parent if root(x) != x]
    if stars:
        u, v = zip(*stars, strict=True)
        yield pa.RecordBatch.from_pydict({"u": pa.array(np.array(u), pa.int64()), "v": pa.array(np.array(v), pa.int64())})


def _state(edges: DataFrame) -> tuple[int, int]:
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), F.coalesce(total, F.lit(0))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the least node reachable) for every node of ``edges`` (``u``, ``v``).

    Self loops and repeated edges are allowed; nodes are non-null longs.  Each
    round joins every node's neighbours to the least of them; minima are taken
    before the shuffle, and the neighbours of a node with very many are dealt to
    many tasks.
    """
    now = materialise(edges.where("u <> v").mapInArrow(forest, "u long, v long").distinct(), "edges")
    before = _state(now)
    while before[0]:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = salted_join(both, least, ["u"], ["v"], 2 * before[0]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lower = large.where("u > v")
        small = lower.groupBy("u").agg(F.min("v").alias("m"))
        rest = salted_join(lower, small, ["u"], ["v"], before[0]).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        last, now = now, materialise(rest.union(small.select("u", F.col("m").alias("v"))).distinct(), "edges")
        discard(now.sparkSession, last)
        state = _state(now)
        if state == before:
            break
        before = state
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct())
