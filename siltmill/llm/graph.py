"""Connected components by alternating stars, and groups from sorted batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltmill.llm.common import removed, separate, written


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's greater neighbours point to the least of the node and its neighbours."""
    both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return both.join(separate(least), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its lesser neighbours point to the least of these."""
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(separate(least), "a").select("b", "m").union(least.select(F.col("a").alias("b"), "m")).select(F.col("b").alias("a"), F.col("m").alias("b"))


def _unsettled(e: DataFrame) -> bool:
    """Whether a node has two lesser nodes, or one that has a lesser node itself."""
    ends = e.select(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(e.select("b", F.lit(0), F.lit(1)))
    return bool(ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").take(1))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of edges (a, b); the component is its least node. a may equal b.

    Each round is written to the shared folder and the next one reads that. A
    node's neighbours are never gathered: only their minimum is, with map-side
    partials. It ends when every node points to a least
    node, after about log(n) rounds.
    """
    nodes = edges.select(F.col("a").alias("node")).union(edges.select(F.col("b").alias("node"))).distinct()
    e = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    e = written(e, "edges")
    while _unsettled(e):
        old = e
        e = written(_small_star(_large_star(e).where("a != b")).where("a != b").distinct(), "edges")
        removed(old)
    found = e.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def in_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal keys, from batches that come sorted by them. Only one group is held at a time, besides a batch."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cut = [0]
        if n > 1:
            new = None
            for k in keys:
                c = batch.column(k)
                differs = pc.not_equal(c.slice(1), c.slice(0, n - 1))
                new = differs if new is None else pc.or_(new, differs)
            cut += (pc.indices_nonzero(new).to_numpy() + 1).tolist()
        for i, j in zip(cut, [*cut[1:], n], strict=True):
            key = tuple(batch.column(k)[i].as_py() for k in keys)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(i, j - i))
            last = key
    if held:
        yield pa.Table.from_batches(held)
