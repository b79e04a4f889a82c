"""Connected components of edges that no single machine holds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway.session import shared_folder

_EDGE = "a BIGINT, b BIGINT"


def free_name(frame: DataFrame, name: str) -> str:
    """A column name that the table doesn't have in any case of letters."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(spark: SparkSession, frame: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, which cuts the lineage there."""
    path = shared_folder(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def union_find(pairs, parent: dict[int, int] | None = None) -> dict[int, int]:
    """Parent of every node, paths halved, the smaller root always on top."""
    parent = {} if parent is None else parent

    def root(x: int) -> int:
        up = parent.setdefault(x, x)
        while up != x:
            top = parent[up]
            parent[x] = top
            x, up = up, top
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        if a < b:
            parent[b] = a
        elif b < a:
            parent[a] = b
    return {x: root(x) for x in parent}


def _contract(batches):
    """Replace a partition's edges by at most one per node, to the root the partition sees.

    Blocks of edges keep the dictionary small; a forest of each block keeps all connections.
    """
    block = 500_000
    held: list[tuple[int, int]] = []

    def out():
        found = [(x, r) for x, r in union_find(held).items() if x != r]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())],
            ["a", "b"])

    for batch in batches:
        held.extend(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        if len(held) >= block:
            yield out()
    if held:
        yield out()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of `edges(a, b)`: the smallest node it is connected with.

    Each partition first reduces its edges with union-find; then the forests are joined
    by alternating star steps, each of which hangs neighbours on the smallest one seen, until no
    edge changes. The rounds grow with the logarithm of a component's size. Self-loops are nodes
    of their own; nulls must not occur.
    """
    spark = edges.sparkSession
    ends = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    nodes = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = stored(spark, ends.filter("a <> b").mapInArrow(_contract, _EDGE))
    before = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b") \
            .union(lower.select("a", F.col("m").alias("b"))).distinct()
        now = stored(spark, small)
        after = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            break
        before = after
    return nodes.join(now.withColumnRenamed("a", "node"), "node", "left") \
        .select("node", F.coalesce("b", "node").alias("root"))
