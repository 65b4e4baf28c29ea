"""Connected components of an edge table, as union-find spread over Spark.

Each task first runs a union-find over its share of the edges and emits one edge per
node, to the smallest node of its set.  Alternating large-star and small-star joins
(each a grouped minimum and a join) then contract the forest until it is one of stars.  No component is ever gathered in one place: a hot centre is a grouped
minimum, combined before the shuffle, and a join that Spark can split.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from attrix.llm.common import stored


def union_find(edges) -> dict:
    """Node -> smallest node of its set, for the nodes of ``edges`` (pairs)."""
    parent: dict = {}

    def root(x):
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent.setdefault(up, up)
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(parent)}


def _local(batches):
    pairs: list = []
    schema = None
    for b in batches:
        schema = b.schema
        pairs += union_find([*pairs, *zip(b.column(0).to_pylist(), b.column(1).to_pylist())]).items()
        pairs = list(dict(pairs).items())
    if schema is not None:
        pairs = [(a, b) for a, b in pairs if a != b]
        yield pa.record_batch([pa.array([a for a, _ in pairs], schema.field(0).type),
                               pa.array([b for _, b in pairs], schema.field(0).type)], names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``comp`` (its component's smallest node, the node itself left out) of edges a, b.

    Loops and repeated edges are allowed; an empty table gives an empty result.
    """
    kind = dict(edges.dtypes)["a"]
    e = stored(edges.where("a <> b").mapInArrow(_local, f"a {kind}, b {kind}").distinct(), "edges")
    while True:
        near = e.select(F.col("a").alias("u"), F.col("b").alias("v")).union(e.select("b", "a"))
        least = stored(near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = near.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = stored(large, "large")
        down = stored(large.groupBy("a").agg(F.min("b").alias("m")), "down")
        small = (large.join(down, "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b").where("a <> b").distinct())
        e = stored(small, "edges")
        # done when every node has one edge and the nodes they lead to have none: a forest of stars
        nodes = (e.select("a", F.lit(1).alias("up"), F.lit(0).alias("root")).union(e.select("b", F.lit(0), F.lit(1)))
                 .groupBy("a").agg(F.sum("up").alias("up"), F.max("root").alias("root")))
        if nodes.where("up > 1 or (up > 0 and root > 0)").isEmpty():
            return e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
