"""Connected components of an edge table, by alternating large-star and small-star steps.

Each step is a grouped aggregation over the edges that are left; the edges of a round are written to the shared folder, so the lineage stays short
and a lost executor costs one round's input at most. The number of rounds grows with the logarithm of the longest path. Once at most ``LOCAL_EDGES``
edges are left (counted before they are fetched, 16 MB of integers) one pass over them on the driver ends the rounds; the components are the same.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_EDGES = 1 << 20


def connected_components(edges: DataFrame, materialise: Callable[[DataFrame], DataFrame], left: str = "a", right: str = "b", local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``node, component`` for every node of an edge; a component is named by its smallest node.

    Edges with a NULL end are ignored; loops, repeated edges and both directions are allowed.
    """
    # edges may be costly to find, so they are written once and read for the nodes and for the first round
    links = materialise(edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null"))
    nodes = materialise(links.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    current = materialise(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    # after a round in which nothing changed every edge leads from a node to its component's smallest node
    mark = _mark(current)
    while mark[0]:
        if mark[0] <= local_edges:
            current = current.sparkSession.createDataFrame(_local(current.toArrow()), current.schema)
            break
        both = current.select("a", "b").unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a"))
        small = _star(large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), F.lit(True))
        current = materialise(small.where("a <> b").distinct())
        before, mark = mark, _mark(current)
        if before == mark:
            break
    return nodes.join(current.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def _star(pairs: DataFrame, joined: Column) -> DataFrame:
    """Connect each node's chosen neighbours to the smallest of the node and its neighbours.

    The smallest is an aggregate of one value a node and meets the neighbours by a join, so a hub's neighbourhood is never in one row.
    """
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    spread = pairs.where(joined).join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return spread.unionAll(own).where("a <> b").distinct()


def _mark(edges: DataFrame) -> tuple:
    """A fingerprint of the edge set, from one aggregation."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _local(edges: pa.Table) -> pa.Table:
    """Edges from each node to its component's smallest node, by union-find over the nodes' ranks."""
    a, b = edges.column("a").combine_chunks(), edges.column("b").combine_chunks()
    ranks = pc.rank(pa.concat_arrays([a, b]), tiebreaker="dense").to_numpy() if not pa.types.is_struct(a.type) else _struct_ranks(a, b)
    parent = list(range(int(ranks.max()) + 1))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(ranks[: len(a)].tolist(), ranks[len(a) :].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    first = {}
    for place, rank in enumerate(ranks.tolist()):
        first.setdefault(rank, place)
    both = pa.concat_arrays([a, b])
    pairs = [(place, first[root(rank)]) for rank, place in first.items() if root(rank) != rank]
    return pa.table({"a": both.take(pa.array([p for p, _ in pairs], pa.int64())), "b": both.take(pa.array([q for _, q in pairs], pa.int64()))})


def _struct_ranks(a: pa.Array, b: pa.Array):
    """Dense ranks of struct values in the order of their fields."""
    table = pa.Table.from_arrays([pa.concat_arrays([a.field(i), b.field(i)]) for i in range(a.type.num_fields)], [str(i) for i in range(a.type.num_fields)])
    order = pc.sort_indices(table, sort_keys=[(c, "ascending") for c in table.column_names]).to_numpy()
    new = np.zeros(len(order), dtype=np.int64)
    for column in table.columns:
        values = column.combine_chunks().take(pa.array(order))
        new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    ranks = np.empty(len(order), dtype=np.int64)
    ranks[order] = np.cumsum(new)
    return ranks
