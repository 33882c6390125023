"""Connected components by hash-to-min, as joins and aggregates over rows (node, member)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmill.llm.shared import discard, join_sizes, materialize

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst of one orderable type); component is the smallest node.

    Each round, a node holding the cluster C sends C to min(C) and min(C) to all members of C. Clusters are rows, never
    arrays, and a node with many rows (the smallest of a giant component has them all) learns its minimum by
    broadcast, so a component of any size spreads over tasks. Null ends are ignored, loops keep single nodes. The
    rounds stop when one leaves every node's minimum, size and members as they were.
    """
    edges = edges.where("src is not null and dst is not null")
    pairs = edges.select(F.col("src").alias("node"), F.col("dst").alias("member")).union(edges.select("dst", "src"))
    loops = pairs.select("node", F.col("node").alias("member"))
    held, seen = materialize(pairs.union(loops).distinct(), "clusters"), None
    for _ in range(MAX_ROUNDS):
        members = F.bit_xor(F.xxhash64("member")).alias("members")
        state = materialize(held.groupBy("node").agg(F.min("member").alias("least"), F.count("*").alias("n"), members), "minima")
        now = state.agg(F.count("*").alias("nodes"), F.sum("n").alias("rows"), F.bit_xor(F.xxhash64("node", "least", "n", "members")).alias("all")).first()
        if now == seen:
            discard(held)
            return state.select("node", F.col("least").alias("component"))
        with_min = join_sizes(held, state.select("node", "least", "n"), "node")
        sent = with_min.select(F.col("least").alias("node"), "member").union(with_min.select(F.col("member").alias("node"), F.col("least").alias("member")))
        after = materialize(sent.distinct(), "clusters")
        discard(held)
        discard(state)
        held, seen = after, now
    raise RuntimeError(f"components not at rest after {MAX_ROUNDS} rounds")
