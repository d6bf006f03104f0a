"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.store import stored


def _labels(edges: DataFrame, done: int) -> DataFrame:
    """(node, label) of the round after ``done`` rounds."""
    if done % 2 == 0:
        first, second, label = F.col("a"), F.col("b"), F.min("near")
    else:
        def place(x):
            return F.struct(F.xxhash64(F.lit(done), x), F.col(x))
        swap = place("b") < place("a")
        first, second = F.when(swap, F.col("b")).otherwise(F.col("a")), F.when(swap, F.col("a")).otherwise(F.col("b"))
        label = F.min(F.struct(F.xxhash64(F.lit(done), "near").alias("place"), "near"))["near"]
    near = edges.select(second.alias("node"), first.alias("near")).union(edges.select(first.alias("node"), first.alias("near")))
    return near.groupBy("node").agg(label.alias("label"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the undirected links.

    In every round each node takes the first of its neighbours and itself as its
    label, and the links are contracted to links between labels.  In even rounds the
    first is the smallest, so that a star is done at once.  In odd rounds the nodes
    are ordered by a hash with a seed of its own: whatever the links are, a chain of
    ascending ids too, about half of the nodes or more are expected to go.  Then the
    labels of the rounds are joined back to front, and the smallest node of each label
    is looked up.  Labels come from partial aggregates and links that have become equal
    are dropped before the next round, so a node with very many links is no hot spot.
    """
    edges = stored(links.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct(),
                   "links")
    rounds = []
    while True:
        labels = stored(_labels(edges, len(rounds)), "labels")
        rounds.append(labels)
        ends = [labels.select(F.col("node").alias(x), F.col("label").alias(f"label_{x}")) for x in "ab"]
        moved = edges.join(ends[0], "a").join(ends[1], "b") \
            .select(F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b"))
        edges = stored(moved.where("a < b").distinct(), "links")
        if edges.isEmpty():
            break
    smallest = len(rounds) == 1
    out = rounds.pop().withColumnRenamed("label", "component")
    while rounds:
        earlier = rounds.pop()
        later = out.select(F.col("node").alias("label"), F.col("component").alias("_later"))
        out = earlier.join(later, "label", "left").select("node", F.coalesce("_later", "label").alias("component"))
        if len(rounds) % 8 == 7:
            out = stored(out, "composed")
    if smallest:
        return out
    out = stored(out, "composed")
    low = out.groupBy("component").agg(F.min("node").alias("_low"))
    return out.join(low, "component").select("node", F.col("_low").alias("component"))
