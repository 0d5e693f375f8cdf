"""Connected components of an edge table, and groups of sorted rows inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyspan.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every end of ``edges`` (columns ``a``, ``b``: longs); root is the least node it reaches.

    Each round takes the least label among the neighbours and then that label's own label, so long
    chains halve. Labels are written to the shared folder each round; only the count of changes
    reaches the driver.
    """
    both = materialise(
        edges.where("a != b").select("a", "b").union(edges.where("a != b").select("b", "a")).toDF("a", "b").distinct(), "edges"
    )
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("root")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("root").alias("m"))
        stepped = labels.join(near, labels["node"] == near["a"]).select("node", F.col("root").alias("before"), F.least("root", "m").alias("via"))
        hop = labels.select(F.col("node").alias("via"), F.col("root").alias("beyond"))
        labels = materialise(
            stepped.join(hop, "via", "left").select("node", F.least("via", F.coalesce("beyond", "via")).alias("root"), "before"), "labels"
        )
        changed = labels.where(F.col("root") != F.col("before")).limit(1).count()
        labels = labels.select("node", "root")
        if not changed:
            return labels


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key of a task whose rows are sorted by ``keys``, one group at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        columns = [batch.column(k).to_pylist() for k in keys]
        start = 0
        for i, key in enumerate(zip(*columns)):
            if key != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, key
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
