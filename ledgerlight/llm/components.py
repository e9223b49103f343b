"""Connected components of links that never leave the cluster."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.storage import stored_bytes

from .common import arrow_map, discard, gathered, materialize, small

#: Links whose files are at most this large, some hundred thousand, are contracted by one task.
LOCAL_BYTES = 1 << 20


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of links(a long, b long).

    Contraction: each node hooks to the first of itself and its neighbours in a random order of nodes, which are its
    label in the next, smaller graph; the random order makes the graph shrink by a constant share whatever its shape, so
    chains take a logarithmic number of rounds. Every round is written to the shared folder. What is left once the links'
    files are at most LOCAL_BYTES is contracted by one task, whatever the input: rounds over so little only cost jobs and
    files. Hubs: neighbours are reduced by partial aggregation, and joins read written tables on both sides, so that Spark
    can split a hub's rows. Null ends and loops are dropped; an empty table gives no rows.
    """
    held = stored_bytes(links)
    ends = links.select(F.col("a").cast("long"), F.col("b").cast("long")).where("a <> b")
    edges = links if held is not None and held <= LOCAL_BYTES else materialize(gathered(ends.distinct()), "edges")
    hooks = []
    while stored_bytes(edges) > LOCAL_BYTES and not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = F.least(F.struct(F.xxhash64("a").alias("x"), F.col("a").alias("n")), F.min(F.struct(F.xxhash64("b").alias("x"), F.col("b").alias("n"))))
        hook = materialize(both.groupBy("a").agg(first["n"].alias("label")).withColumnRenamed("a", "node"), "hooks")
        hooks.append(hook)
        one, two = (small(hook).select(F.col("node").alias(f"n{i}"), F.col("label").alias(f"l{i}")) for i in (1, 2))
        joined = edges.join(one, F.col("a") == F.col("n1")).join(two, F.col("b") == F.col("n2"))
        smaller = materialize(joined.select(F.least("l1", "l2").alias("a"), F.greatest("l1", "l2").alias("b")).where("a <> b").distinct(), "edges")
        discard(edges)
        edges = smaller
    left = ends if edges is links else edges
    found = materialize(arrow_map(left.coalesce(1), _contracted, "node long, component long"), "components" if not hooks else "labels")
    if edges is not links:
        discard(edges)
    if not hooks:
        return found
    found = found.withColumnRenamed("component", "label")
    for hook in reversed(hooks):
        upper = small(found).select(F.col("node").alias("n"), F.col("label").alias("l"))
        found = materialize(hook.join(upper, F.col("label") == F.col("n"), "left").select("node", F.coalesce("l", "label").alias("label")), "labels")
    least = materialize(found.groupBy("label").agg(F.min("node").alias("component")).withColumnRenamed("label", "l"), "least")
    return materialize(found.join(small(least), F.col("label") == F.col("l")).select("node", "component"), "components")


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of the links of a task and the smallest one that it reaches. Roots hook to their smallest neighbour and
    nodes jump to their roots; two rounds halve the roots of a component at least."""
    ends = [np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]) for batch in batches if batch.num_rows]
    if not ends:
        return
    nodes, at = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
    at = at.reshape(2, -1)
    label = np.arange(len(nodes))
    while (label[at[0]] != label[at[1]]).any():
        one, two = label[at[0]], label[at[1]]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while (label[label] != label).any():
            label = label[label]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[label])], ["node", "component"])


def with_components(rows: DataFrame, components: DataFrame, column: str, out: str) -> DataFrame:
    c = small(components).select(F.col("node").alias("c__node"), F.col("component").alias("c__component"))
    return rows.join(c, F.col(column) == F.col("c__node"), "left").withColumn(out, F.coalesce("c__component", column)).drop("c__node", "c__component")
