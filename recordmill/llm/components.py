"""Connected components of a graph held as a DataFrame of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.staging import stage

FLUSH = 1 << 19  # links that a task gathers before it reduces them


def forest(src: np.ndarray, dst: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each node of the links, a link to the smallest node it reaches (itself left out)."""
    nodes, back = np.unique(np.concatenate([src, dst]), return_inverse=True)
    a, b = back[: len(src)], back[len(src) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label, new.copy())  # roots follow their members
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def reduced(links: DataFrame) -> DataFrame:
    """``src, dst`` with each task's links replaced by stars that connect the same nodes."""

    def run(batches: Iterator[pa.RecordBatch]):
        held, size = [], 0

        def flush():
            a, b = forest(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            size += len(batch)
            if size >= FLUSH:
                out = flush()
                yield out
                held, size = [], 0
        if held:
            yield flush()

    return links.select("src", "dst").mapInArrow(run, "src long, dst long")


def connected_components(links: DataFrame, reduce: bool = True) -> DataFrame:
    """``node, component`` for every node of ``links(src, dst)`` (longs): the smallest node reachable.

    ``reduce`` first replaces each task's links by a forest; pass False for links that are one.

    Alternates large-star and small-star steps until no link changes; each step is one
    aggregate and one join that AQE can split, over tables written to the shared folder.
    Runs jobs when called. Without links the result is empty.
    """
    links = links.where("src <> dst").select("src", "dst")
    links = stage((reduced(links) if reduce else links).distinct(), "links")
    seen = None
    while True:
        both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        # Large star: a node's larger neighbours link to the smallest of it and its neighbours.
        low = stage(both.groupBy("src").agg(F.min("dst").alias("low")), "large")
        large = (
            both.where("dst > src").join(low, "src")
            .select(F.col("dst").alias("src"), F.least("src", "low").alias("dst")).distinct()
        )
        large = stage(large, "large-links")  # src > dst throughout
        # Small star: a node and its smaller neighbours link to the smallest of them.
        low = stage(large.groupBy("src").agg(F.min("dst").alias("low")), "small")
        small = (
            large.join(low, "src").where("dst <> low").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .unionByName(low.select("src", F.col("low").alias("dst"))).distinct()
        )
        links = stage(small, "small-links")
        mark = links.agg(F.count("*"), F.sum(F.xxhash64("src", "dst") % (1 << 40))).first()
        if mark == seen or mark[0] == 0:
            break
        seen = mark
    roots = links.select("dst").distinct().select(F.col("dst").alias("node"), F.col("dst").alias("component"))
    return stage(links.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(roots), "components")
