"""Connected components of an edge table, by distributed union-find.

Every task first merges the edges it holds with a local union-find and passes
on one link from each node to its local root.  Then large-star and small-star
rounds alternate: each node hands the smallest node of its neighbourhood to
its larger, then to its smaller neighbours, until no link changes, or until so
few links are left (``AT_ONCE``, counted) that one task merges them: a round
costs a dozen exchanges, however few the links.  Each round ends in a reliable
checkpoint, so lost executors cost one round at most.

A hub that many edges share is no trouble: minima are combined before they
are shuffled, and the joins on the node are equi-joins that adaptive execution
splits.  Only counts and one checksum come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut

MAX_ROUNDS = 60
AT_ONCE = 100_000        # links that a task merges at once (1.6 MB)


def joined(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches, put together to ``rows`` rows or a little more."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links ``(u, v)``, u > v, from each node of a task's edges to its root.

    Emits the links of every ``AT_ONCE`` edges on their own, so memory is bounded.
    """
    for b in joined(batches, AT_ONCE):
        u, v = b.column(0).to_numpy(), b.column(1).to_numpy()
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        parent = np.arange(len(nodes))
        a, c = at[:len(u)], at[len(u):]
        while True:               # nodes are sorted: the smaller place is the smaller node
            ra, rc = parent[a], parent[c]
            low, high = np.minimum(ra, rc), np.maximum(ra, rc)
            open_ = low != high
            if not open_.any():
                break
            np.minimum.at(parent, high[open_], low[open_])
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
        moved = parent != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[moved]), pa.array(nodes[parent[moved]])],
                                         names=["u", "v"])


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star round over links with u > v."""
    if large:   # larger neighbours of a node go to its smallest neighbour or itself
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        flat = links.join(least.select(F.col("u").alias("n"), "m"), F.col("v") == F.col("n"), "left")
        out = flat.select("u", F.coalesce("m", "v").alias("v"))
    else:       # a node and its smaller neighbours go to the smallest of them
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        joined = links.join(least, "u")
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def connected_components(edges: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)`` (bigint) that is not
    the smallest of its component; ``root`` is that smallest node.

    Null ends and loops are ignored; repeated edges do no harm.  At most
    ``at_once`` links, counted before, are merged by one task (0: none).
    """
    at_once = min(at_once, AT_ONCE)
    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = cut(links.mapInArrow(local_roots, "u bigint, v bigint").distinct())
    seen = None
    for _ in range(MAX_ROUNDS):
        mark = links.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if mark == seen or mark["n"] == 0:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        if mark["n"] <= at_once:
            links = cut(links.coalesce(1).mapInArrow(local_roots, "u bigint, v bigint"))
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
        links = cut(_star(_star(links, large=True), large=False))
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
