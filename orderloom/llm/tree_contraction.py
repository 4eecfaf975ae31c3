"""Sums over all subtrees of a forest, by parallel tree contraction.

Rounds of joins shrink the forest to its roots.  Each round

* rakes: every leaf goes, and hands what it holds to its parent;
* compresses: of the nodes with one child left, an independent set (by coins
  of a hash: heads, and the child not heads as well) is spliced out of its
  unary chain; the child is linked to the node above and carries what the
  spliced node holds, for whoever is above.

A raked node's sum is final.  A spliced node's sum is what it holds (and what
its child carried by then) plus its child's sum, so the rounds are expanded
again from the last to the first.  A round takes all leaves and, on average, a
quarter of the inner nodes of unary chains or more, so the rounds grow with
the logarithm of the nodes, not with the height: a chain as long as the table
is no trouble.  What remains shrinks from round to round, so the work of all
rounds is a small multiple of the first one's.

A node with any number of children is no trouble either: what they hand up is
combined before it is shuffled, and all joins are on unique ids.  Each round
ends in a table in the shared checkpoint folder, removed at the end.  Only
counts come to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Folder, cut

ALIVE, RAKED, SPLICED = 0, 1, 2


def _round(alive: DataFrame, weights: list[str], coin: int) -> DataFrame:
    """One rake and compress.  ``(id, fate, link, n, weights, c_weights)``: the
    parent of a node that stays, the child of one that was spliced out."""
    zero = F.lit(0).cast("long")
    leaf = (F.col("n") == 0) & F.col("link").isNotNull()
    given = alive.where("link IS NOT NULL").groupBy(F.col("link").alias("id")).agg(
        F.count(F.when(F.col("n") == 0, 1)).alias("raked"),
        F.min(F.when(F.col("n") > 0, F.col("id"))).alias("child"),
        *[F.sum(F.when(F.col("n") == 0, F.col(w) + F.col(f"c_{w}"))).alias(f"g_{w}") for w in weights])
    held = alive.join(given, "id", "left").select(
        "id", "link", leaf.alias("leaf"), (F.col("n") - F.coalesce("raked", zero)).alias("n"), "child",
        *[(F.col(w) + F.coalesce(f"g_{w}", zero)).alias(w) for w in weights],
        *[F.col(f"c_{w}") for w in weights])
    heads = ((F.col("n") == 1) & ~F.col("leaf") & F.col("link").isNotNull()
             & (F.xxhash64("id", F.lit(coin)).bitwiseAND(F.lit(1)) == 1))
    below = held.select(F.col("id").alias("child"), heads.alias("heads"),
                        *[F.col(f"c_{w}").alias(f"u_{w}") for w in weights])
    spliced = held.where(heads).join(below, "child").where(~F.col("heads"))
    updates = spliced.select(F.inline(F.array(
        F.struct(F.col("child").alias("id"), F.lit(False).alias("gone"), F.col("link").alias("to"),
                 *[(F.col(f"u_{w}") + F.col(w) + F.col(f"c_{w}")).alias(f"v_{w}") for w in weights]),
        F.struct(F.col("id"), F.lit(True).alias("gone"), F.col("child").alias("to"),
                 *[(F.col(w) + F.col(f"u_{w}")).alias(f"v_{w}") for w in weights]))))
    gone = F.coalesce("gone", F.lit(False))
    return held.join(updates, "id", "left").select(
        "id", F.when(F.col("leaf"), RAKED).when(gone, SPLICED).otherwise(ALIVE).alias("fate"),
        F.coalesce("to", "link").alias("link"), "n",
        *[F.when(gone, F.col(f"v_{w}")).otherwise(F.col(w)).alias(w) for w in weights],
        *[F.when(F.col("gone") | F.col("gone").isNull(), F.col(f"c_{w}"))
          .otherwise(F.col(f"v_{w}")).alias(f"c_{w}") for w in weights])


def subtree_sums(nodes: DataFrame, weights: list[str]) -> DataFrame:
    """``(id, *weights)``: each weight summed over the subtree of every node.

    ``nodes(id, parent, n_children, *weights)`` is a forest: unique bigint
    ids, null parents at the roots, bigint weights.  An empty table has no
    sums.
    """
    state = nodes.select("id", F.col("parent").alias("link"), F.col("n_children").cast("long").alias("n"),
                         *weights, *[F.lit(0).cast("long").alias(f"c_{w}") for w in weights])
    folder = Folder(nodes.sparkSession, "contraction")
    rounds: list[tuple[DataFrame, int]] = []
    while True:
        state = folder.written(_round(state, weights, len(rounds)))
        left, spliced = state.agg(F.count(F.when((F.col("fate") == ALIVE) & F.col("link").isNotNull(), 1)),
                                  F.count(F.when(F.col("fate") == SPLICED, 1))).first()
        rounds.append((state, spliced))
        state = state.where(F.col("fate") == ALIVE).drop("fate")
        if not left:
            break
    known = state.select("id", *weights)     # the roots
    for log, spliced in reversed(rounds):
        here = log.where(F.col("fate") == RAKED).select("id", *weights)
        if spliced:
            sums = known.select(F.col("id").alias("link"), *[F.col(w).alias(f"s_{w}") for w in weights])
            solved = log.where(F.col("fate") == SPLICED).join(sums, "link").select(
                "id", *[(F.col(w) + F.col(f"s_{w}")).alias(w) for w in weights])
            here = here.unionByName(folder.written(solved))
        known = known.unionByName(here)
    sums = cut(known)
    folder.remove()
    return sums
