"""Groups of near nodes from buckets of candidates, without pairs of a bucket.

Nodes that may be near share a bucket.  Making all pairs of a bucket would
take the square of its size, and a bucket may hold a third of all rows, so:

1. every node is compared with the smallest representative (smallest node) of
   its buckets, and what is near is linked: one comparison for each node;
2. linked nodes are united into components;
3. where buckets still hold several components and would make many pairs, the
   members outside a bucket's largest component meet a new representative of
   it, again one comparison each, as long as that still unites many;
4. what is left outside is paired with the members of the other components
   (``pairs_across``).  Pairs inside one component need no comparison: they
   are connected already.

Step 4 makes the result exact: every pair that shares a bucket is connected or
compared, and none is compared twice.  A cheap necessary condition
(``may_be_near``) is part of its join, so only pairs that pass it leave the
join, to be made distinct and verified.  Its work is the size of a bucket times
the members that were left outside, and the join on the bucket can be split
by adaptive execution.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Folder, cut, release
from orderloom.llm.components import connected_components

PAIRS = 64               # pairs of a member outside that step 4 takes without another round
PROGRESS = 8             # a round that links less than this part of its pairs is the last

Verify = Callable[[DataFrame], DataFrame]
Side = Callable[[str], Column]


def shared_buckets(members: DataFrame, key: list[str], payload: list[str] = []) -> DataFrame:  # noqa: B006
    """``members(*key, node, *payload)`` of the buckets with two nodes or
    more, and each bucket's smallest node (with its payload) as struct ``rep``."""
    reps = (members.groupBy(*key)
            .agg(F.min(F.struct("node", *payload)).alias("rep"), F.max("node").alias("_max"))
            .where("rep.node < _max").drop("_max"))
    return members.join(reps, key)


def mixed_buckets(members: DataFrame, key: list[str], groups: DataFrame) -> DataFrame:
    """The ``members`` of buckets that hold several components of
    ``groups(node, root)``, with their ``comp``, the bucket's largest component
    ``main``, its number of members ``n`` and of those ``outside`` main."""
    placed = (members.join(groups.withColumnRenamed("root", "comp"), "node", "left")
              .withColumn("comp", F.coalesce("comp", "node")))
    per = placed.groupBy(*key, "comp").agg(F.count("*").alias("n"))
    mixed = (per.groupBy(*key).agg(F.count("*").alias("parts"), F.sum("n").alias("n"),
                                   F.max(F.struct("n", "comp")).alias("main"))
             .where("parts > 1").select(*key, F.col("main.comp").alias("main"),
                                        (F.col("n") - F.col("main.n")).alias("outside"), "n"))
    return placed.join(mixed, key)


def pairs_across(mixed: DataFrame, key: list[str], may_be_near: Callable[[Side, Side], Column]) -> DataFrame:
    """The distinct pairs ``(u, v)``, u > v, of members of ``mixed_buckets``
    that share a bucket, lie in two components and may be near."""
    pairs = mixed.where("comp <> main").alias("l").join(
        mixed.alias("r"), [F.col(f"l.{k}") == F.col(f"r.{k}") for k in key])
    once = (F.col("r.comp") == F.col("r.main")) | (F.col("l.node") < F.col("r.node"))
    pairs = pairs.where((F.col("l.comp") != F.col("r.comp")) & once & may_be_near(
        lambda c: F.col(f"l.{c}"), lambda c: F.col(f"r.{c}")))
    return pairs.select(F.greatest("l.node", "r.node").alias("u"), F.least("l.node", "r.node").alias("v")).distinct()


def as_links(groups: DataFrame) -> DataFrame:
    """``groups(node, root)`` as links ``(u, v)``."""
    return groups.select(F.col("node").alias("u"), F.col("root").alias("v"))


def near_groups(members: DataFrame, key: list[str], verify: Verify,
                may_be_near: Callable[[Side, Side], Column] = lambda l, r: F.lit(True)) -> DataFrame:  # noqa: E741
    """``(node, root)`` for every node that is not the smallest of its group.

    ``members`` comes from ``shared_buckets`` and should be a cheap table (it
    is read several times).  ``may_be_near(l, r)`` is a condition of a pair
    from two functions that give a side's ``node`` or payload column, and
    ``verify(pairs(u, v))`` returns the pairs that are near indeed.
    """
    star = members.where("node <> rep.node").where(may_be_near(F.col, lambda c: F.col(f"rep.{c}")))
    star = cut(star.groupBy(F.col("node").alias("u")).agg(F.min("rep.node").alias("v")))
    first = cut(connected_components(verify(star)))
    release(members.sparkSession)
    tested, at, going = star, 0, True
    kept: list[Folder] = []                  # of the tables of mixed buckets, the widest ones
    while True:
        mixed = mixed_buckets(members.drop("rep"), key, first)
        kept.append(Folder(members.sparkSession, "near-groups"))
        mixed = kept[-1].written(mixed)
        if len(kept) > 1:
            kept.pop(0).remove()             # nothing reads the last round's any more
        outside, pairs = mixed.where("comp <> main").agg(F.count("*"), F.sum("n")).first()
        if not outside or pairs <= PAIRS * outside or not going:
            break
        at += 1
        order = F.struct(F.xxhash64("node", F.lit(at)).alias("order"), F.struct("*").alias("of"))
        reps = mixed.where("comp = main").groupBy(*key).agg(F.min(order)["of"].alias("rep"))
        met = mixed.where("comp <> main").join(reps, key).where(
            may_be_near(F.col, lambda c: F.col(f"rep.{c}")))
        met = cut(met.select(F.greatest("node", "rep.node").alias("u"), F.least("node", "rep.node").alias("v"))
                  .distinct().join(tested, ["u", "v"], "left_anti"))
        tested = tested.unionByName(met)
        found = cut(verify(met).select("u", "v"))
        going = found.count() * PROGRESS >= met.count() > 0
        first = cut(connected_components(as_links(first).unionByName(found)))
        release(members.sparkSession)
    untested = cut(pairs_across(mixed, key, may_be_near).join(tested, ["u", "v"], "left_anti"))
    kept.pop().remove()
    release(members.sparkSession)
    return connected_components(as_links(first).unionByName(verify(untested).select("u", "v")))
