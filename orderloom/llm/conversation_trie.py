"""Prefix trie of conversations, with subtree totals by tree contraction.

A node is a distinct sequence of first turns (role, text); the root is the
empty one.  Its members are the conversations that start with it.  The trie
tells what a shared prefix saves: ``saved_tokens`` sums, over a node's
subtree, the bytes of each node's last turn times its members but one.

Turns are numbered by a distributed sort: ranges of (conversation, turn, role,
text) and a running number inside each range, so that a conversation with a
third of all turns lies in many tasks.  A prefix is named by 128 bits, the XOR
of hashes of its (place, turn) pairs, which is worked out in blocks of
``BLOCK`` turns.  Nodes are a grouped count of prefixes (combined before the
shuffle, so a first turn that all share costs nothing); the totals come from
``tree_contraction``, whose rounds do not grow with the length of
conversations.

Defined results: turns are ordered by turn (null first), equal ones by role
and text; null roles and texts are empty; repeated rows are turns of their
own; rows without a conversation id are left out; without conversations there
is no node, not even the root.  Ids divide as in SQL (the remainder takes the
sign of the id).  Texts of any length only meet the first sort and the hashes.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import cut, prepare, release
from orderloom.llm.tree_contraction import subtree_sums

BLOCK = 1024             # turns whose hashes one window combines
ENDS = 4096              # ids of one piece of a list of ends


def numbered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(conv, part, seq, t1, t2, n_bytes)``, turns in order as a checkpoint,
    and ``(conv, part, first, before, n)``: the place of a conversation's
    piece, ``before`` turns of it in earlier parts, ``n`` in all."""
    empty = F.lit("")
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col), empty).alias("role"), F.coalesce(F.col(text_col), empty).alias("text"),
        F.monotonically_increasing_id().alias("at"))
    order = ["conv", "turn", "role", "text"]
    rows = rows.repartitionByRange(*order, "at").sortWithinPartitions(*order)
    rows = cut(rows.select(
        "conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("seq"),
        F.xxhash64("role", "text").alias("t1"), F.xxhash64("text", F.lit(1), "role").alias("t2"),
        F.octet_length("text").cast("long").alias("n_bytes")))
    spans = rows.groupBy("conv", "part").agg(F.min("seq").alias("first"), F.count("*").alias("here"))
    all_of = Window.partitionBy("conv")
    earlier = all_of.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("conv", "part", "first", F.sum("here").over(all_of).alias("n"),
                         F.coalesce(F.sum("here").over(earlier), F.lit(0).cast("long")).alias("before"))
    return rows, cut(spans)


def grafted_turns(conversations: DataFrame, group: int, modulus: int) -> tuple[DataFrame, DataFrame]:
    """Turns ``(conv, depth, t1, t2, n_bytes, last)`` of conversations that are
    rebuilt: the first h turns come from the conversation whose id is that of
    ``conv`` less its remainder by ``group``, the others are the own ones
    after the first h; h is the CRC-32 of the id modulo ``modulus``.  Also
    ``(conv, length)`` of all conversations."""
    rows, spans = numbered_turns(conversations)
    convs = spans.select("conv", "n").distinct().select(
        "conv", "n", (F.crc32(F.col("conv").cast("string")) % modulus).alias("h"),
        (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = convs.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_n", F.lit(0).cast("long")))).drop("base_n")
    convs = cut(convs)
    rows = rows.join(spans.drop("n").join(convs.select("conv", "n", "h", "taken"), "conv"), ["conv", "part"])
    rows = rows.withColumn("place", F.col("before") + F.col("seq") - F.col("first") + 1)
    turn = ["t1", "t2", "n_bytes"]
    own = rows.where("place > h").select("conv", (F.col("place") - F.col("h") + F.col("taken")).alias("depth"),
                                         *turn, (F.col("place") == F.col("n")).alias("last"))
    heads = rows.where((F.col("place") < modulus) & (F.col("conv") % group == 0)).select(
        F.col("conv").alias("base"), "place", *turn)
    taken = convs.join(heads, "base").where("place <= taken").select(
        "conv", F.col("place").alias("depth"), *turn,
        ((F.col("place") == F.col("taken")) & (F.col("n") <= F.col("h"))).alias("last"))
    length = F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0).cast("long"))
    return own.unionByName(taken), convs.select("conv", length.alias("length"))


def prefixes(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The turns with the names ``k1, k2`` of the prefix that ends there and
    ``p1, p2`` of the one before."""
    rows = turns.withColumn("x1", F.xxhash64("depth", "t1", "t2")).withColumn(
        "x2", F.xxhash64("t2", "depth", "t1")).withColumn("block", F.expr(f"(depth - 1) div {block}"))
    inside = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("conv", "block").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    sums = sums.select("conv", "block", F.bit_xor("s1").over(earlier).alias("b1"),
                       F.bit_xor("s2").over(earlier).alias("b2")).where("block > 0")
    zero = F.lit(0).cast("long")
    rows = rows.withColumn("i1", F.bit_xor("x1").over(inside)).withColumn("i2", F.bit_xor("x2").over(inside))
    rows = rows.join(sums, ["conv", "block"], "left")

    def name(i: int) -> Column:
        return F.col(f"i{i}").bitwiseXOR(F.coalesce(f"b{i}", zero))

    return rows.select("conv", "depth", "n_bytes", "last", name(1).alias("k1"), name(2).alias("k2"),
                       name(1).bitwiseXOR(F.col("x1")).alias("p1"),
                       name(2).bitwiseXOR(F.col("x2")).alias("p2"))


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (k1, k2, conv) in order: comma-joined pieces of at most ``ENDS`` ids."""
    for b in batches:
        k1, k2, conv = (c.to_numpy() for c in b.columns)
        starts = np.flatnonzero(np.append(True, (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))) if len(k1) else []
        ids, cuts = conv.tolist(), []
        for a, e in zip(starts, [*starts[1:], len(k1)]):
            cuts += [(at, min(at + ENDS, e)) for at in range(a, e, ENDS)]
        at = np.array([a for a, _ in cuts], int)
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[at]), pa.array(k2[at]), pa.array(conv[at]),
             pa.array([",".join(map(str, ids[a:e])) for a, e in cuts], pa.string())],
            names=["k1", "k2", "first", "ids"])


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (k1, k2, first, ids) in order: the SHA-256 of each key's list.
    Holds one digest, however long the list."""
    key, sha, out = None, None, []

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k, _ in out], pa.int64()) for i in (0, 1)]
            + [pa.array([d for _, d in out], pa.string())], names=["k1", "k2", "ends_sha256"])
    for b in batches:
        for *k, ids in zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
            if k == key:
                sha.update(b"," + ids.encode())
                continue
            if key is not None:
                out.append((key, sha.hexdigest()))
            key, sha = k, hashlib.sha256(ids.encode())
        yield told()
        out.clear()
    if key is not None:
        out.append((key, sha.hexdigest()))
        yield told()


def ends_digest(ends: DataFrame) -> DataFrame:
    """``(k1, k2, ends_sha256)`` of ``ends(k1, k2, conv)``.  Ids are joined
    into pieces by ranges first: one digest must read its list in order, so
    what meets in one task are pieces, as a stream."""
    prepare(ends.sparkSession)
    order = ["k1", "k2", "conv"]
    pieces = (ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
              .mapInArrow(listed, "k1 bigint, k2 bigint, first bigint, ids string"))
    return (pieces.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first")
            .mapInArrow(digested, "k1 bigint, k2 bigint, ends_sha256 string"))


def prefix_trie(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row a node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs`` (members), ``n_children``, ``n_leaves``
    and ``saved_tokens`` of the subtree, ``ends_sha256`` of the ids of the
    conversations that end there.

    ``turns(conv, depth, t1, t2, n_bytes, last)`` holds each conversation's
    turns by depth from 1, as two hashes and a size; ``convs(conv, length)``
    all conversations, those without turns as well.
    """
    rows = cut(prefixes(turns, block))
    zero = F.lit(0).cast("long")
    root = convs.groupBy().agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where(
        "n_convs > 0").select(zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs",
                              zero.alias("n_bytes"), F.lit(None).cast("long").alias("p1"),
                              F.lit(None).cast("long").alias("p2"))
    nodes = rows.groupBy("depth", "k1", "k2").agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.min("n_bytes").alias("n_bytes"),
        F.min("p1").alias("p1"), F.min("p2").alias("p2"))
    nodes = cut(nodes.unionByName(root).withColumn("id", F.monotonically_increasing_id()))
    kids = nodes.groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children"))
    above = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("id").alias("parent"),
                         F.col("conv_id").alias("parent_conv_id"))
    tree = nodes.join(kids, ["k1", "k2"], "left").join(above, ["p1", "p2"], "left").select(
        "id", "parent", "k1", "k2", "conv_id", "depth", "parent_conv_id", "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    tree = cut(tree)
    sums = subtree_sums(tree, ["n_leaves", "saved_tokens"])
    release(turns.sparkSession)
    ends = rows.where("last").select("k1", "k2", "conv").unionByName(
        convs.where("length = 0").select(zero.alias("k1"), zero.alias("k2"), "conv"))
    return (tree.drop("n_leaves", "saved_tokens").join(sums, "id").join(ends_digest(ends), ["k1", "k2"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256")))
