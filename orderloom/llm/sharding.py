"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

A group is the rows of one text.  Its vector (bytes, tokens, rows) is put into
the shard where its dot product with the residual capacity is highest, both
measured in fair shares, among the shards that it fits into (among all where
it fits into none).  Bytes weigh more in the product: a small text is a larger
share of the rows than of the bytes, and would not see what bytes are missing.  A group of more than ``WHOLE`` of a fair share in some
dimension is split by a hash of its rows into pieces of about that size, else
one text could outweigh a shard; a row is never split.

Scale: what is placed is one row per group, in levels of falling size: level k
holds what lies between 1/64^k and 1/64^(k+1) of a fair share.  Level 0 has a
bounded number of groups and is packed at once; a finer level is dealt by hash
to tasks of about ``TASK_GROUPS`` groups, each with its part of the capacity
that the levels before have left, so every level evens out what the coarser
ones left uneven, and the imbalance ends at the size of the smallest groups.
Only sums by level and shard come to the driver.  Texts are read once, for
their sizes and hashes; rows then get gapless slots by counts per salt.

Defined results: a null text counts as empty text in size, and is a group of
its own; repeated rows are rows of their own, with slots of their own; rows
with a null id are placed by their text like others; ties go to the first
shard in an order that the task rotates; an empty table has no rows.  Extra
columns are ignored or, named in ``keep``, carried along.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut, prepare, release
from orderloom.llm.packing import numbered

STEP = 64                # ratio of the sizes of two levels
WHOLE = 0.25             # largest piece of a group, in fair shares
TASK_GROUPS = 8192       # groups that one task places
SLOT_ROWS = 8192         # rows that one task numbers
DIMS = ["bytes", "tokens", "rows"]
WEIGHTS = [8.0, 1.0, 1.0]   # of the dimensions in the dot product


def fair(vector: list[Column], share: list[float]) -> Column:
    """The largest dimension of a vector, in fair shares."""
    return F.greatest(*[v.cast("double") / F.lit(s) for v, s in zip(vector, share)])


def place(sizes: np.ndarray, residual: np.ndarray) -> list[int]:
    """The shard of each row of ``sizes``, in order; ``residual`` is used up.
    Both in fair shares: ``(groups, dims)`` and ``(shards, dims)``."""
    out = []
    for v in sizes:
        score = residual @ (v * WEIGHTS)
        fits = (residual >= v).all(axis=1)
        if fits.any():
            score[~fits] = -np.inf
        at = int(score.argmax())
        residual[at] -= v
        out.append(at)
    return out


def place_level(items: DataFrame, tasks: int, residual: np.ndarray, share: list[float]) -> DataFrame:
    """``(g1, g2, piece, shard, *DIMS)``: a level's groups, largest first in
    each task; ``residual`` in fair shares is divided among the tasks by what
    they hold."""
    shards = len(residual)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rel", "g1", "g2", "piece"], ascending=[False, True, True, True],
                              kind="stable").reset_index(drop=True)
        sizes = pdf[DIMS].to_numpy(np.float64) / np.array(share)
        turn = int(pdf["task"].iloc[0]) % shards
        room = np.roll(residual, -turn, axis=0) / tasks
        found = (np.array(place(sizes, room)) + turn) % shards
        return pd.DataFrame({"g1": pdf["g1"], "g2": pdf["g2"], "piece": pdf["piece"], "shard": found,
                             **{d: pdf[d] for d in DIMS}})

    task = F.pmod(F.xxhash64("g2", "piece", "g1"), F.lit(tasks))
    return items.withColumn("task", task).groupBy("task").applyInPandas(
        pack, "g1 bigint, g2 bigint, piece bigint, shard bigint, " + ", ".join(f"{d} bigint" for d in DIMS))


def place_groups(items: DataFrame, shards: int, share: list[float]) -> DataFrame:
    """The shard of every group ``items(g1, g2, piece, *DIMS)``."""
    prepare(items.sparkSession)
    rel = fair([F.col(d) for d in DIMS], share)
    level = F.greatest(F.lit(0), F.floor(-F.log(float(STEP), F.col("rel")))).cast("int")
    items = cut(items.withColumn("rel", rel).withColumn("level", level))
    counts = {r["level"]: r["count"] for r in items.groupBy("level").count().collect()}
    residual = np.ones((shards, len(DIMS)))
    placed = []
    for k in sorted(counts):
        tasks = max(1, math.ceil(counts[k] / TASK_GROUPS))
        done = cut(place_level(items.where(F.col("level") == k), tasks, residual.copy(), share))
        for r in done.groupBy("shard").agg(*[F.sum(d).alias(d) for d in DIMS]).collect():
            residual[r["shard"]] -= np.array([r[d] for d in DIMS]) / np.array(share)
        placed.append(done)
    out = placed[0]
    for p in placed[1:]:
        out = out.unionByName(p)
    return out


def shard_documents(docs: DataFrame, shards: int = 16, tokens: Column | None = None,
                    keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text"
                    ) -> DataFrame:
    """Every row's id and the columns ``keep`` as struct ``row``, ``size``
    (UTF-8 bytes and one), ``tokens`` (white-space separated words, or as
    given), ``text_crc32``, ``shard`` and its gapless ``slot`` there."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    if tokens is None:
        tokens = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))
    null = F.col(text_col).isNull()
    rows = cut(docs.select(
        F.struct(*dict.fromkeys([id_col, *(keep or [])])).alias("payload"),
        (F.octet_length(text) + 1).cast("long").alias("size"), tokens.cast("long").alias("tokens"),
        F.crc32(text).alias("text_crc32"), F.xxhash64(null, text).alias("g1"),
        F.xxhash64(text, F.lit(1), null).alias("g2"), F.monotonically_increasing_id().alias("at")))
    groups = cut(rows.groupBy("g1", "g2").agg(
        F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")))
    total = groups.agg(*[F.sum(d).alias(d) for d in DIMS]).first()
    share = [max((total[d] or 0) / shards, 1e-9) for d in DIMS]
    size = fair([F.col(d) for d in DIMS], share)
    groups = groups.withColumn("pieces", F.least("rows", F.ceil(size / F.lit(WHOLE))))
    split = groups.where("pieces > 1").select("g1", "g2", "pieces")
    # Fewer than dims x shards / WHOLE groups can be so large.
    rows = rows.join(F.broadcast(split), ["g1", "g2"], "left").withColumn(
        "piece", F.coalesce(F.pmod(F.xxhash64("at"), F.col("pieces")), F.lit(0).cast("long"))).drop("pieces")
    parts = rows.join(F.broadcast(split.drop("pieces")), ["g1", "g2"], "left_semi").groupBy(
        "g1", "g2", "piece").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                 F.count("*").alias("rows"))
    items = parts.unionByName(groups.where("pieces <= 1").select(
        "g1", "g2", F.lit(0).cast("long").alias("piece"), *DIMS))
    if not total["rows"]:
        placed = items.select("g1", "g2", "piece", F.lit(0).cast("long").alias("shard"))
    else:
        placed = place_groups(items, shards, share).select("g1", "g2", "piece", "shard")
    found = cut(rows.join(placed, ["g1", "g2", "piece"]).select(
        F.col("shard").alias("row"), "payload", "size", "tokens", "text_crc32", "at"))
    release(docs.sparkSession)
    salts = max(1, math.ceil((total["rows"] or 0) / shards / SLOT_ROWS))
    return numbered(found, salts).select(
        F.col("payload").alias("row"), "size", "tokens", "text_crc32",
        F.col("row").cast("int").alias("shard"), F.col("number").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, **names: str) -> None:
    """The rows of ``docs`` as Parquet, a folder a shard, files in slot order.
    Slots are written in ranges of ``SLOT_ROWS``, each by one task."""
    out = shard_documents(docs, shards, keep=docs.columns, **names)
    out = out.withColumn("range", F.expr(f"slot div {SLOT_ROWS}"))
    (out.repartition("shard", "range").sortWithinPartitions("shard", "slot")
     .select(F.col("shard").alias("shard_no"), "slot", F.col("row").alias("document"))
     .write.partitionBy("shard_no").parquet(path))
