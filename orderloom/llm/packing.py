"""Conflict-constrained best-fit packing of documents into bins.

Documents longer than ``capacity`` are cut into full pieces and a rest.  Full
pieces fill a bin each; the rests are packed best-fit, longest first: of the
open bins with room enough the one with the smallest residual is taken whose
source and cluster bitmaps do not conflict with the piece.  Bins are ordered
by residual; the search starts at the successor of the piece's size and goes
on until a compatible bin is found, else a new bin opens.  A bin holds at most
one piece of a source and one of a duplicate cluster.

Scale: only ids, sizes and hashes move.  Equal rows get running numbers
(counted per salt, then added up), and pieces are dealt by a hash of row and
number to shards of about ``SHARD_ROWS`` pieces, whose number follows the
input, so that a source, a cluster or a repeated row that holds a third of all
rows is spread over all shards; each shard is packed in one task and bins never span shards, which
costs a shard's few half-empty last bins.  The order inside a shard is fixed
by size and ids, so a rerun packs alike.

Defined results: a null or empty text has size 0 and is packed like any other
(one piece); null sources do not conflict; rows equal in all columns are
separate pieces of one cluster; null ids stay.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import cut, prepare, row_key

CAPACITY = 8192          # units of size (bytes, for the queries) of a bin
SHARD_ROWS = 8192        # pieces packed together


def best_fit(pieces: Iterable[tuple[int, int | None, int]], capacity: int
             ) -> Iterator[tuple[int, int]]:
    """``(bin, offset)`` for each ``(size, source, cluster)``, in order.

    Sources and clusters become bits; open bins are sorted by (residual,
    bin), and each carries the bitmaps of what it holds.
    """
    bits: tuple[dict, dict] = ({}, {})
    open_bins: list[tuple[int, int]] = []
    sources: list[int] = []
    clusters: list[int] = []
    for size, source, cluster in pieces:
        s = 0 if source is None else 1 << bits[0].setdefault(source, len(bits[0]))
        c = 1 << bits[1].setdefault(cluster, len(bits[1]))
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (sources[b] & s or clusters[b] & c):
                break
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
        else:
            residual, b = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        yield b, capacity - residual
        sources[b] |= s
        clusters[b] |= c
        insort(open_bins, (residual - size, b))


def numbered(rows: DataFrame, salts: int) -> DataFrame:
    """``rows(row, at, ...)`` with ``number``: 0, 1, ... among those of equal
    ``row``.  ``at`` is unique; no task takes all rows of a key."""
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("at"), F.lit(salts)))
    before = Window.partitionBy("row").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("row", "salt").agg(F.count("*").alias("n")).select(
        "row", "salt", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("before"))
    place = F.row_number().over(Window.partitionBy("row", "salt").orderBy("at")) - 1
    return (rows.withColumn("place", place).join(offsets, ["row", "salt"])
            .withColumn("number", F.col("before") + F.col("place")).drop("salt", "place", "before", "at"))


def pack(docs: DataFrame, size: Column, cluster: Column, capacity: int = CAPACITY,
         shard_rows: int = SHARD_ROWS, id_col: str = "doc_id", source_col: str = "source"
         ) -> DataFrame:
    """``(id, piece, start, size, shard, bin, offset, bin_id)`` for every piece
    of every row: ``start`` is its place in the document, ``offset`` in the
    bin, and ``bin_id`` names the bin among all shards.  A full piece has a
    bin of its own, named by its row and the row's number among equal ones."""
    kind = docs.schema[id_col].dataType.simpleString()
    # As strings, ids with nulls among them pass through pandas unharmed.
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(source_col).cast("string").alias("source"),
                       size.cast("long").alias("total"), cluster.cast("long").alias("cluster"))
    rows = rows.withColumn("row", row_key("id", "source", "total", "cluster"))
    rows = cut(rows.withColumn("at", F.monotonically_increasing_id()))
    full = F.floor(F.col("total") / F.lit(capacity)).cast("long")
    rows = cut(numbered(rows, max(1, -(-rows.count() // shard_rows))))
    rows = rows.withColumn("full", full).withColumn("rest", F.col("total") - F.col("full") * capacity)

    rests = rows.where("rest > 0 OR full = 0")
    shards = max(1, -(-rests.count() // shard_rows))
    rests = rests.withColumn("shard", F.pmod(F.xxhash64("row", "number"), F.lit(shards)).cast("long"))

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["rest", "id", "row", "number"], ascending=[False, True, True, True],
                              kind="stable").reset_index(drop=True)
        sources = [None if x is None or x != x else x for x in pdf["source"]]
        placed = list(best_fit(zip(pdf["rest"].tolist(), sources, pdf["cluster"].tolist()), capacity))
        return pd.DataFrame({"id": pdf["id"], "piece": pdf["full"], "start": pdf["full"] * capacity,
                             "size": pdf["rest"], "shard": pdf["shard"],
                             "bin": [b for b, _ in placed], "offset": [o for _, o in placed]})

    prepare(docs.sparkSession)
    packed = rests.groupBy("shard").applyInPandas(
        pack_shard, "id string, piece bigint, start bigint, size bigint, shard bigint, bin bigint, "
                    "offset bigint")
    packed = packed.withColumn("bin_id", F.concat_ws("-", F.lit("s"), "shard", "bin"))
    whole = rows.where("full > 0").select("id", "row", "number", F.explode(F.sequence(
        F.lit(0).cast("long"), F.col("full") - 1)).alias("piece"))
    whole = whole.select(
        "id", "piece", (F.col("piece") * capacity).alias("start"), F.lit(capacity).cast("long").alias("size"),
        F.lit(None).cast("long").alias("shard"), F.lit(None).cast("long").alias("bin"),
        F.lit(0).cast("long").alias("offset"),
        F.concat_ws("-", F.lit("f"), F.lower(F.hex("row")), "number", "piece").alias("bin_id"))
    pieces = packed.unionByName(whole)
    return pieces.select(F.col("id").cast(kind).alias(id_col), *[c for c in pieces.columns if c != "id"])
