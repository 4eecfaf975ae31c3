"""SimHash near-dedup with pivot distance tables.

A document's fingerprint is the bitwise majority of the XXH64 hashes of its
word shingles.  Documents of equal fingerprints are one node.  Nodes at a
Hamming distance of at most ``max_bits`` are linked, and groups are the
connected components.

Candidates come from blocks: the 64 bits are cut into ``max_bits + 3`` blocks;
two fingerprints that differ in ``max_bits`` bits agree on three blocks at
least, so each node stands in the bucket of every choice of three blocks, and
no link is missed.  For each node the distances to ``PIVOTS`` fixed reference
fingerprints are worked out beforehand; a candidate pair whose distances to
some pivot differ by more than ``max_bits`` is discarded (by the triangle
inequality it cannot be near), and the survivors are verified bit by bit.
``near_groups`` compares no two members of a bucket that are connected.

Defined results: a null or blank text has fingerprint zero, which is linked
like any other; repeated rows share a group; rows with a null id take part
but never give a group its id, and a group of such rows only has a null id.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut, map_slices, row_key
from orderloom.llm.near_groups import near_groups, shared_buckets

PIVOTS = 16
SEED = 42
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
AT_ONCE = 1 << 16        # hashes whose bits are counted at once


def fingerprint(text: str | None, shingle: int) -> int:
    """64-bit SimHash of the word shingles, as an unsigned integer."""
    from xxhash import xxh64_intdigest
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    last = ends[shingle - 1:] or ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(last), AT_ONCE):
        hashes = np.array([xxh64_intdigest(joined[s:e - 1], SEED) for s, e in
                           zip(starts[at:at + AT_ONCE], last[at:at + AT_ONCE])], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64)
        full = len(bits) // 255 * 255       # sums of 255 bits fit in a byte
        counts += bits[:full].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[full:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(last), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """``(id, fp)``: the fingerprint as a (signed) bigint."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def setup():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            return pa.RecordBatch.from_arrays([b.column("id"), pa.array(fps.view(np.int64))],
                                              names=["id", "fp"])
        return f

    return map_slices(rows, f"id {id_type}, fp bigint", setup)


def block_masks(max_bits: int) -> list[int]:
    """Masks (signed) of every choice of three out of ``max_bits + 3`` blocks."""
    n = max_bits + 3
    edges = [round(64 * i / n) for i in range(n + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    masks = [x | y | z for x, y, z in combinations(blocks, 3)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def pivots(n: int = PIVOTS) -> list[int]:
    """Reference fingerprints (signed): consecutive values of a mixing function."""
    out = []
    for i in range(1, n + 1):
        z = i * 0x9E3779B97F4A7C15 % (1 << 64)
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % (1 << 64)
        z = (z ^ z >> 27) * 0x94D049BB133111EB % (1 << 64)
        z ^= z >> 31
        out.append(z - (1 << 64) if z >> 63 else z)
    return out


def pivot_table(fp: Column) -> Column:
    """The distances to all pivots, a byte each, in an array of bigints."""
    lanes = [F.bit_count(fp.bitwiseXOR(F.lit(p))).cast("long") for p in pivots()]
    packed = []
    for at in range(0, len(lanes), 8):
        word = lanes[at]
        for k, lane in enumerate(lanes[at + 1:at + 8], 1):
            word = word.bitwiseOR(F.shiftleft(lane, 8 * k))
        packed.append(word)
    return F.struct(*[w.alias(f"p{i}") for i, w in enumerate(packed)])


def near_by_pivots(a: Column, b: Column, max_bits: int) -> Column:
    """No coordinate of two pivot tables differs by more than ``max_bits``."""
    ok = F.lit(True)
    for i in range(PIVOTS):
        lane = lambda t: F.shiftrightunsigned(t[f"p{i // 8}"], 8 * (i % 8)).bitwiseAND(F.lit(255))  # noqa: E731, B023
        ok = ok & (F.abs(lane(a) - lane(b)) <= max_bits)
    return ok


def fingerprint_groups(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(node, root)`` of the distinct fingerprints ``fps(node)`` that are
    not the smallest of their component."""
    masks = block_masks(max_bits)
    key = ["choice", "bits"]
    tabled = fps.withColumn("table", pivot_table(F.col("node")))
    members = tabled.select("node", "table", F.inline(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.col("node").bitwiseAND(F.lit(m)).alias("bits"))
        for i, m in enumerate(masks)])))
    members = cut(shared_buckets(members, key, ["table"]))
    return near_groups(
        members, key, lambda pairs: pairs,
        lambda l, r: (near_by_pivots(l("table"), r("table"), max_bits)  # noqa: E741
                      & (F.bit_count(l("node").bitwiseXOR(r("node"))) <= max_bits)))


def components(rows: DataFrame, max_bits: int) -> DataFrame:
    """``(fp, root)`` for every fingerprint in ``rows(fp)``."""
    nodes = rows.select(F.col("fp").alias("node")).distinct()
    roots = fingerprint_groups(nodes, max_bits)
    return nodes.join(roots, "node", "left").select(
        F.col("node").alias("fp"), F.coalesce("root", "node").alias("root"))


def group_documents(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(id, fingerprint, component_id)`` of every row of ``docs``:
    the fingerprint in 16 hex digits and the smallest id of its group."""
    rows = cut(fingerprints(docs, shingle, id_col, text_col))
    per = rows.groupBy("fp").agg(F.min("id").alias("first")).join(components(rows, max_bits), "fp")
    firsts = per.groupBy("root").agg(F.min("first").alias("component_id"))
    ids = per.join(firsts, "root").select("fp", "component_id")
    return rows.join(ids, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def with_clusters(docs: DataFrame, keep: list[Column], shingle: int = 3, max_bits: int = 3,
                  text_col: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, and its group as bigint ``cluster``."""
    keyed = docs.select(F.col(text_col).alias("text"), F.struct(*keep).alias("place"))
    rows = cut(fingerprints(keyed, shingle, "place", "text"))
    return rows.join(components(rows, max_bits), "fp").select("id.*", F.col("root").alias("cluster"))


def one_of_each(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each group: that of the smallest id (a null
    id last) and, among rows of that id, of the smallest row hash.

    Keys decide; the texts move once, to meet the keys that stay.
    """
    key = row_key(*docs.columns)
    keyed = docs.select(F.col(text_col).alias("text"), F.struct(
        F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), key.alias("key")).alias("place"))
    rows = cut(fingerprints(keyed, shingle, "place", "text"))
    per = rows.groupBy("fp").agg(F.min("id").alias("first")).join(components(rows, max_bits), "fp")
    stay = per.groupBy("root").agg(F.min("first")["key"].alias("_key")).select("_key")
    return (docs.withColumn("_key", key).join(stay, "_key", "left_semi")
            .dropDuplicates(["_key"]).select(*docs.columns))
