"""Line dedup: fuzzy copies of lines by MinHash, one line kept per group.

Lines are the ``\\n``-separated parts of a text that hold more than white
space.  Equal lines share a 64-bit hash, the node.  Every node's normalised
line (lower case, single spaces) gets a MinHash signature of its character
shingles, cut into ``BANDS`` bands of ``ROWS`` values: a pair of similarity 0.8
shares a band with a probability over 0.998.  Lines that share a band are
candidates.  Two necessary conditions of the similarity, on the sizes of the
shingle sets and on ``LANES`` words of parity bits of their shingles, discard
most of them (neither ever discards a similar pair: the bits that differ are at
most the shingles that differ); the exact Jaccard similarity of the whole
shingle sets, shingles named by 64-bit hashes, verifies the others, and a
distributed union-find makes the groups.  Of each group the occurrence with the
smallest (id, line number) stays.

Scale: the texts are shuffled once, to be rebuilt, and the lines once, to meet
the candidates; what else moves are hashes and bits.  Bands are dealt out by
their value and read as a sorted stream, so a band that many lines share costs
no memory.  The stream takes a band in blocks of ``BLOCK`` members, and of a
block only a spanning forest of the pairs that may be similar goes on, the most
alike ones: a pair for each member at most.  They are verified and united; then
the pairs of a band that still lie across components and meet the conditions
are verified too (``pairs_across``), so that every pair that shares a band is
connected or compared.

Defined results: a null text stays null and counts no lines; blank lines stay
where they are; a text whose lines all go is empty; rows equal in id and text
are one document and keep the same lines; null ids sort first; a line shorter
than a shingle is its own shingle; lines of any length are compared whole; an
empty table gives no rows.  Columns of any name are carried inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import Folder, cut, map_slices, release, row_key
from orderloom.llm.components import connected_components
from orderloom.llm.near_groups import Side, as_links, mixed_buckets, pairs_across

SHINGLE = 7
ROWS, BANDS = 4, 13
SIMILARITY = 0.8
BLANK = " \t\r\x0b\x0c"
SEED = 42                # of the node hash; the same as the SQL function's
AT_ONCE = 64             # documents whose lines are hashed at once
SEEN = 200_000           # lines that a task remembers to have hashed
LANES = 16               # 64-bit words of parity bits
BLOCK, ANCHORS = 512, 64 # members of a band compared at once; those that all its blocks share
STREAM = 8192            # members that a task holds at once
HELD = 4_000_000         # shingle hashes that a task keeps between slices
TRAITS = ["size", *[f"b{i}" for i in range(LANES)]]


def normalised(line: str) -> str:
    """Lower case, single spaces."""
    low = line.lower()
    # The only white space that is printable is the space.
    if low.isprintable() and "  " not in low:
        return low.strip(" ")
    return " ".join(low.split())


def shingles(line: str, k: int = SHINGLE) -> set[str]:
    """Shingles of a normalised line; a shorter line is its own shingle."""
    return {line[i:i + k] for i in range(len(line) - k + 1)} or {line}


def similar(x: set[str], y: set[str], similarity: float) -> bool:
    """The exact Jaccard similarity of two sets is ``similarity`` or more."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    common = len(x & y)
    return common >= similarity * (len(x) + len(y) - common)


def shingle_hashes(lines: list[str], k: int, odd: np.integer) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes, to base ``odd`` and of its type, of the shingles of
    all normalised lines, and where each line's begin."""
    padded = [x if len(x) >= k else x.ljust(k, "\0") for x in lines]
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    hashes = np.zeros(len(points) - k + 1, odd.dtype)
    for i in range(k):
        hashes *= odd
        hashes += points[i:len(points) - k + 1 + i]
    ends = np.cumsum(sizes)
    inside = np.ones(len(hashes), bool)      # not across the end of a line
    for i in range(1, k):
        inside[ends[:-1] - i] = False
    return hashes[inside], np.concatenate([[0], np.cumsum(sizes - k + 1)[:-1]])


def parity_bits(lines: list[str], k: int = SHINGLE, lanes: int = LANES) -> tuple[np.ndarray, np.ndarray]:
    """The number of distinct shingles of each normalised line, and the XOR of
    one bit for each of them, ``(len(lines), lanes)`` 64-bit words."""
    hashes, starts = shingle_hashes(lines, k, np.uint64(0x9E3779B97F4A7C15))
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    counts, words = [], []
    for part in np.split(hashes, starts[1:]):
        part = np.unique(part)
        odd = np.bincount((part >> np.uint64(8)).astype(np.int64) % (64 * lanes), minlength=64 * lanes) & 1
        counts.append(len(part))
        words.append(np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8"))
    return np.array(counts, np.int64), np.array(words, np.int64).reshape(-1, lanes)


def shingle_sets(lines: list[str], k: int = SHINGLE) -> list[np.ndarray]:
    """The distinct shingles of each normalised line as sorted 64-bit hashes."""
    if not lines:
        return []
    hashes, starts = shingle_hashes(lines, k, np.uint64(0x9E3779B97F4A7C15))
    return [np.unique(part) for part in np.split(hashes, starts[1:])]


def similar_sets(x: np.ndarray, y: np.ndarray, similarity: float) -> bool:
    """As ``similar``, of two sorted arrays of distinct hashes."""
    if min(len(x), len(y)) < similarity * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort(kind="stable")                 # two sorted runs: a merge
    common = np.count_nonzero(both[1:] == both[:-1])
    return bool(common >= similarity * (len(x) + len(y) - common))


def signatures(lines: list[str], k: int = SHINGLE, n: int = ROWS * BANDS) -> np.ndarray:
    """MinHash values, ``(len(lines), n)``, of normalised lines."""
    hashes, starts = shingle_hashes(lines, k, np.uint32(0x9E3779B1))   # 32 bits: few collide
    for shift, odd in ((15, 0x2C1B3C6D), (12, 0x297A2D39)):
        hashes ^= hashes >> np.uint32(shift)
        hashes *= np.uint32(odd)
    hashes ^= hashes >> np.uint32(15)
    out = np.empty((len(lines), n), np.uint32)
    odd = np.random.default_rng(k).integers(0, 1 << 31, (n, 2), np.uint32)
    mixed = np.empty_like(hashes)
    for j in range(n):
        np.multiply(hashes, odd[j, 0] * np.uint32(2) + np.uint32(1), out=mixed)
        np.bitwise_xor(mixed, odd[j, 1], out=mixed)
        out[:, j] = np.minimum.reduceat(mixed, starts)
    return out


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key of each band of each signature, ``(lines, bands)``."""
    bands = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    keys = np.tile(np.arange(1, bands.shape[1] + 1, dtype=np.uint64), (len(sig), 1))
    for i in range(rows):
        keys = (keys ^ bands[:, :, i]) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def band_rows(docs: DataFrame) -> DataFrame:
    """``(key, node)`` for every band of every line of ``docs(text)``."""
    def setup():
        from xxhash import xxh64_intdigest
        seen: set[int] = set()               # a line in many documents goes out once a task

        def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            lines = list(dict.fromkeys(x for t in b.column("text").to_pylist() if t
                                       for x in t.split("\n") if x.strip(BLANK)))
            node = [xxh64_intdigest(x.encode(), SEED) for x in lines]
            new = [(x, n) for x, n in zip(lines, node) if n not in seen]
            if len(seen) + len(node) > SEEN:
                seen.clear()
            seen.update(node)
            if new:
                node = np.array([n for _, n in new], np.uint64).view(np.int64)
                keys = band_keys(signatures([normalised(x) for x, _ in new]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(node, keys.shape[1]))],
                    names=["key", "node"])
        return f

    return map_slices(docs, "key bigint, node bigint", setup, AT_ONCE)


def shared_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by key: the members of keys with two nodes or more, each
    with the key's first node.  Holds one batch and one row.  Where the nodes of
    a key are not sorted, a node that was given twice may come twice."""
    key0 = node0 = None      # the key that the last batch ended with, its first node
    told = False             # whether that node has been given out
    for b in batches:
        key, node = b.column(0).to_numpy(), b.column(1).to_numpy()
        if key0 is not None:
            key, node = np.insert(key, 0, key0), np.insert(node, 0, node0)
        if not len(key):
            continue
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
        if key0 is not None and told:   # a repeat of the first node looks fresh later on
            fresh[1:] &= ~((key[1:] == key0) & (node[1:] == node0))
        key, node = key[fresh], node[fresh]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        at = np.flatnonzero(first)
        sizes = np.diff(np.append(at, len(key)))
        rep, shared = np.repeat(node[at], sizes), np.repeat(sizes > 1, sizes)
        carried = key0 is not None and told
        if carried:
            shared[0] = False
        if shared.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[shared]), pa.array(node[shared]), pa.array(rep[shared])],
                names=["key", "node", "rep"])
        told = bool(sizes[-1] > 1) or (carried and len(at) == 1)
        key0, node0 = key[-1], rep[-1]


def line_traits(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, line, size, b0, b1, ...)`` of the lines of ``docs(text)`` in
    ``nodes``: the line, the size of its shingle set and the words of its
    parity bits."""
    lines = occurrences(docs).select("node", "line").join(nodes, "node", "left_semi").dropDuplicates(["node"])

    def setup():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            size, words = parity_bits([normalised(x) for x in b.column("line").to_pylist()])
            return pa.RecordBatch.from_arrays(
                [b.column("node"), b.column("line"), pa.array(size),
                 *[pa.array(np.ascontiguousarray(w)) for w in words.T]], names=["node", "line", *TRAITS])
        return f

    return map_slices(lines, "node bigint, line string, " + ", ".join(f"{c} bigint" for c in TRAITS), setup)


def differing_bits(l: Side, r: Side) -> Column:  # noqa: E741
    """How many parity bits differ."""
    return sum(((F.bit_count(l(f"b{i}").bitwiseXOR(r(f"b{i}")))) for i in range(LANES)), F.lit(0))


def may_be_similar(l: Side, r: Side, similarity: float) -> Column:  # noqa: E741
    """Necessary conditions of a Jaccard similarity: the smaller set has its
    share of the larger one, and the parity bits that differ, never more than
    the shingles that do, are few enough.  (A thousandth more than the bound
    is let through, for the rounding of the share.)"""
    sizes = l("size") + r("size")
    share = F.least(l("size"), r("size")) >= similarity * F.greatest(l("size"), r("size")) - 0.001
    return share & (differing_bits(l, r) <= sizes * ((1 - similarity) / (1 + similarity)) + 0.001)


def forests(size: np.ndarray, words: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A spanning forest of the pairs that may be similar, the most alike ones
    first (Prim), of each of several blocks of one length: ``size`` is
    ``(blocks, members)``, ``words`` has the parity words.  Returns block,
    member and member of each pair."""
    blocks, n = size.shape
    words = words.view(np.uint64)            # of a negative word, its magnitude's bits would be counted
    every = np.arange(blocks)
    gap = np.full((blocks, n), np.inf)       # between each member and its block's tree
    near = np.zeros((blocks, n), np.int64)   # the member of the tree that it lies next to
    inside = np.zeros((blocks, n), bool)
    now, out = np.zeros(blocks, np.int64), []
    for _ in range(n - 1):
        inside[every, now] = True
        mine = size[every, now][:, None]
        both = size + mine
        differ = np.bitwise_count(words ^ words[every, now][:, None]).sum(axis=2, dtype=np.int64)
        may = ((np.minimum(size, mine) >= similarity * np.maximum(size, mine) - 0.001)
               & (differ <= both * ((1 - similarity) / (1 + similarity)) + 0.001))
        closer = np.where(may, differ / both, np.inf)
        better = closer < gap
        gap[better] = closer[better]
        near[better] = np.broadcast_to(now[:, None], (blocks, n))[better]
        free = np.where(inside, np.inf, gap)
        place = free.argmin(axis=1)
        linked = free[every, place] < np.inf
        out.append((every[linked], near[every, place][linked], place[linked]))
        now = np.where(linked, place, inside.argmin(axis=1))     # else a new tree
    return tuple(np.concatenate(x) for x in zip(*out))


def block_pairs(key: np.ndarray, node: np.ndarray, size: np.ndarray, words: np.ndarray,
                similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs ``(u, v)`` of the forests of all bands of rows sorted by key, long
    bands in blocks that begin with the band's first ``ANCHORS`` members."""
    starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    by_size: dict[int, list[np.ndarray]] = {}
    for at, n in zip(starts.tolist(), np.diff(np.r_[starts, len(key)]).tolist()):
        step = n if n <= BLOCK else BLOCK - ANCHORS
        for i in range(0, n, step):
            rows = np.arange(at + i, at + min(i + step, n))
            if i:
                rows = np.r_[at:at + ANCHORS, rows]
            if len(rows) > 1:
                by_size.setdefault(len(rows), []).append(rows)
    u, v = [], []
    for n, blocks in by_size.items():
        some = max(1, STREAM // n)
        for i in range(0, len(blocks), some):
            rows = np.array(blocks[i:i + some])
            block, a, b = forests(size[rows], words[rows], similarity)
            u.append(node[rows[block, a]])
            v.append(node[rows[block, b]])
    u, v = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (u, v))
    return np.maximum(u, v), np.minimum(u, v)


def likely_pairs(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """From rows (key, node, size, b0, ...) sorted by key: the pairs ``(u, v)``
    of each band's forests.  Holds ``STREAM`` rows or a few more; of a band
    that goes on, its first members stay."""
    def pairs(rows: np.ndarray) -> pa.RecordBatch:
        u, v = block_pairs(rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3:], similarity)
        return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

    held: list[np.ndarray] = []
    for b in batches:
        held.append(np.column_stack([c.to_numpy() for c in b.columns]))
        if sum(map(len, held)) >= STREAM:
            rows = np.concatenate(held)
            last = int(np.searchsorted(rows[:, 0], rows[-1, 0]))     # where the band that may go on begins
            if len(rows) - last < BLOCK:
                done, held = rows[:last], [rows[last:]]
            else:
                done, held = rows, [rows[last:last + ANCHORS]]
            if len(done):
                yield pairs(done)
    if held:
        yield pairs(np.concatenate(held))


def similar_pairs(traits: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """The pairs of nodes ``(u, v)`` whose lines reach the exact similarity."""
    both = (pairs.join(traits.select(F.col("node").alias("u"), F.col("line").alias("a")), "u")
            .join(traits.select(F.col("node").alias("v"), F.col("line").alias("b")), "v"))

    def setup():
        sets: dict[int, np.ndarray] = {}     # of the lines compared last
        held = 0

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            nonlocal held
            u, v = b.column("u").to_pylist(), b.column("v").to_pylist()
            if held > HELD:
                sets.clear()
                held = 0
            new = {n: i for side in (u, v) for i, n in enumerate(side) if n not in sets}
            texts = {n: b.column("a" if u[i] == n else "b")[i].as_py() for n, i in new.items()}
            for n, hashes in zip(texts, shingle_sets([normalised(x) for x in texts.values()])):
                sets[n] = hashes
                held += len(hashes)
            near = [similar_sets(sets[x], sets[y], similarity) for x, y in zip(u, v)]
            return b.select(["u", "v"]).filter(pa.array(near, pa.bool_()))
        return f

    return map_slices(both.select("u", "v", "a", "b"), "u bigint, v bigint", setup)


def occurrences(docs: DataFrame) -> DataFrame:
    """``(id, doc, line_no, line, node)`` of every line with more than blanks."""
    keep = [c for c in ("id", "doc") if c in docs.columns]
    return (docs.select(*keep, F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
            .where(F.btrim("line", F.lit(BLANK)) != "")
            .withColumn("node", F.xxhash64("line")))


def line_groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(node, root)`` of the lines of ``docs(text)`` that are fuzzy copies."""
    spark, texts = docs.sparkSession, docs.select("text")
    rows = band_rows(texts)
    # Sorted by the one column only, which Spark does by radix.
    members = cut(rows.repartition("key").sortWithinPartitions("key")
                  .mapInArrow(shared_runs, "key bigint, node bigint, rep bigint")
                  .select("key", "node").distinct())
    release(spark)
    traits = Folder(spark, "line-traits")
    of = traits.written(line_traits(texts, members.select("node").distinct()))
    release(spark)
    bits = of.select("node", *TRAITS)
    tested = (members.join(bits, "node").select("key", "node", *TRAITS)
              .repartition("key").sortWithinPartitions("key")
              .mapInArrow(lambda b: likely_pairs(b, similarity), "u bigint, v bigint"))
    tested = cut(tested.distinct())
    release(spark)
    groups = connected_components(similar_pairs(of, tested, similarity))
    mixed = traits.written(mixed_buckets(members, ["key"], groups).join(bits, "node"))
    # Read back as columns that may be null: a test of nulls for every word would
    # make the join's code too long to be compiled.
    mixed = mixed.withColumns({c: F.coalesce(c, F.lit(0)) for c in TRAITS})
    across = pairs_across(mixed, ["key"], lambda l, r: may_be_similar(l, r, similarity))  # noqa: E741
    across = cut(across.join(tested, ["u", "v"], "left_anti"))
    found = cut(similar_pairs(of, across, similarity))
    traits.remove()
    release(spark)
    if not found.count():
        return groups
    return connected_components(as_links(groups).unionByName(found))


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` (text as it was), with the new
    ``text`` and the counts ``n_lines`` and ``n_dropped``."""
    key = row_key(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("doc"))
    groups = cut(line_groups(rows, similarity))
    release(docs.sparkSession)
    # Dealt out once, for both the first occurrences and those that go; both read the same columns.
    lines = occurrences(rows).select("id", "doc", "line_no", "node").repartition("node")
    firsts = (lines.groupBy("node").agg(F.min(F.struct("id", "doc", "line_no")).alias("first"),
                                        F.count("*").alias("n"))
              .join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")))
    best = (firsts.groupBy("root").agg(F.min("first").alias("kept"), F.sum("n").alias("n"))
            .where("n > 1").select("root", "kept"))
    repeated = firsts.join(best, "root").select("node", "kept")
    dropped = (lines.join(repeated, "node")
               .where((F.col("doc") != F.col("kept.doc")) | (F.col("line_no") != F.col("kept.line_no"))
                      | ~F.col("id").eqNullSafe(F.col("kept.id")))
               .groupBy("doc").agg(F.collect_set("line_no").alias("dropped")))
    whole = docs.select(F.struct("*").alias("row"), key.alias("doc"))
    joined = whole.join(dropped, "doc", "left").select("row", "dropped")

    def setup():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column("row").field(text_col).to_pylist()
            out: list[list] = [[], [], []]
            for text, gone in zip(texts, b.column("dropped").to_pylist()):
                gone = set(gone or ())
                lines = text.split("\n") if text is not None else []
                out[0].append("\n".join(x for i, x in enumerate(lines) if i not in gone)
                              if gone else text)
                out[1].append(sum(1 for x in lines if x.strip(BLANK)))
                out[2].append(len(gone))
            return pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()),
                 pa.array(out[2], pa.int64())], names=["row", "text", "n_lines", "n_dropped"])
        return f

    kind = whole.schema["row"].dataType.simpleString()
    return map_slices(joined, f"row {kind}, text string, n_lines bigint, n_dropped bigint", setup)
