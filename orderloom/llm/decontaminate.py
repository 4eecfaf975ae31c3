"""Benchmark decontamination by winnowing.

Words of a text are hashed, ``GRAM`` consecutive words make a gram, and of
every ``window - GRAM + 1`` consecutive grams the smallest hash is kept.  Two
texts that share ``window`` words share such a whole run of grams, hence its
smallest: the join of kept fingerprints finds every shared span of ``window``
words.  Items shorter than a window have no such guarantee, so their whole
text is one fingerprint, looked up at every word of the documents.

Every hit is extended word by word, to the left and to the right, on the words
themselves; a span of ``window`` words (or a whole shorter item) makes its
words hit and its item occur.  Hash collisions therefore change no result.

Scale: documents are read twice and shuffled once, with the hits of each.
The benchmark's fingerprints are counted first: where they are small, they are
sent to the tasks, and documents give out matching fingerprints only;
otherwise all kept fingerprints are joined by a shuffle, in which adaptive
execution splits a frequent one.

Defined results: a null text has no words; items without words, null items and
null item ids match nothing; repeated items count once by id; rows equal in id
and text get equal results; a document without words is not contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import BROADCAST_BYTES, cut, map_slices, row_key

WINDOW = 13              # words of a span that counts as contamination
GRAM = 5                 # words of a fingerprint
AT_ONCE = 64             # documents whose words are hashed at once

# Word bytes: digits, letters and all of UTF-8 beyond ASCII; A-Z become a-z
# and everything else a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128
              else 32 for c in range(256))
ODD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TABLE).split()


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of ODD and of its inverse, modulo 2**64."""
    inverse = np.uint64(pow(int(ODD), -1, 1 << 64))
    up, down = np.full(n, ODD), np.full(n, inverse)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


class WordHashes:
    """Hashes of the words of several texts, worked out over one buffer."""

    def __init__(self):
        self.up, self.down = powers(1 << 16)

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes, text after text, and the words of each text."""
        encoded = [(t or "").encode() for t in texts]
        raw = b" ".join(encoded).translate(TABLE) + b" "
        if len(raw) > len(self.up):
            self.up, self.down = powers(2 * len(raw))
        data = np.frombuffer(raw, np.uint8)
        inside = np.concatenate([[False], data != 32])
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        starts, ends = edge[::2], edge[1::2]
        total = np.cumsum(data * self.up[:len(data)], dtype=np.uint64)
        total = np.concatenate([np.zeros(1, np.uint64), total])
        hashes = (total[ends] - total[starts]) * self.down[starts] + (ends - starts).astype(np.uint64)
        hashes ^= hashes >> np.uint64(31)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        sizes = np.fromiter((len(e) + 1 for e in encoded), np.int64, len(texts))
        counts = np.diff(np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)])))
        return hashes, counts


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on (none for the last k - 1)."""
    n = max(0, len(words) - k + 1)
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = (out + words[i:n + i]) * ODD
    return out ^ (out >> np.uint64(29))


def winnowed(grams: np.ndarray, run: int) -> np.ndarray:
    """Places of grams that are the smallest of some ``run`` consecutive ones
    (ties all count; fewer grams than a run are one run)."""
    if len(grams) <= run:
        return np.flatnonzero(grams == grams.min()) if len(grams) else np.empty(0, np.int64)
    n = len(grams) - run + 1
    low = grams[:n].copy()                   # the smallest of the run from each place on
    for i in range(1, run):
        np.minimum(low, grams[i:n + i], out=low)
    top = np.zeros(len(grams), np.uint64)    # the largest of these, over a place's runs
    for i in range(run):
        np.maximum(top[i:n + i], low, out=top[i:n + i])
    return np.flatnonzero(grams == top)


def fingerprint_places(words: np.ndarray, counts: np.ndarray, window: int,
                       ) -> tuple[np.ndarray, np.ndarray]:
    """Kept fingerprints of several texts: places in ``words`` and hashes.

    Grams across the end of a text are the largest number, so that no run
    keeps one unless it has no other."""
    grams = gram_hashes(words, GRAM)
    last = np.uint64(0xFFFFFFFFFFFFFFFF)
    ends = np.cumsum(counts)
    for i in range(1, GRAM):
        at = ends[:-1] - i
        grams[at[(at >= 0) & (at < len(grams))]] = last
    places = winnowed(grams, window - GRAM + 1)
    places = places[grams[places] != last]
    return places, grams[places]


def item_fingerprints(items: DataFrame, window: int) -> DataFrame:
    """``(hash, size, place, whole, item_id, item)`` of ``items(item_id,
    item)``: ``size`` is the words of the gram; where the item is shorter than
    a window, the gram is the ``whole`` item."""
    def setup():
        hasher = WordHashes()

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column("item").to_pylist()
            out: list[tuple] = []
            short = [False] * len(texts)
            for row, text in enumerate(texts):
                words, _ = hasher([text])
                n = len(words)
                if 0 < n < window:
                    short[row] = True
                    out.append((int(gram_hashes(words, n)[0]), n, 0, row))
                elif n:
                    places, hashes = fingerprint_places(words, np.array([n]), window)
                    out += [(int(h), GRAM, int(p), row) for p, h in zip(places, hashes)]
            rows = pa.array([r for *_, r in out], pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(np.array([h for h, *_ in out], np.uint64).view(np.int64)),
                 pa.array([k for _, k, *_ in out], pa.int32()),
                 pa.array([p for _, _, p, _ in out], pa.int32()),
                 pa.array([short[r] for *_, r in out], pa.bool_()),
                 b.column("item_id").take(rows), b.column("item").take(rows)],
                names=["hash", "size", "place", "whole", "item_id", "item"])
        return f

    return map_slices(items, "hash bigint, size int, place int, whole boolean, item_id string, "
                             "item string", setup)


def document_fingerprints(docs: DataFrame, window: int, short: list[int],
                          wanted: np.ndarray | None) -> DataFrame:
    """``(doc, hash, at)`` of ``docs(doc, text)``: winnowed grams, and all
    grams of the ``short`` sizes; only hashes in ``wanted`` (sorted) if given."""
    sent = docs.sparkSession.sparkContext.broadcast(wanted) if wanted is not None else None

    def setup():
        hasher = WordHashes()

        def f(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            words, counts = hasher(b.column("text").to_pylist())
            ends = np.cumsum(counts)
            found = [fingerprint_places(words, counts, window)]
            for k in short:
                grams = gram_hashes(words, k)
                places = np.arange(len(grams))
                row = np.searchsorted(ends, places, side="right")
                places = places[places + k <= ends[row]]
                found.append((places, grams[places]))
            for places, hashes in found:
                hashes = hashes.view(np.int64)
                if sent is not None:
                    known = sent.value
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    hit = known[at] == hashes
                    places, hashes = places[hit], hashes[hit]
                if len(places):
                    row = np.searchsorted(ends, places, side="right")
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc").take(pa.array(row)), pa.array(hashes),
                         pa.array((places - (ends - counts)[row]).astype(np.int32))],
                        names=["doc", "hash", "at"])
        return f

    return map_slices(docs, "doc bigint, hash bigint, at int", setup, AT_ONCE)


def extended(words: list[bytes], item: list[bytes], at: int, place: int, size: int
             ) -> tuple[int, int]:
    """The longest span of equal words around a hit: ``words[start:end]``."""
    if words[at:at + size] != item[place:place + size]:
        return at, at
    start, end = at, at + size
    left = place
    while start and left and words[start - 1] == item[left - 1]:
        start, left = start - 1, left - 1
    right = place + size
    while end < len(words) and right < len(item) and words[end] == item[right]:
        end, right = end + 1, right + 1
    return start, end


def judge_text(text: str | None, hits: list[dict] | None, window: int
               ) -> tuple[int, int, list[str]]:
    """Words, hit words and the sorted ids of the items that occur."""
    words = words_of(text)
    if not hits:
        return len(words), 0, []
    edges = np.zeros(len(words) + 1, np.int64)
    ids: set[str] = set()
    items: dict[str, list[bytes]] = {}
    spans: dict[tuple[str, int], tuple[int, int]] = {}   # the last one of each alignment
    for h in sorted(hits, key=lambda h: h["at"]):
        text, at, place = h["item"], h["at"], h["place"]
        if text not in items:
            items[text] = words_of(text)
        item = items[text]
        span = spans.get((text, at - place))
        if span is None or at >= span[1]:
            span = spans[text, at - place] = extended(words, item, at, place, h["size"])
        if span[1] - span[0] >= min(window, len(item)):
            ids.add(h["item_id"])
            edges[span[0]] += 1
            edges[span[1]] -= 1
    return len(words), int((np.cumsum(edges) > 0).sum()), sorted(ids)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with ``n_words``, ``n_hit`` and
    ``items``, the sorted distinct ids (as strings) of the items that occur."""
    items = benchmark.select(F.col(item_id_col).cast("string").alias("item_id"),
                             F.col(item_text_col).alias("item"))
    prints = cut(item_fingerprints(
        items.where("item_id IS NOT NULL AND item IS NOT NULL").distinct(), window))
    size = prints.agg(F.sum(F.octet_length("item") + F.octet_length("item_id") + 40)).first()[0] or 0
    short = [r["size"] for r in prints.where("whole").select("size").distinct().collect()]  # < window
    small = size <= BROADCAST_BYTES
    wanted = None
    if small:     # at least 40 bytes were counted for each
        wanted = np.array(sorted(r["hash"] for r in prints.select("hash").distinct().collect()),
                          np.int64)

    key = row_key(id_col, text_col)
    texts = docs.select(key.alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = document_fingerprints(texts, window, short, wanted)
    hits = (found.join(F.broadcast(prints) if small else prints, "hash").groupBy("doc")
            .agg(F.collect_list(F.struct("at", "place", "size", "item_id", "item")).alias("hits")))
    whole = docs.select(F.struct("*").alias("row"), key.alias("doc"))
    joined = whole.join(hits, "doc", "left").select("row", "hits")

    def setup():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            judged = [judge_text(t, h, window) for t, h in
                      zip(b.column("row").field(text_col).to_pylist(), b.column("hits").to_pylist())]
            return pa.RecordBatch.from_arrays(
                [b.column("row"), pa.array([j[0] for j in judged], pa.int64()),
                 pa.array([j[1] for j in judged], pa.int64()),
                 pa.array([j[2] for j in judged], pa.list_(pa.string()))],
                names=["row", "n_words", "n_hit", "items"])
        return f

    kind = whole.schema["row"].dataType.simpleString()
    return map_slices(joined, f"row {kind}, n_words bigint, n_hit bigint, items array<string>", setup)


def contaminated(n_hit: Column, n_words: Column) -> Column:
    """A twentieth of the words or more is hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)
