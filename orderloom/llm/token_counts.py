"""Token counts by heap-and-linked-list byte-pair merging.

A text's symbols form a linked list; a heap holds the adjacent pairs that the
vocabulary can merge.  The pair of the lowest rank is popped again and again
(the leftmost among equals) and merged, until no pair is left.  The count is
the number of initial symbols less the number of merges; no token ids are
made.  Symbols that the vocabulary lacks fall back to their UTF-8 bytes.

Merges never cross the start of a run of spaces (no piece has a space mark
after another character) or the border of two groups of characters that no
piece puts side by side (letters and full stops, say).  So a text is counted
chunk by chunk, and the counts of chunks are remembered.

Defined results: a null text counts as empty; an empty text has 0 tokens and
0 bytes; repeated rows and null ids stay as they are.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import map_slices

MARK = "▁"      # how the vocabulary writes a space
CACHE_CHUNKS = 1 << 19   # counts of words and of chunks remembered by a worker
CACHE_CHARS = 32         # longer chunks are counted anew


def merged(symbols: list[str], rank: dict[str, int]) -> list[str]:
    """Merge ``symbols`` by rank; returns the pieces that are left."""
    n = len(symbols)
    if n < 2:
        return symbols
    get = rank.get
    sym: list[str | None] = list(symbols)
    pair = [get(a + b) for a, b in zip(symbols, symbols[1:])] + [None]  # rank of i with its next
    heap = [r << 32 | i for i, r in enumerate(pair) if r is not None]
    if not heap:
        return symbols
    nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
    heapq.heapify(heap)
    while heap:
        top = heapq.heappop(heap)
        i = top & 0xFFFFFFFF
        if pair[i] != top >> 32:
            continue                      # one of the two has merged since
        j = nxt[i]
        both = sym[i] = sym[i] + sym[j]
        sym[j] = pair[j] = None
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            r = pair[i] = get(both + sym[k])
            if r is not None:
                heapq.heappush(heap, r << 32 | i)
        else:
            pair[i] = None
        h = prv[i]
        if h >= 0:
            r = pair[h] = get(sym[h] + both)
            if r is not None:
                heapq.heappush(heap, r << 32 | h)
    return [s for s in sym if s is not None]


class _Remembered(dict):
    """Calls a function of a string once for each short string, while there
    is room; the first strings seen are the frequent ones."""

    def __init__(self, of: Callable[[str], int]):
        super().__init__()
        self.of = of

    def __missing__(self, key: str) -> int:
        n = self.of(key)
        if len(key) <= CACHE_CHARS and len(self) < CACHE_CHUNKS:
            self[key] = n
        return n


class PieceCounter:
    """Counts tokens as a sentencepiece BPE model with byte fallback would."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        if not any(model.is_byte(i) for i in ids):
            raise ValueError(f"{path}: no byte fallback")
        score = {model.id_to_piece(i): model.get_score(i) for i in ids
                 if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
        place = {x: r for r, x in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {p: place[x] for p, x in score.items()}
        if any(MARK in p.lstrip(MARK) for p in self.rank):
            raise ValueError(f"{path}: pieces cross words")
        if model.encode("a  b", out_type=str) == model.encode("a b", out_type=str):
            raise ValueError(f"{path}: spaces are not kept")
        first = model.encode("\n", out_type=str)[0]
        self.prefix = MARK if first.startswith(MARK) else ""
        # Characters that some piece puts side by side, directly or by others.
        group: dict[str, set[str]] = {}
        for p in self.rank:
            for a, b in zip(p, p[1:]):
                if a != MARK and group.setdefault(a, {a}) is not group.setdefault(b, {b}):
                    small, large = sorted((group[a], group[b]), key=len)
                    large |= small
                    for c in small:
                        group[c] = large
        # A chunk: a run of spaces and a run of one group, or one other character.
        classes = {id(g): g for g in group.values()}.values()
        runs = "".join("[" + "".join(map(re.escape, sorted(g))) + "]+|"
                       for g in sorted(classes, key=len, reverse=True))
        self.chunk = re.compile(f"{MARK}*(?:{runs}[^{MARK}])|{MARK}+", re.DOTALL)
        self.of_chunk = _Remembered(self._chunk)
        self.of_word = _Remembered(lambda w: self._marked(MARK + w))

    def _chunk(self, chunk: str) -> int:
        rank = self.rank
        return sum(1 if p in rank else len(p.encode()) for p in merged(list(chunk), rank))

    def _marked(self, text: str) -> int:
        return sum(map(self.of_chunk.__getitem__, self.chunk.findall(text)))

    def count(self, text: str) -> int:
        if not text:
            return 0
        marked = self.prefix + text.replace(" ", MARK)
        if not self.prefix or MARK + MARK in marked or marked[-1] == MARK:
            return self._marked(marked)
        return sum(map(self.of_word.__getitem__, marked[1:].split(MARK)))


@lru_cache(maxsize=1)
def piece_counter(path: str) -> PieceCounter:
    """The counter that a worker's tasks share."""
    return PieceCounter(path)


def count_tokens(docs: DataFrame, model_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every row of ``docs``.

    No shuffle: one pass over the texts, in Arrow batches.
    """
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def setup():
        counter = piece_counter(model_path)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column("text")
            return pa.RecordBatch.from_arrays(
                [b.column("id"), pc.cast(pc.binary_length(texts), pa.int64()),
                 pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())],
                names=["id", "n_bytes", "n_tokens"])
        return f

    out = map_slices(rows, f"id {id_type}, n_bytes bigint, n_tokens bigint", setup)
    return out.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
