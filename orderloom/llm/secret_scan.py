"""Secret scan: fixed patterns, and guess cost of credential-context values.

Three fixed patterns give the base spans.  Beside them, values that stand in a
credential context (``pwd: x``, ``the password is x``) are priced by a dynamic
program: the cheapest way to write the value as dictionary words, dates,
repeats, keyboard walks, runs of neighbouring characters and brute-force
characters, in decimal logarithms of guesses.  A value that costs at least
``min_guesses`` is a secret; ``welcome2019`` is not, ``x9$kQ2!vB`` is.

One pass over the texts in Arrow batches, no shuffle.  The dictionary is a
public vocabulary file (its order is the rank); its path is a parameter.

Defined results: a null text counts as empty; a text without spans has an
empty ``spans``; offsets are code points with the end excluded; repeated rows
and null ids stay; values of any length are priced whole (linear time); of equally cheap
segmentations none is preferred, only the cost is told; an empty table gives no rows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import map_slices

# Fixed patterns and least lengths.  Where the least length is part of the
# pattern, maximal runs make both forms equal.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "context")

# Credential contexts wider than the assign pattern: the keyword may stand
# anywhere in an identifier (dbPassword, SECRET_KEY, aws_secret_access_key); a
# quoted value ends at its closing quote, on its line.  The short keyword
# "pass" and "auth" must be a part of their own, as in db_pass, not in compass.
CONTEXT = re.compile(
    r"""(?:(?:password|passwd|passphrase|passcode|pwd|secret|token|(?:api|access|private|auth|encryption|signing)[ _-]?key|credential)s?"""
    r"""|(?:(?<![A-Za-z0-9])|(?<=[a-z])(?-i:(?=[PA])))(?:pass|auth)(?![a-z]))"""
    r"""(?:[_.-][A-Za-z0-9]+|(?-i:[A-Z][A-Za-z0-9]*)|[0-9]+){0,4}"""
    r"""["']?[ \t]*(?:[:=]>?|\bis\b)[ \t]*"""
    r"""(?:"((?:[^"\\\r\n]|\\.){6,})"|'((?:[^'\\\r\n]|\\.){6,})'|["']?([^\s"'<>]{6,}))""",
    re.IGNORECASE | re.ASCII)

ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
SHIFTED = str.maketrans('~!@#$%^&*()_+{}|:"<>?', "`1234567890-=[]\\;',./")
DATE = re.compile(r"(?:(?:19|20)\d\d)(?:[-/.]?\d{1,2}[-/.]?\d{1,2})?"
                  r"|\d{1,2}[-/.]?\d{1,2}[-/.]?(?:(?:19|20)\d\d|\d\d)")
PER_CHAR = 1.0           # log10 guesses of one brute-force character
PER_SPAN = 0.3           # and of one more span
DATE_COST = math.log10(365 * 100)
WORD_CHARS = 24          # no word of the dictionary is longer
BLOCKS = (2, 3, 4)       # sizes of repeated blocks


def _neighbours() -> dict[str, str]:
    """Keys beside each key: in its row, and diagonally in the next ones."""
    near: dict[str, set[str]] = {c: set() for row in ROWS for c in row}
    for r, row in enumerate(ROWS):
        for i, c in enumerate(row):
            beside = [(r, i - 1), (r, i + 1), (r - 1, i), (r - 1, i + 1), (r + 1, i - 1), (r + 1, i)]
            near[c] |= {ROWS[y][x] for y, x in beside
                        if 0 <= y < len(ROWS) and 0 <= x < len(ROWS[y])}
    return {c: "".join(s) for c, s in near.items()}


NEAR = _neighbours()
WALK_START = math.log10(len(NEAR))
WALK_TURN = math.log10(sum(map(len, NEAR.values())) / len(NEAR))


@lru_cache(maxsize=4)
def load_words(path: str) -> dict[str, float]:
    """log10 rank of each lower-case word of three letters or more in a
    ranked vocabulary file (lines of base64 piece and rank)."""
    words: dict[str, float] = {}
    with open(path, "rb") as f:
        for line in f:
            piece = base64.b64decode(line.split()[0]).decode("utf-8", "replace").strip().lower()
            if 3 <= len(piece) <= WORD_CHARS and piece.isascii() and piece.isalpha():
                words.setdefault(piece, math.log10(len(words) + 2))
    return words


class Starts:
    """Starts ``i`` of spans whose price at an end ``j`` is ``cost + log10(j - i)``.

    Only those are held that may be the cheapest at this end or a later one: a
    start is dropped for a newer one that costs no more (cheaper at every end),
    and for an older one that is as cheap by now (the difference of the
    logarithms only shrinks).  Few are left at a time, and no start is missed."""

    def __init__(self):
        self.held: list[tuple[int, float]] = []

    def add(self, i: int, cost: float) -> None:
        while self.held and cost <= self.held[-1][1]:
            self.held.pop()
        self.held.append((i, cost))

    def cheapest(self, j: int) -> float:
        low, kept = math.inf, []
        for i, cost in self.held:
            price = cost + math.log10(j - i)
            if price < low:
                low = price
                kept.append((i, cost))
        self.held = kept
        return low


def guess_cost(value: str, words: dict[str, float]) -> float:
    """log10 of the guesses of the cheapest segmentation of ``value``."""
    n = len(value)
    low = value.lower()
    if len(low) != n:          # a capital whose small form is longer: letter by letter
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    keys = low.translate(SHIFTED)
    dates: dict[int, list[int]] = {}
    for i in range(n):
        if value[i].isdigit() and (m := DATE.match(value, i)):
            for end in {m.end(), min(m.end(), i + 4)}:
                if end - i >= 4:
                    dates.setdefault(end, []).append(i)
    best = [0.0] + [math.inf] * n
    walk = step = 0            # where the longest walk and run that end here began
    turns = [0] * (n + 1)      # turns of walks up to here
    walks, steps = Starts(), Starts()
    same = {size: 0 for size in BLOCKS}                  # places that equal the one a block before
    blocks = {size: [Starts() for _ in range(size)] for size in BLOCKS}
    for j in range(1, n + 1):
        cost = best[j - 1] + PER_CHAR
        if j > 1:              # keyboard walk
            if keys[j - 1] not in NEAR.get(keys[j - 2], ""):
                walk, walks.held = j - 1, []
            turn = j - 2 > walk and _direction(keys, j - 1) != _direction(keys, j - 2)
            turns[j] = turns[j - 1] + turn
            if j - walk >= 3:
                walks.add(j - 3, best[j - 3] - WALK_TURN * turns[j - 1])
                cost = min(cost, walks.cheapest(j) + PER_SPAN + WALK_START + WALK_TURN * (1 + turns[j]))
            delta = ord(low[j - 1]) - ord(low[j - 2])
            if abs(delta) > 1 or (j - 2 > step and delta != ord(low[j - 2]) - ord(low[j - 3])):
                step, steps.held = j - 1 if abs(delta) > 1 else j - 2, []
            if j - step >= 3:  # abcd, 4321, aaaa
                steps.add(j - 3, best[j - 3])
                cost = min(cost, steps.cheapest(j) + PER_SPAN + math.log10(26))
        for size in range(3, min(WORD_CHARS, j) + 1):
            i = j - size
            rank = words.get(low[i:j])
            if rank is not None:
                upper = 0.0 if value[i:j] == low[i:j] else 0.3 if value[i:j].istitle() else 1.0
                cost = min(cost, best[i] + PER_SPAN + rank + upper)
        for i in dates.get(j, ()):
            cost = min(cost, best[i] + PER_SPAN + DATE_COST)
        for size in BLOCKS:    # repeats of a short block, priced as the block once
            if j <= size or low[j - 1] != low[j - 1 - size]:
                if same[size] >= size:
                    for s in blocks[size]:
                        s.held = []
                same[size] = 0
                continue
            same[size] += 1
            if same[size] >= size:
                starts = blocks[size][j % size]
                starts.add(j - 2 * size, best[j - 2 * size])
                cost = min(cost, starts.cheapest(j) - math.log10(size) + PER_SPAN
                           + min(size * PER_CHAR, words.get(low[j - size:j], 9.0)))
        best[j] = cost
    return best[n]


def _direction(keys: str, j: int) -> tuple[int, int]:
    """From key j-1 to key j: change of row and of place."""
    at = [(r, row.index(c)) for c in keys[j - 1:j + 1] for r, row in enumerate(ROWS) if c in row]
    return (at[1][0] - at[0][0], at[1][1] - at[0][1]) if len(at) == 2 else (9, 9)


def scan_text(text: str, words: dict[str, float], min_cost: float
              ) -> tuple[list[tuple[int, int, int]], float | None]:
    """Spans ``(start, kind, end)`` in order, and the highest cost seen."""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text)
             if m.end(2) - m.start(2) >= ASSIGN_LEAST]
    assigned = [(s, e) for s, _, e in spans]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    highest = None
    at = 0
    for m in CONTEXT.finditer(text):
        k = m.lastindex
        cost = guess_cost(m[k], words)
        highest = cost if highest is None else max(highest, cost)
        while at < len(assigned) and assigned[at][1] <= m.start():
            at += 1
        if cost >= min_cost and not (at < len(assigned) and assigned[at][0] < m.end()):
            spans.append((m.start(k), 3, m.end(k)))
    spans.sort()
    return spans, highest


def scan_secrets(docs: DataFrame, words_path: str, min_guesses: float = 1e10,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, counts by kind, the digest of the
    base spans, all spans, and the highest guess cost of a context value."""
    rows = docs.select(F.col(id_col).alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    counts = [f"n_{k}" for k in KINDS]
    min_cost = math.log10(min_guesses)

    def setup():
        words = load_words(words_path)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            out: list[list] = [[] for _ in range(len(KINDS) + 3)]
            for text in b.column("text").to_pylist():
                spans, highest = scan_text(text, words, min_cost)
                for k in range(len(KINDS)):
                    out[k].append(sum(s[1] == k for s in spans))
                said = [(k, f"{KINDS[k]}:{s}:{e}") for s, k, e in spans]
                base = ",".join(x for k, x in said if k < 3)
                out[-3].append(hashlib.sha256(base.encode()).hexdigest())
                out[-2].append(",".join(x for _, x in said))
                out[-1].append(highest)
            kinds = [pa.int64()] * len(KINDS) + [pa.string(), pa.string(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [b.column("id"), *map(pa.array, out, kinds)],
                names=["id", *counts, "base_sha256", "spans", "max_log10_guesses"])
        return f

    out = map_slices(rows, f"id {id_type}, {', '.join(c + ' bigint' for c in counts)}, "
                           "base_sha256 string, spans string, max_log10_guesses double", setup)
    return out.withColumnRenamed("id", id_col)
