"""Language identification by segmentation-marginalised unigrams.

A fixed public vocabulary gives the pieces.  For each language every piece has
a probability, and a word's probability is the sum over all its segmentations
into pieces (forward algorithm); a text's is the product over its words.
Training is expectation-maximisation on the word counts of all learning texts:
each round counts the pieces that the segmentations of every word are expected
to hold (forward and backward), sums them by language, and renews the
probabilities.  The language of a text is the one of the highest posterior.

Scale: word counts are pre-aggregated before their shuffle and grow with the
corpus; the model holds at most ``vocabulary x languages`` numbers, whatever
the corpus, and is what tasks are sent.  Prediction is one pass without a
shuffle, with the scores of words remembered by each worker.

Defined results: null texts and texts without a letter are ``und`` with score
0; rows without a language teach nothing; with nothing learned all is ``und``;
ties go to the first language in alphabetical order; repeated rows count;
words of any length, and texts without spaces, are summed whole; a row whose
``learn_from`` is null (as of a null id) teaches nothing and counts as not
learned, so it is held out; more than ``MAX_LANGUAGES`` languages are an error;
an empty table gives no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import cut, map_slices

MARK = "▁"               # begins a word
ROUNDS = 2               # of expectation-maximisation
MAX_LANGUAGES = 1000     # bound of the model that tasks are sent
SMOOTH = 0.5             # added to every expected count
WORD_CHARS = 24          # longer words are summed in logarithms, and not remembered
WORDS_AT_ONCE = 4096     # words of one lattice
CELLS = 1 << 18          # letters of a lattice of longer words, if it has more than one
CACHE_WORDS = 1 << 19    # words remembered by a worker
LETTERS = re.compile(r"[^\W\d_]+")


def load_pieces(path: str) -> list[str]:
    """Lower-case pieces of letters of a sentencepiece vocabulary."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))}
    return sorted(p for p in pieces if p == MARK or LETTERS.fullmatch(p.removeprefix(MARK)))


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def word_counts(docs: DataFrame) -> DataFrame:
    """``(lang, word, n)`` over all of ``docs(lang, text)``.  Each task counts
    the words of a few documents at a time before anything is shuffled."""
    def setup():
        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            seen: dict[str, Counter] = {}
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist()):
                seen.setdefault(lang, Counter()).update(words_of(text))
            rows = [(g, w, n) for g, c in seen.items() for w, n in c.items()]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])
        return f

    counts = map_slices(docs.where("text IS NOT NULL").select("lang", "text"),
                        "lang string, word string, n bigint", setup)
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


BASE = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """All segmentations of a batch of words, as arcs between letters.

    Substrings of all words are hashed length by length (64 bits) and looked
    up among the hashes of the pieces of that length.
    """

    def __init__(self, pieces: list[str]):
        self.n_pieces = len(pieces)      # and one more for letters they lack
        by_size: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            by_size.setdefault(len(p), []).append(k)
        self.tables = {}                 # length -> sorted hashes, their pieces
        for size, numbers in by_size.items():
            points = np.array([[ord(c) for c in pieces[k]] for k in numbers], np.uint64)
            hashes = np.zeros(len(numbers), np.uint64)
            for i in range(size):
                hashes = hashes * BASE + points[:, i] + np.uint64(1)
            order = np.argsort(hashes)
            self.tables[size] = hashes[order], np.array(numbers)[order]
        self.longest = max(by_size, default=1)

    def arcs(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Arcs ``(word, start, end, piece)`` sorted by (end, word), and the
        words' lengths with the mark."""
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        points = np.frombuffer("".join(MARK + w for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
        word = np.repeat(np.arange(len(words)), sizes)
        start = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        left = sizes[word] - start       # letters from a place to the word's end
        at, hashes = np.arange(len(points)), np.zeros(len(points), np.uint64)
        found: list[tuple[np.ndarray, int, np.ndarray]] = []
        for size in range(1, self.longest + 1):
            fits = left[at] >= size
            at, hashes = at[fits], hashes[fits]
            if not len(at):
                break
            hashes = hashes * BASE + points[at + size - 1] + np.uint64(1)
            known, numbers = self.tables.get(size, (np.zeros(1, np.uint64), np.zeros(1, np.int64)))
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = (known[place] == hashes) & (size in self.tables)
            found.append((at[hit], size, numbers[place[hit]]))
            if size == 1:
                found.append((at[~hit], 1, np.full((~hit).sum(), self.n_pieces)))
        begin = np.concatenate([f[0] for f in found] or [np.empty(0, np.int64)])
        size = np.concatenate([np.full(len(f[0]), f[1]) for f in found] or [np.empty(0, np.int64)])
        piece = np.concatenate([f[2] for f in found] or [np.empty(0, np.int64)])
        end = start[begin] + size
        order = np.argsort(end * len(words) + word[begin], kind="stable")
        begin = begin[order]
        return word[begin], start[begin], end[order], piece[order], sizes


def forward(word: np.ndarray, start: np.ndarray, end: np.ndarray, p: np.ndarray,
            n_words: int) -> np.ndarray:
    """``(words, places, ...)``: the sum over all segmentations of each prefix,
    for arcs sorted by (end, word) with probabilities ``p`` (a row for each)."""
    places = int(end.max()) + 1 if len(end) else 1
    sums = np.zeros((n_words, places) + p.shape[1:])
    sums[:, 0] = 1
    cuts = np.searchsorted(end, np.arange(places + 1))
    for e in range(1, places):
        a, b = cuts[e], cuts[e + 1]
        if a < b:
            w = word[a:b]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            sums[w[first], e] = np.add.reduceat(sums[w, start[a:b]] * p[a:b], first, axis=0)
    return sums


def log_forward(word: np.ndarray, start: np.ndarray, end: np.ndarray, logs: np.ndarray,
                n_words: int) -> np.ndarray:
    """``forward`` in logarithms, for words whose probability is no double."""
    places = int(end.max()) + 1 if len(end) else 1
    sums = np.full((n_words, places) + logs.shape[1:], -np.inf)
    sums[:, 0] = 0
    cuts = np.searchsorted(end, np.arange(places + 1))
    for e in range(1, places):
        a, b = cuts[e], cuts[e + 1]
        if a < b:
            w = word[a:b]
            first = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            terms = sums[w, start[a:b]] + logs[a:b]
            most = np.maximum.reduceat(terms, first, axis=0)
            share = np.exp(terms - np.repeat(most, np.diff(np.append(first, b - a)), axis=0))
            sums[w[first], e] = most + np.log(np.add.reduceat(share, first, axis=0))
    return sums


def lattices(words: list[str]) -> Iterator[tuple[np.ndarray, bool]]:
    """Places of the words of one lattice, and whether they are long ones:
    words of like length, with ``CELLS`` letters at most, or a single word."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    short = np.flatnonzero(sizes <= WORD_CHARS)
    for at in range(0, len(short), WORDS_AT_ONCE):
        yield short[at:at + WORDS_AT_ONCE], False
    long = np.flatnonzero(sizes > WORD_CHARS)
    long = long[np.argsort(sizes[long], kind="stable")]
    while len(long):
        fits = np.arange(1, len(long) + 1) * sizes[long] <= CELLS
        n = max(1, int(np.argmin(fits)) if not fits.all() else len(long))
        yield long[:n], True
        long = long[n:]


def expected_counts(lattice: Lattice, words: list[str], langs: np.ndarray, n: np.ndarray,
                    probs: np.ndarray) -> np.ndarray:
    """Expected pieces, ``(pieces + 1, languages)``, in words of one language each."""
    out = np.zeros(probs.shape)
    for of, long in lattices(words):
        word, start, end, piece, sizes = lattice.arcs([words[i] for i in of])
        lang, size, k = langs[of], sizes[word], len(of)
        p = probs[piece, lang[word]]
        # Backward is forward on the reversed words.
        back = np.lexsort((word, size - start))
        sums = log_forward if long else forward
        p = np.log(p) if long else p
        alpha = sums(word, start, end, p, k)
        beta = sums(word[back], (size - end)[back], (size - start)[back], p[back], k)
        total = alpha[np.arange(k), sizes][word]
        share = (np.exp(alpha[word, start] + p + beta[word, size - end] - total) if long
                 else alpha[word, start] * p * beta[word, size - end] / total)
        n_langs = probs.shape[1]
        out += np.bincount(piece * n_langs + lang[word], share * n[of][word], probs.size).reshape(probs.shape)
    return out


def train(counts: DataFrame, pieces: list[str], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages in order, and ``probs[piece, language]`` (the last row is for
    letters that no piece holds), from ``counts(lang, word, n)``."""
    names = [r["lang"] for r in counts.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    langs = sorted(names)
    probs = np.full((len(pieces) + 1, len(langs)), 1 / (len(pieces) + 1))
    sc = counts.sparkSession.sparkContext
    for _ in range(rounds if langs else 0):
        sent = sc.broadcast((pieces, langs, probs))

        def setup(sent=sent):
            pieces, langs, probs = sent.value
            lattice, place = Lattice(pieces), {g: i for i, g in enumerate(langs)}

            def f(b: pa.RecordBatch) -> pa.RecordBatch:
                lang = np.array([place[g] for g in b.column("lang").to_pylist()], np.int64)
                n = b.column("n").to_numpy().astype(float)
                got = expected_counts(lattice, b.column("word").to_pylist(), lang, n, probs)
                k, g = np.nonzero(got)
                return pa.RecordBatch.from_arrays(
                    [pa.array(k), pa.array(g), pa.array(got[k, g])], names=["piece", "lang", "e"])
            return f

        # At most pieces x languages rows come back.
        sums = (map_slices(counts, "piece bigint, lang bigint, e double", setup, WORDS_AT_ONCE)
                .groupBy("piece", "lang").agg(F.sum("e").alias("e")).toPandas())
        expected = np.full(probs.shape, SMOOTH)
        expected[sums["piece"].to_numpy(int), sums["lang"].to_numpy(int)] += sums["e"].to_numpy()
        probs = expected / expected.sum(axis=0)
    return langs, probs


class Scorer:
    """Log-probabilities of words in each language; the first words seen, which
    are the frequent ones, are kept."""

    def __init__(self, pieces: list[str], probs: np.ndarray):
        self.lattice, self.probs = Lattice(pieces), probs
        self.place: dict[str, int] = {}
        self.logs = np.zeros((1 << 12, probs.shape[1]))

    def score(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.probs.shape[1]))
        for of, long in lattices(words):
            word, start, end, piece, sizes = self.lattice.arcs([words[i] for i in of])
            p, at = self.probs[piece], np.arange(len(of))
            out[of] = (log_forward(word, start, end, np.log(p), len(of))[at, sizes] if long
                       else np.log(forward(word, start, end, p, len(of))[at, sizes]))
        return out

    def texts(self, texts: list[list[str]]) -> np.ndarray:
        """The summed log-probabilities of each list of words."""
        place, known = self.place, len(self.place)
        fresh = [w for w in dict.fromkeys(w for t in texts for w in t) if w not in place]
        fresh.sort(key=lambda w: len(w) > WORD_CHARS)
        if known + len(fresh) > len(self.logs):
            grown = np.zeros((2 * (known + len(fresh)), self.logs.shape[1]))
            grown[:known] = self.logs[:known]
            self.logs = grown
        if fresh:
            self.logs[known:known + len(fresh)] = self.score(fresh)
        kept = max(0, min(sum(len(w) <= WORD_CHARS for w in fresh), CACHE_WORDS - known))
        place.update(zip(fresh[:kept], range(known, known + kept)))
        rest = dict(zip(fresh[kept:], range(known + kept, known + len(fresh))))
        out = np.zeros((len(texts), self.probs.shape[1]))
        for i, t in enumerate(texts):
            at = [place[w] if w in place else rest[w] for w in t] if rest else [place[w] for w in t]
            if at:
                out[i] = self.logs[at].sum(axis=0)
        return out


_held: dict[str, Scorer] = {}


def held_scorer(name: str, pieces: list[str], probs: np.ndarray) -> Scorer:
    """The scorer that a worker's tasks of one model share."""
    if name not in _held:
        _held.clear()
        _held[name] = Scorer(pieces, probs)
    return _held[name]


def identify(docs: DataFrame, learn_from: Column, vocabulary: str, id_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``(id, learned, lang_pred, score)`` of every row of ``docs``; rows for
    which ``learn_from`` holds teach, if they have a language."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       F.col(lang_col).alias("lang"), F.coalesce(learn_from, F.lit(False)).alias("learned"))
    pieces = load_pieces(vocabulary)
    counts = cut(word_counts(rows.where("learned AND lang IS NOT NULL")))
    langs, probs = train(counts, pieces)
    sent = docs.sparkSession.sparkContext.broadcast((pieces, langs, probs))
    kind, name = rows.schema["id"].dataType.simpleString(), uuid.uuid4().hex

    def setup():
        pieces, langs, probs = sent.value
        scorer = held_scorer(name, pieces, probs)

        def f(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = [words_of(t) if t else [] for t in b.column("text").to_pylist()]
            texts = [t if any(c.isalpha() for w in t for c in w) else [] for t in texts]
            said: list[str] = []
            score: list[float] = []
            sums = scorer.texts(texts) if langs else None
            for i, t in enumerate(texts):
                if not t or not langs:
                    said.append("und")
                    score.append(0.0)
                else:
                    best = int(np.argmax(sums[i]))
                    said.append(langs[best])
                    score.append(float(1 / np.exp(sums[i] - sums[i][best]).sum()))
            return pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("learned"), pa.array(said, pa.string()),
                 pa.array(score, pa.float64())], names=["id", "learned", "lang_pred", "score"])
        return f

    out = map_slices(rows.select("id", "learned", "text"),
                     f"id {kind}, learned boolean, lang_pred string, score double", setup)
    return out.withColumnRenamed("id", id_col)
