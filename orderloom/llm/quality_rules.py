"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Every text gets base counts and rule scores.  Labelled rows are split by a
hash of their text into a fit fold and a holdout.  On the fit fold a lexicon of
words that mark bad documents is learned, and for each stratum and rule the
cutoff with the best balance of bad rows caught and good rows lost is chosen.
The holdout then tests a family of relaxed versions of these cutoffs: a
version is certified for a stratum when the exact binomial probability of at
most the seen number of false rejections, were their true share ``alpha``, is
at most ``delta`` over the number of tests made (Bonferroni over versions and
strata).  Each stratum uses its certified version that catches most bad rows;
a stratum without one is left to the base rule.  So with probability
``1 - delta`` every stratum rejects at most ``alpha`` of its good documents.

The lexicon, a classifier, is learned from a bounded number of labelled rows
(``max_labelled``, those of the smallest id hashes).  Cutoffs and their
certification count all labelled rows: scores, without the texts, are joined
with the labels by id.  Scoring covers whole texts of all documents without a
shuffle.  The cutoffs are broadcast after their number is counted.

Defined results: a null text has no words and fails the base rule; a null
stratum is a stratum of its own; repeated rows are scored alike; labelled rows
of equal text and stratum are one trial, bad where all their labels say so;
null labels and labels of null ids are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import BROADCAST_BYTES, cut, settled

SPACE_CHARS = " \t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]"
REPEAT_WORDS = 8         # words of a repeat window
MIN_GOOD = 60            # good holdout rows that a stratum needs
MAX_LABELLED = 20_000    # labelled rows that the lexicon is learned from
STRATUM_BYTES = 256      # of one stratum's cutoffs, for the bound of a broadcast
LEXICON_WORDS = 64       # bound of the learned lexicon
LEXICON_LEAST = 8        # fit rows that a lexicon word stands in, at least
LEXICON_SHARE = 0.8      # share of bad rows among them, at least
RELAX = (1.0, 1.5, 2.0, 4.0)
LOSS = 10.0              # bad rows that one lost good row outweighs

# Rule scores and the cutoffs that each may take (a higher score is worse).
CUTOFFS: dict[str, list[float]] = {
    "symbols": [0.05, 0.1, 0.2, 0.3, 0.5, 0.8],
    "dup_lines": [0.1, 0.2, 0.3, 0.5, 0.7],
    "repeats": [0.05, 0.1, 0.2, 0.3],
    "shout": [0.1, 0.2, 0.3, 0.5, 0.8],
    "marked": [0.0, 1.0, 2.0, 3.0],
}
RULES = tuple(CUTOFFS)


def base_counts(docs: DataFrame, text: Column) -> DataFrame:
    """Adds ``n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words, n_upper`` and the lower-cased ``_low``; other columns stay."""
    t = F.coalesce(text, F.lit(""))
    trimmed = F.btrim(t, F.lit(SPACE_CHARS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE + "+"))
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    n_windows = F.size("_words") - (REPEAT_WORDS - 1)
    windows = F.when(n_windows > 1, F.transform(
        F.sequence(F.lit(0), F.greatest(n_windows - 1, F.lit(0))),
        # Eight lookups: slice() would copy the whole array for each window.
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + j) for j in range(REPEAT_WORDS)])))
    df = settled(docs, _text=t, _words=words, _lines=lines)
    df = settled(df, _windows=windows)
    # Sorted (hash, place) of the windows, only where some window recurs.
    recurs = F.size(F.array_distinct("_windows")) < F.size("_windows")
    df = settled(df, _sorted=F.when(recurs, F.array_sort(F.transform(
        F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda x, j: F.coalesce(F.get(F.col("_sorted"), j)["h"] == x["h"], F.lit(False))
    places = F.array_sort(F.transform(
        F.filter(F.col("_sorted"), lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"]))
    covered = F.aggregate(
        places, F.struct(F.lit(0).alias("n"), F.lit(-REPEAT_WORDS).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(REPEAT_WORDS), i - s["last"])).alias("n"),
                              i.alias("last")), lambda s: s["n"])
    without = lambda pattern: F.length("_text") - F.length(F.regexp_replace("_text", pattern, ""))
    counts = {
        "n_words": F.size("_words"), "word_chars": F.length(F.array_join("_words", "")),
        "n_symbols": without(r"[#*$%&|<>]"), "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.coalesce(covered, F.lit(0)), "n_upper": without(r"\p{Lu}")}
    df = settled(df, **{k: c.cast("long") for k, c in counts.items()}, _low=F.lower("_text"))
    return df.drop("_text", "_words", "_lines", "_windows", "_sorted")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def with_scores(counted: DataFrame, lexicon: list[str]) -> DataFrame:
    """Adds the rule scores to counted rows and drops ``_low``."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    marked = F.lit(0.0)
    if lexicon:           # how many of its words stand in the text
        marked = F.size(F.array_intersect(
            F.split("_low", r"\P{L}+"), F.array(*map(F.lit, sorted(lexicon))))).cast("double")
    return (counted.withColumn("symbols", share("n_symbols", "n_words"))
            .withColumn("dup_lines", share("n_dup_lines", "n_lines"))
            .withColumn("repeats", share("n_repeat_words", "n_words"))
            .withColumn("shout", share("n_upper", "word_chars"))
            .withColumn("marked", marked).drop("_low"))


def learn_lexicon(fit: DataFrame) -> list[str]:
    """At most ``LEXICON_WORDS`` words that mark bad rows of ``fit(_low, bad)``."""
    words = fit.select("bad", F.explode(F.array_distinct(F.split("_low", r"\P{L}+"))).alias("word"))
    n, bad = F.count("*"), F.sum(F.col("bad").cast("long"))
    top = (words.where(F.length("word") > 2).groupBy("word").agg(n.alias("n"), bad.alias("b"))
           .where((F.col("n") >= LEXICON_LEAST) & (F.col("b") >= LEXICON_SHARE * F.col("n")))
           .orderBy(F.desc("b"), "word").limit(LEXICON_WORDS))
    return [r["word"] for r in top.select("word").collect()]


def _times(hit: Column) -> Column:
    """How many labels stand behind the rows that are hit."""
    return F.sum(F.when(hit, F.col("w")).otherwise(F.lit(0).cast("long")))


def small(strata: DataFrame) -> DataFrame:
    """``strata``, already cut, to be broadcast if they are few enough."""
    return F.broadcast(strata) if strata.count() * STRATUM_BYTES <= BROADCAST_BYTES else strata


def choose_cutoffs(fit: DataFrame) -> DataFrame:
    """``(stratum, <rule>...)``: the cutoff of the best balance, else infinity.
    A row of ``fit`` counts ``w`` times."""
    grid = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("score"), F.lit(c).alias("cutoff"))
                     for r in RULES for c in CUTOFFS[r]])
    hits = F.col("x.score") > F.col("x.cutoff")
    gain = _times(hits & F.col("bad")) - LOSS * _times(hits & ~F.col("bad"))
    per = (fit.withColumn("x", F.explode(grid)).groupBy("stratum", "x.rule", "x.cutoff")
           .agg(gain.alias("gain")))
    best = (per.where("gain > 0").groupBy("stratum", "rule")
            .agg(F.max(F.struct("gain", "cutoff"))["cutoff"].alias("cutoff")))
    none = F.lit(math.inf)
    strata = fit.select("stratum").distinct()
    picked = best.groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff"))
    return strata.join(picked, F.expr("true") & strata["stratum"].eqNullSafe(picked["stratum"]), "left") \
        .select(strata["stratum"], *[F.coalesce(picked[r], none).alias(r) for r in RULES])


def rejects(cut: str, relax: Column) -> Column:
    """Whether any rule's score passes the relaxed cutoff in column ``cut``."""
    out = F.lit(False)
    for r in RULES:
        out = out | (F.col(r) > F.col(f"{cut}.{r}") * relax)
    return out


def at_most_tail(k: Column, n: Column, alpha: float) -> Column:
    """Exact P(Bin(n, alpha) <= k), summed term by term; 1 where k > alpha n
    (then it is over a half at least, and no test passes)."""
    odds = alpha / (1 - alpha)
    first = F.exp(n * math.log1p(-alpha))
    tail = F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.least(k, F.ceil(alpha * n)), F.lit(0)).cast("int")),
        F.struct(F.lit(0.0).alias("sum"), first.alias("term")),
        lambda s, i: F.struct((s["sum"] + s["term"]).alias("sum"),
                              (s["term"] * ((n - i) / (i + 1)) * odds).alias("term")),
        lambda s: s["sum"])
    return F.when(k > alpha * n, F.lit(1.0)).otherwise(tail)


def certify(cutoffs: DataFrame, holdout: DataFrame, alpha: float, delta: float) -> DataFrame:
    """``(stratum, cut, relax)`` of each stratum with a certified version."""
    cuts = small(cut(cutoffs.select("stratum", F.struct(*RULES).alias("cut"))))
    h = holdout.withColumnRenamed("stratum", "s")
    seen = (h.join(cuts, F.col("s").eqNullSafe(F.col("stratum")))
            .withColumn("relax", F.explode(F.array(*map(F.lit, RELAX)))))
    hit = rejects("cut", F.col("relax"))
    good = ~F.col("bad")
    tests = (seen.groupBy("stratum", "cut", "relax")
             .agg(_times(good).alias("n"), _times(hit & good).alias("k"),
                  _times(hit & F.col("bad")).alias("caught"))
             .where(F.col("n") >= MIN_GOOD))
    n_tests = tests.agg(F.greatest(F.count("*"), F.lit(1))).scalar()
    passed = tests.where(at_most_tail(F.col("k"), F.col("n"), alpha) <= F.lit(delta) / n_tests)
    best = F.max(F.struct("caught", -F.col("k"), "relax", "cut"))
    return (passed.groupBy("stratum").agg(best.alias("b"))
            .select("stratum", F.col("b.cut").alias("cut"), F.col("b.relax").alias("relax")))


def lexicon_of(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED,
               id_col: str = "doc_id", text_col: str = "text") -> list[str]:
    """The lexicon of the fit fold of at most ``max_labelled`` labels ``(id, bad)``."""
    some = labels.orderBy(F.xxhash64("id", "bad"), "id", "bad").limit(max_labelled)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.join(F.broadcast(some), "id").where(fold(F.xxhash64("text")) == 0)   # at most max_labelled ids
    return learn_lexicon(base_counts(rows, F.col("text")).where(~base_failed()).select("_low", "bad"))


def fold(text_hash: Column) -> Column:
    return F.crc32(text_hash.cast("string")) % 2


def learn(scored: DataFrame, labels: DataFrame, alpha: float, delta: float) -> DataFrame:
    """The certified cutoffs.  ``scored`` is ``(id, text_hash, stratum,
    <rule>..., base_failed)`` of all documents, ``labels`` is ``(id, bad)``.  A
    distinct text of a stratum is one trial, in one fold: copies are no new
    evidence.  It is a bad one if all labels of its copies say so."""
    told = labels.groupBy("id").agg(F.min("bad").alias("bad"))
    rows = cut(scored.where("id IS NOT NULL AND NOT base_failed").join(told, "id")
               .groupBy("text_hash", "stratum")
               .agg(F.min("bad").alias("bad"), *[F.min(r).alias(r) for r in RULES])
               .select("stratum", "bad", F.lit(1).cast("long").alias("w"), *RULES,
                       fold(F.col("text_hash")).alias("fold")))
    cutoffs = choose_cutoffs(rows.where("fold = 0"))
    return cut(certify(cutoffs, rows.where("fold = 1"), alpha, delta))


def judge(docs: DataFrame, labels: DataFrame, alpha: float = 0.02, delta: float = 0.1,
          stratum: str = "lang", max_labelled: int = MAX_LABELLED, id_col: str = "doc_id",
          text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with its base counts, scores,
    ``base_failed`` and ``kept``.

    ``keep`` names the columns that ``row`` holds (all by default).  Without
    the text among them, scores are worked out once and kept; with it, they
    are worked out again rather than written beside the text.
    """
    labels = labels.where("bad IS NOT NULL AND id IS NOT NULL")
    lexicon = lexicon_of(docs, labels, max_labelled, id_col, text_col)
    keep = docs.columns if keep is None else keep
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(id_col).alias("id"),
                       F.col(stratum).alias("s"), F.col(text_col).alias("_t"), F.xxhash64(text_col).alias("text_hash"))
    scored = with_scores(base_counts(rows, F.col("_t")).drop("_t"), lexicon).withColumn(
        "base_failed", base_failed())
    if text_col not in keep:
        scored = cut(scored)
    certified = learn(scored.select("id", "text_hash", F.col("s").alias("stratum"), "base_failed", *RULES),
                      labels, alpha, delta)
    verdict = F.coalesce(rejects("cut", F.col("relax")), F.lit(False))
    return (scored.join(small(certified), F.col("s").eqNullSafe(F.col("stratum")), "left")
            .withColumn("kept", ~F.col("base_failed") & ~verdict)
            .drop("id", "s", "text_hash", "stratum", "cut", "relax"))


def bad_labels(labels: DataFrame) -> DataFrame:
    """``(id, bad)`` of a labels table: bad where quality is 0 or toxic is 1."""
    return labels.select(F.col("doc_id").alias("id"),
                         ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
