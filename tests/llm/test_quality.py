"""Base counts against a plain version; certified cutoffs."""

import re

import pytest
from pyspark.sql import functions as F

from orderloom.llm import quality_rules as Q


def _counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, n_dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_dup += line in seen
            seen.add(line)
    places = {}
    for i in range(len(words) - 7):
        places.setdefault(tuple(words[i:i + 8]), []).append(i)
    hit = {i + k for p in places.values() if len(p) > 1 for i in p for k in range(8)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), n_dup, len(hit))


def test_base_counts(spark, docs, sf_small):
    for df in (docs, spark.read.parquet(f"{sf_small}/documents.parquet")):
        rows = Q.base_counts(df, F.col("text")).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == _counts(r.text)


def test_binomial_tail_is_exact(spark):
    from math import comb
    df = spark.createDataFrame([(0, 100), (3, 200), (5, 100), (9, 700)], "k bigint, n bigint")
    for r in df.withColumn("p", Q.at_most_tail(F.col("k"), F.col("n"), 0.02)).collect():
        want = sum(comb(r.n, i) * 0.02 ** i * 0.98 ** (r.n - i) for i in range(r.k + 1))
        assert r.p == pytest.approx(1.0 if r.k > 0.02 * r.n else want, rel=1e-9)


@pytest.fixture(scope="module")
def labelled(spark):
    good = "a plain sentence number {} about rivers and hills with quite enough different words to pass " \
           "the base rule of twenty words easily"
    rows, labels = [], []
    for i in range(3000):
        bad = i % 5 == 0
        text = good.format(i) + (" you idiot scum" if bad else "")
        rows.append((i, text, "en" if i % 3 else "fr" if i % 33 else None))
        labels.append((i, 1, int(bad)))
    return (spark.createDataFrame(rows, "doc_id bigint, text string, lang string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def test_learned_rules_catch_bad_and_keep_good(labelled):
    docs, labels = labelled
    judged = Q.judge(docs, Q.bad_labels(labels)).select("row.*", "base_failed", "kept")
    got = judged.groupBy((F.col("doc_id") % 5 == 0).alias("bad"), "lang").agg(
        F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    by = {(r.bad, r.lang): r.kept for r in got}
    assert by[False, "en"] == by[False, "fr"] == by[False, None] == 1
    assert by[True, "en"] == by[True, "fr"] == 0
    assert by[True, None] == 1          # too few labels to certify anything there


def test_certification_counts_labels_beyond_the_lexicon_bound(labelled):
    docs, labels = labelled
    for keep in (None, ["doc_id", "lang"]):
        # 600 labels hold too few good French holdout rows to certify anything.
        judged = Q.judge(docs, Q.bad_labels(labels), max_labelled=600, keep=keep).select("row.*", "kept")
        assert judged.where("doc_id % 5 = 0 AND lang = 'fr' AND kept").count() == 0
        assert judged.where("doc_id % 5 > 0 AND NOT kept").count() == 0


def test_repeated_labels_count_once_each(spark):
    rows = [(1, 0.0, True, 2), (2, 0.9, True, 3), (3, 0.9, False, 1)]
    cols = [F.lit("en").alias("stratum"), "bad", F.col("w").cast("long").alias("w"), *[
        (F.col("x") if r == "shout" else F.lit(0.0)).alias(r) for r in Q.RULES]]
    fit = spark.createDataFrame([(*r,) for r in rows], "id int, x double, bad boolean, w int").select(*cols)
    assert Q.choose_cutoffs(fit).first().shout == float("inf")       # 3 caught, 1 lost
    assert Q.choose_cutoffs(fit.where("bad")).first().shout == 0.8


def test_without_labels_only_the_base_rule(spark, docs, no_docs):
    labels = spark.createDataFrame([], "id bigint, bad boolean")
    rows = Q.judge(docs, labels).select("row.*", "base_failed", "kept").collect()
    assert len(rows) == docs.count()
    assert all(r.kept == (not r.base_failed) for r in rows)
    assert all(r.base_failed for r in rows if not (r.text or "").strip())
    assert Q.judge(no_docs, labels).collect() == []


def test_copies_are_no_new_evidence(labelled):
    """Too few distinct texts to certify anything, whatever their copies."""
    docs, labels = labelled
    few = docs.where("doc_id < 300")
    for times in (1, 10):
        copies = few.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_i")
        told = labels.withColumn("_i", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("_i")
        judged = Q.judge(copies, Q.bad_labels(told))
        assert judged.where("kept = base_failed").count() == 0
        assert judged.count() == times * few.count()
