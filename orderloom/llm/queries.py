"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (conversation_trie, decontaminate, langid, license_scan, line_dedup, packing,
                           quality_rules, secret_scan, sharding, simhash_groups, token_counts,
                           url_reputation, whitening)
from orderloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
             ("allow", "org/fr/")]
URL_FLOOR, URL_Z = 0.5, 2.0
TOKEN_LIMIT = 4096
SHARDS = 16


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; ``ORDERLOOM_TOKENIZERS`` names
    another folder."""
    folder = os.environ.get("ORDERLOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf, "documents")).select(
        "row.doc_id", "text", "n_lines", "n_dropped")


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_contamination(table(spark, sf, "documents"),
                                             table(spark, sf, "benchmark"))
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def op3_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf, "documents"),
                                    vocabulary("byte_bpe_50k.tiktoken"))


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"),
                                 quality_rules.bad_labels(table(spark, sf, "labels")),
                                 keep=["doc_id"])
    return judged.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf, "documents"),
                                     vocabulary("piece_bpe_32k.model"), TOKEN_LIMIT)


def op6_langid(spark: SparkSession, sf: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    found = langid.identify(table(spark, sf, "documents"), fold != 0,
                            vocabulary("piece_bpe_32k.model"))
    return found.select("doc_id", (~F.col("learned")).alias("held_out"), "lang_pred", "score")


def op7_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("matches")
    names = F.array_sort(F.array_distinct(F.transform(m, lambda x: x["license"])))
    places = F.transform(m, lambda x: F.concat_ws(":", x["license"], x["line_no"].cast("string")))
    return license_scan.scan_licenses(table(spark, sf, "documents")).select(
        "doc_id", "n_lines", F.size(m).cast("long").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"), F.array_join(places, ",").alias("matches"),
        F.size("windows").cast("long").alias("n_windows"), F.array_join(F.transform(
            "windows", lambda x: F.concat_ws(":", x["license"], x["start"].cast("string"))), ",").alias("windows"))


def op10_packing(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes are bytes; a cluster is a group of near copies, as in op9."""
    size = F.octet_length(F.coalesce(F.col("text"), F.lit("")))
    rows = simhash_groups.with_clusters(
        table(spark, sf, "documents"), [F.col("doc_id"), F.col("source"), size.alias("n_bytes")])
    return packing.pack(rows, F.col("n_bytes"), F.col("cluster"))


def op9_simhash_groups(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_groups.group_documents(table(spark, sf, "documents"), shingle=3, max_bits=3)


def page_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled page outcomes: good where quality is 1 and toxic is 0; labels
    number the crawled item, which is the page of the same number."""
    return table(spark, sf, "labels").select(
        F.col("doc_id").alias("page_id"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good"))


def op8_url_reputation(spark: SparkSession, sf: str) -> DataFrame:
    return url_reputation.filter_urls(
        table(spark, sf, "pages"), page_outcomes(spark, sf), URL_RULES, URL_FLOOR, URL_Z
    ).select("page_id", "host", "path", "rule", "verdict")


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations are rebuilt by the contract first: groups of five, at
    most eight borrowed turns."""
    turns, convs = conversation_trie.grafted_turns(table(spark, sf, "conversations"), 5, 9)
    return conversation_trie.prefix_trie(turns, convs)


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """The law is ``bytes``: the shards' sizes are near equal."""
    return sharding.shard_documents(table(spark, sf, "documents"), SHARDS).select(
        "row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """``n`` vectors with sums S: ``deviation`` is the sum of (n x - S)^2,
    ``whitened`` the projection of x - S/n over the component's deviation,
    ``explained`` its share of the variance, ``identity_error`` the largest
    entry by which the whitened covariance differs from the identity."""
    return whitening.whiten(table(spark, sf, "embeddings"), components=8)


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_secret_scan": op3_secret_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_langid": op6_langid,
    "op7_license_scan": op7_license_scan,
    "op8_url_reputation": op8_url_reputation,
    "op9_simhash_groups": op9_simhash_groups,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_sharding": op12_sharding,
    "op13_whitening": op13_whitening,
}
