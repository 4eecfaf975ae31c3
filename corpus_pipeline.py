"""Corpus pipeline: raw documents to packed bins, in five stages.

Each stage reads what its predecessor kept, works on all of it, and is written
as Parquet before the next one reads it, so a lost executor or a failed stage
repeats that stage only.  All stages but the last return the columns of
``documents``.

1. quality rules: documents that the base rule or the certified thresholds
   reject go;
2. line dedup: of fuzzy copies of a line one stays; a document all of whose
   lines have gone goes too, ``n_chars`` follows the text;
3. SimHash near-dedup: one document of each group stays, the one with the
   smallest id (equal ids: the smallest row hash);
4. benchmark decontamination: documents of which a twentieth of the words or
   more lies in benchmark spans go;
5. best-fit packing: a row for each piece of a document with its bin; after
   stage 3 no two documents are near copies, so a text is its own cluster.

Null texts fail the quality rules; an empty table passes through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import decontaminate, line_dedup, packing, quality_rules, simhash_groups
from orderloom.llm.common import table
from orderloom.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = quality_rules.bad_labels(table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, labels).where("kept").select("row.*")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup_lines(docs).where("n_dropped < n_lines OR n_lines = 0")
    row = F.col("row").withField("text", F.col("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(kind))
                            .otherwise(F.col("row.n_chars")))
    return done.select(row.alias("row")).select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_groups.one_of_each(docs, shingle=3, max_bits=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = decontaminate.contaminated(F.col("n_hit"), F.col("n_words"))
    return found.where(~dirty).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return packing.pack(docs, F.octet_length(text), F.xxhash64(text))


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("simhash_near_dedup", near_copies),
          ("decontamination", benchmark), ("best_fit_packing", pack)]

# Union-find, MinHash and best fit are not for SQL: tests hold the stages
# against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; intermediate tables go to the shared
    checkpoint folder."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        out = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
