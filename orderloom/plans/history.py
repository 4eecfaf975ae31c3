"""History and inspection queries over the pipeline tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.sources.feeds import scan_glob


def history_sorted(versions: DataFrame) -> DataFrame:
    """Full version history: bucket, order, newest event/arrival/run first."""
    return versions.orderBy(F.col("key_bucket"), F.col("order_id"),
                            F.col("occurred").desc(), F.col("received").desc(),
                            F.col("run_id").desc())


def touched_per_run(keys: DataFrame) -> DataFrame:
    """Orders touched per run (either feed)."""
    return keys.groupBy("run_id").agg(F.count(F.lit(1)).alias("touched_orders"),
                                      F.count_distinct("key_bucket").alias("touched_buckets"))


def headerless(latest_df: DataFrame) -> DataFrame:
    """Latest orders whose header never arrived (built from lines only)."""
    return latest_df.where(F.col("is_order_deleted").isNull())


def lines_summary(latest_df: DataFrame) -> DataFrame:
    """Orders of the latest table by line state: no lines (NULL array), all
    lines deleted (empty array), with live lines."""
    state = (F.when(F.col("lines").isNull(), F.lit("no_lines"))
             .when(F.size("lines") == 0, F.lit("all_deleted"))
             .otherwise(F.lit("live")))
    return (latest_df.groupBy(state.alias("line_state"))
            .agg(F.count(F.lit(1)).alias("orders"),
                 F.sum("line_cnt").cast("bigint").alias("live_lines")))


def records_as_json(spark, pattern: str) -> DataFrame:
    """Every ingested file's records as JSON text, with the feed and the run
    number that the path names (``.../SOH_<run>/...`` or ``.../SOH_<run>.json``),
    ordered by run number, then file.

    The global sort runs its input twice (once to find the ranges), so it sorts
    the lines as they are, and each is parsed once, after it."""
    schema = T.StructType([f for f in scan_glob(spark, pattern).schema
                           if f.name not in ("source_file", "file_mtime")])
    named = r"(SO[HL])_([0-9]+)(?:\.json|/[^/]+)$"
    tail = F.substring_index("file_name", "/", -2)      # what ``named`` can match
    lines = spark.read.text(pattern).select("value", F.col("_metadata.file_path").alias("file_name"))
    lines = (lines.where(F.btrim("value", F.lit(" \t\r")) != "")
             .select("file_name", F.regexp_extract(tail, named, 2).try_cast("bigint").alias("run_id"), "value")
             .orderBy("run_id", "file_name"))
    # The mode is the default one; naming it keeps Spark from passing the text on unparsed.
    mode = {"mode": "PERMISSIVE"}
    one = F.array(F.from_json("value", schema, mode))
    # A line that is an array holds a record in each element.
    many = F.coalesce(F.from_json("value", T.ArrayType(schema), mode), one)
    records = F.when(F.ltrim("value").startswith("["), many).otherwise(one)
    feed = F.regexp_extract(tail, named, 1).alias("feed")
    return (lines.select("file_name", feed, "run_id", F.explode(records).alias("record"))
            .select("file_name", "feed", "run_id", F.to_json("record").alias("json_string")))
