"""Typed projections of the raw feeds (bronze -> ingested)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.exprs import amt_long, header_deleted, line_deleted
from orderloom.schemas import LINE_ID_PREFIX, ORDER_ID_PREFIX


def ingest_headers(raw: DataFrame, order_prefix: str = ORDER_ID_PREFIX) -> DataFrame:
    """run_id, key_bucket, order_id, is_order_deleted, occurred, received, cust."""
    return raw.select(
        F.col("run_id").cast("bigint").alias("run_id"),
        F.col("key_bucket").cast("bigint").alias("key_bucket"),
        F.concat(F.lit(order_prefix), F.col("hid")).alias("order_id"),
        header_deleted("hcust").alias("is_order_deleted"),
        F.col("occurred").cast("timestamp_ntz").alias("occurred"),
        F.col("received").cast("timestamp_ntz").alias("received"),
        F.struct(F.col("hcust").cast("string").alias("id"),
                 F.col("hcustname").cast("string").alias("name")).alias("cust"),
    )


def ingest_lines(raw: DataFrame, order_prefix: str = ORDER_ID_PREFIX,
                 line_prefix: str = LINE_ID_PREFIX) -> DataFrame:
    """run_id, key_bucket, order_id, line_id, is_line_deleted, occurred,
    received, prod, amt (BIGINT, truncated)."""
    return raw.select(
        F.col("run_id").cast("bigint").alias("run_id"),
        F.col("key_bucket").cast("bigint").alias("key_bucket"),
        F.concat(F.lit(order_prefix), F.col("hid")).alias("order_id"),
        F.concat(F.lit(line_prefix), F.col("lid")).alias("line_id"),
        line_deleted("amt").alias("is_line_deleted"),
        F.col("occurred").cast("timestamp_ntz").alias("occurred"),
        F.col("received").cast("timestamp_ntz").alias("received"),
        F.col("prod").cast("string").alias("prod"),
        amt_long("amt").alias("amt"),
    )
