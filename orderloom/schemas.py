"""Schemas and fixed names of the order change-feed model."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original pipeline's for equal results) ---
# Prefixes of the surrogate ids built from the feed ids.
ORDER_ID_PREFIX = "SalesOrderHeader_"
LINE_ID_PREFIX = "SalesOrderLine_"
# Digits of the order id are divided by this to give the key bucket.
KEY_BUCKET_DIVISOR = 1000
# Offset added to each sequence part before it is printed, so every part has
# 18 digits and the concatenation sorts like the tuple.
SEQ_OFFSET = 100000000000000000
# Source settings of the original pipeline (files per trigger; tombstone
# retention in seconds).
MAX_FILES_PER_TRIGGER = 999
TOMBSTONE_RETENTION_SECONDS = 900
# --- end of fixed values ---

# Raw feed schemas (schema hints): a bare date such as "2021-12-01" parses
# as midnight.
HEADER_FEED = T.StructType([
    T.StructField("HID", T.StringType()),
    T.StructField("HDATE", T.TimestampNTZType()),
    T.StructField("HCUST", T.StringType()),
    T.StructField("HCUSTNAME", T.StringType()),
])

LINE_FEED = T.StructType([
    T.StructField("HID", T.StringType()),
    T.StructField("LID", T.StringType()),
    T.StructField("LDATE", T.TimestampNTZType()),
    T.StructField("PROD", T.StringType()),
    T.StructField("AMT", T.DoubleType()),
])

# Key of an order everywhere; joins always carry the bucket (partition
# pruning) and the id.
ORDER_KEY = ["key_bucket", "order_id"]
