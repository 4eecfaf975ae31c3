"""Small feed builders for hand-written cases."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from orderloom.operators.ingest import ingest_headers, ingest_lines
from orderloom.operators.quality import (HEADER_EXPECTATIONS, LINE_EXPECTATIONS,
                                         expect_or_drop)
from orderloom.sources.feeds import stamp_raw

HDR = ("hid string, hdate timestamp_ntz, hcust string, hcustname string, "
       "received timestamp_ntz, run_id bigint")
LIN = ("hid string, lid string, ldate timestamp_ntz, prod string, amt double, "
       "received timestamp_ntz, run_id bigint")
RUN_TS = dt.datetime(2030, 1, 1)


def d(day, h=0):
    return dt.datetime(2021, 12, day, h)


def raw(spark, header_rows, line_rows):
    h = spark.createDataFrame(header_rows, HDR)
    l = spark.createDataFrame(line_rows, LIN)
    run_ts = F.lit(RUN_TS).cast("timestamp_ntz")
    return (stamp_raw(h, "header", F.col("run_id"), F.col("received"), run_ts),
            stamp_raw(l, "line", F.col("run_id"), F.col("received"), run_ts))


def ingested(spark, header_rows, line_rows):
    rh, rl = raw(spark, header_rows, line_rows)
    return (ingest_headers(expect_or_drop(rh, HEADER_EXPECTATIONS)),
            ingest_lines(expect_or_drop(rl, LINE_EXPECTATIONS)))
