"""The batch pipeline over the replayed feeds of a table folder."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from orderloom.operators.ingest import ingest_headers, ingest_lines
from orderloom.operators.quality import (HEADER_EXPECTATIONS, LINE_EXPECTATIONS,
                                         expect_or_drop)
from orderloom.sources.feeds import replay_raw


@dataclass
class Tables:
    raw_headers: DataFrame      # bronze, after expect-or-drop
    raw_lines: DataFrame
    headers: DataFrame          # ingested (typed, renamed, delete flags)
    lines: DataFrame
    raw_headers_all: DataFrame  # bronze before the expectations
    raw_lines_all: DataFrame


def replay_tables(spark: SparkSession, sf_dir: str) -> Tables:
    rh_all, rl_all = replay_raw(spark, sf_dir)
    rh = expect_or_drop(rh_all, HEADER_EXPECTATIONS)
    rl = expect_or_drop(rl_all, LINE_EXPECTATIONS)
    return Tables(rh, rl, ingest_headers(rh), ingest_lines(rl), rh_all, rl_all)
