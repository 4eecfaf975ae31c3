"""Data-quality expectations: expect-or-drop, violation counts, quarantine.

An expectation is a named SQL predicate.  Three-valued logic: a row passes
only when the predicate is TRUE (NULL drops it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The predicates are fixed values (they decide what is dropped); the names are ours.
HEADER_EXPECTATIONS = {
    "valid_header_received": "hid IS NOT NULL AND hdate IS NOT NULL AND hcust IS NOT NULL",
}
LINE_EXPECTATIONS = {
    "valid_line_received": "hid IS NOT NULL AND lid IS NOT NULL",
}

EXPECTATIONS = {"header": HEADER_EXPECTATIONS, "line": LINE_EXPECTATIONS}


def _passes(expectations: dict[str, str]):
    return [F.coalesce(F.expr(p), F.lit(False)) for p in expectations.values()]


def expect_or_drop(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Keep rows meeting every expectation (a plain, pushed-down filter)."""
    cond = None
    for c in _passes(expectations):
        cond = c if cond is None else cond & c
    return df.where(cond) if cond is not None else df


def quarantine(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """Rows failing any expectation, with the names of the failed ones."""
    names = list(expectations)
    failed = F.filter(
        F.array(*[F.when(~c, F.lit(n)) for n, c in zip(names, _passes(expectations))]),
        lambda x: x.isNotNull())
    return df.withColumn("failed", failed).where(F.size("failed") > 0)


def expectation_counts(df: DataFrame, expectations: dict[str, str],
                       dataset: str = "") -> DataFrame:
    """Passed / dropped row counts per named expectation, in one job.

    One global aggregate (map-side partial counts), then one row per
    expectation.
    """
    names = list(expectations)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count_if(~c).alias(f"_f{i}") for i, c in enumerate(_passes(expectations))]
    agg = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("expectation"),
                              F.col(f"_f{i}").alias("failed_records"))
                     for i, n in enumerate(names)])
    return agg.select(F.lit(dataset).alias("dataset"), F.inline(rows),
                      F.col("_rows").alias("input_records")).select(
        "dataset", "expectation", "input_records",
        (F.col("input_records") - F.col("failed_records")).alias("passed_records"),
        "failed_records")
