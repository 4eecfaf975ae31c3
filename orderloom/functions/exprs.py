"""Column expressions of the model.

All are built-in Spark expressions, so they stay inside whole-stage codegen;
no Python runs per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderloom.schemas import KEY_BUCKET_DIVISOR, SEQ_OFFSET

def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def key_bucket(hid: str = "hid", divisor: int = KEY_BUCKET_DIVISOR) -> Column:
    """Digits of the id as a number, integer-divided by ``divisor``.

    ``H1 -> 0``, ``29H99 -> 2``, ``3H3333 -> 33``.  No digits, or more than fit
    a BIGINT, give 0 (``try_cast``: Spark is ANSI by default).
    """
    return F.expr(
        f"coalesce(try_cast(regexp_replace({_sql(hid)}, '[^0-9]', '') AS BIGINT), 0)"
        f" div {int(divisor)}")


def header_deleted(hcust="hcust") -> Column:
    """An empty customer marks an order delete; NULL is not a delete."""
    return F.when(_c(hcust).cast("string") == "", True).otherwise(False)


def amt_long(amt="amt") -> Column:
    """Amount as BIGINT; the cast truncates towards zero (0.4 -> 0)."""
    return _c(amt).try_cast("bigint")


def line_deleted(amt="amt") -> Column:
    """Amount 0 after truncation marks a line delete; NULL is not a delete."""
    return F.when(amt_long(amt) == 0, True).otherwise(False)


def micros(ts) -> Column:
    """Microseconds since the epoch of a zone-free timestamp (TZ independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            _c(ts))


def _sql(x) -> str:
    if isinstance(x, str):
        return f"`{x}`"
    raise TypeError("expected a column name")


def seq_struct(occurred: Column, received: Column, line_run_id: Column,
               run_id: Column) -> Column:
    """Sequence of a version: compares like the tuple, NULL parts are 0."""
    return F.struct(
        F.coalesce(occurred, F.lit(0)).cast("bigint").alias("occurred_us"),
        F.coalesce(received, F.lit(0)).cast("bigint").alias("received_us"),
        F.coalesce(line_run_id, F.lit(0)).cast("bigint").alias("line_run_id"),
        F.coalesce(run_id, F.lit(0)).cast("bigint").alias("run_id"),
    )


def seq_string(seq="seq") -> Column:
    """The sequence printed as four offset 18-digit numbers (parity form)."""
    s = _c(seq)
    parts = [(s.getField(f) + F.lit(SEQ_OFFSET)).cast("string")
             for f in ("occurred_us", "received_us", "line_run_id", "run_id")]
    return F.concat(*parts)


def line_struct(line_id="line_id", occurred="occurred", received="received",
                line_run_id="line_run_id", run_id="run_id", prod="prod",
                amt="amt") -> Column:
    return F.struct(
        _c(line_id).alias("line_id"),
        _c(occurred).alias("occurred"),
        _c(received).alias("received"),
        _c(line_run_id).cast("bigint").alias("line_run_id"),
        _c(run_id).cast("bigint").alias("run_id"),
        _c(prod).alias("prod"),
        _c(amt).cast("bigint").alias("amt"),
    )


def lines_text(lines="lines", strip: Sequence[str] = ()) -> Column:
    """Array of line structs as a sorted ``line:prod:amt`` list joined by ','.

    NULL stays NULL (order without lines), ``[]`` becomes ``''``.
    """
    def one(x):
        lid = x["line_id"]
        for p in strip:
            lid = F.regexp_replace(lid, "^" + p, "")
        return F.concat_ws(":", lid, F.coalesce(x["prod"], F.lit("")),
                           F.coalesce(x["amt"].cast("string"), F.lit("")))
    return F.array_join(F.sort_array(F.array_distinct(F.transform(_c(lines), one))), ",")


def shard_of(order_id="order_id", shards: int = 64) -> Column:
    """Storage shard of an order: a hash, so digit-free ids do not pile up."""
    return F.pmod(F.xxhash64(_c(order_id)), F.lit(shards)).cast("int")


def received_from_path(path: Column, rules: Sequence[tuple[str, str]],
                       default: Column | None = None) -> Column:
    """Arrival time chosen by ``LIKE`` patterns on the source path.

    ``rules`` is an ordered list of (pattern, timestamp literal); the first
    match wins (``_`` is a LIKE wildcard, ``SOH_1%`` also matches ``SOH_10``).
    """
    out = default if default is not None else F.localtimestamp()
    for pattern, ts in reversed(list(rules)):
        out = F.when(path.like(pattern),
                     F.lit(ts).cast("timestamp_ntz")).otherwise(out)
    return out
