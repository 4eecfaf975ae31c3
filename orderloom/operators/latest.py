"""Touched keys and the latest header / lines of touched orders, per run.

These are the incremental shapes: the keys of one run are matched against
the history of the ingested tables.  Unlike the original two-step "maximum,
then join back" form, the history is first semi-joined to the touched keys
(so the aggregate and the shuffle cost touched rows, not all history) and
every "row at the maximum" is one aggregate of a struct maximum:

* header at its newest event time: ``max(struct(occurred, is_order_deleted))``
  ORs the delete flags of ties, ``max(struct(occurred, received))`` is the
  newest arrival among them and ``max(struct(occurred, received, run_id,
  cust))`` picks the customer deterministically;
* line (default ``argmax``): the row with the greatest
  ``(occurred, received, run_id, prod, amt)``; one aggregate, no join back;
* line ``strict``: the original rule - rows equal to three independent maxima
  (event time, arrival time, run) of the line; such a line vanishes when no
  single row holds all three.

All struct maxima are associative, so they take map-side partial aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.schemas import ORDER_KEY

KEY = ["run_id", *ORDER_KEY]
LINE_KEY = [*ORDER_KEY, "line_id"]
LINE_LATEST_COLS = ["run_id", *LINE_KEY, "is_line_deleted", "occurred",
                    "received", "line_run_id", "prod", "amt"]


# --- touched keys -------------------------------------------------------------

def touched_keys(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct (run_id, key_bucket, order_id) touched by either feed."""
    return (headers.select(*KEY).unionByName(lines.select(*KEY))
            .dropDuplicates(KEY))


# --- header aggregates (shared with the all-runs rebuild) ---------------------

def header_partials(headers: DataFrame, exclude_deleted: bool = False) -> list[Column]:
    """Per-row structs whose maxima give the header state.

    ``exclude_deleted``: among the rows at the newest event time only the
    non-deleted ones count (none left -> no header state).  A ``live`` field
    right after the event time makes the maximum prefer them.
    """
    if exclude_deleted:
        live = (~F.col("is_order_deleted")).alias("live")
        return [
            F.struct("occurred", live).alias("_hd"),
            F.struct("occurred", live, "received").alias("_hr"),
            F.struct("occurred", live, "received", F.col("run_id").alias("h_run_id"),
                     "cust").alias("_hc"),
        ]
    return [
        F.struct("occurred", "is_order_deleted").alias("_hd"),
        F.struct("occurred", "received").alias("_hr"),
        F.struct("occurred", "received", F.col("run_id").alias("h_run_id"),
                 "cust").alias("_hc"),
    ]


def header_state(d: Column, r: Column, c: Column, exclude_deleted: bool = False) -> list[Column]:
    if exclude_deleted:
        ok = d["live"]
        return [F.when(ok, F.lit(False)).alias("is_order_deleted"),
                F.when(ok, d["occurred"]).alias("occurred"),
                F.when(ok, r["received"]).alias("received"),
                F.when(ok, c["cust"]).alias("cust")]
    return [d["is_order_deleted"].alias("is_order_deleted"),
            d["occurred"].alias("occurred"),
            r["received"].alias("received"),
            c["cust"].alias("cust")]


def argmax_line_struct() -> Column:
    return F.struct("occurred", "received", F.col("run_id").alias("line_run_id"),
                    "prod", "amt", "is_line_deleted")


# --- per-run operators ----------------------------------------------------------

def _history(df: DataFrame, keys: DataFrame, run_id: int | None) -> DataFrame:
    if run_id is not None:
        df = df.where(F.col("run_id") <= F.lit(run_id))
    return df.join(keys.select(*ORDER_KEY).distinct(), ORDER_KEY, "left_semi")


def header_latest_ts(keys: DataFrame, headers: DataFrame,
                     run_id: int | None = None) -> DataFrame:
    """Touched orders with the newest header event time (orders with a header)."""
    agg = (_history(headers, keys, run_id).groupBy(*ORDER_KEY)
           .agg(F.max("occurred").alias("occurred")))
    return keys.join(agg, ORDER_KEY).select(*KEY, "occurred")


def header_latest(keys: DataFrame, headers: DataFrame, run_id: int | None = None,
                  exclude_deleted: bool = False) -> DataFrame:
    """Header state of each touched order: rows at the newest event time
    collapsed (delete = OR, received = max, customer of the newest arrival);
    ``exclude_deleted`` keeps only non-deleted rows at that time."""
    h = _history(headers, keys, run_id)
    agg = (h.select(*ORDER_KEY, *header_partials(h, exclude_deleted)).groupBy(*ORDER_KEY)
           .agg(F.max("_hd").alias("_hd"), F.max("_hr").alias("_hr"),
                F.max("_hc").alias("_hc")))
    out = (keys.join(agg, ORDER_KEY)
           .select(*KEY, *header_state(F.col("_hd"), F.col("_hr"), F.col("_hc"),
                                       exclude_deleted)))
    return out.where(F.col("occurred").isNotNull()) if exclude_deleted else out


def line_latest_ts(keys: DataFrame, lines: DataFrame,
                   run_id: int | None = None) -> DataFrame:
    """Per touched order and line: three independent maxima (event time,
    arrival time, run) - the original filter table."""
    agg = (_history(lines, keys, run_id).groupBy(*LINE_KEY)
           .agg(F.max("occurred").alias("occurred"), F.max("received").alias("received"),
                F.max("run_id").alias("line_run_id")))
    return keys.join(agg, ORDER_KEY).select(*KEY, "line_id", "occurred", "received",
                                            "line_run_id")


def line_winners(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of each line that equal its three separate maxima (strict mode).

    The maxima are a hash aggregate with map-side combine.  Rows meet them on
    the line *and* the three values, so the rows of a hot line are dealt out
    by value, and no task holds a line's history.  Rows with ``is_row`` false
    count for the maxima only."""
    times = ["occurred", "received", "run_id"]
    top = rows.groupBy(*key).agg(*[F.max(c).alias(c) for c in times])
    if "is_row" in rows.columns:
        rows = rows.where("is_row")
    return rows.join(top, [*key, *times])


def strict_tops(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row a line: its maxima ``occurred``, ``received``, ``run_id``, whether
    any row equals all three (``won``), and ``rows``, the distinct (prod, amt,
    is_line_deleted) of those that do.

    Such rows hold the greatest (occurred, received, run) triple, so two
    aggregates give them without a join; the first, by the triple, has a
    map-side combine and no task holds a line's history."""
    times = ["occurred", "received", "run_id"]
    row = F.struct("prod", "amt", "is_line_deleted")
    if "is_row" in rows.columns:
        row = F.when(F.col("is_row"), row)
    same = rows.groupBy(*key, *times).agg(F.collect_set(row).alias("_rows"))
    top = same.groupBy(*key).agg(
        F.max_by("_rows", F.struct(*times)).alias("rows"), F.max(F.struct(*times)).alias("_t"),
        *[F.max(c).alias(c) for c in times])
    won = (F.size("rows") > 0) & F.col("line_id").isNotNull()
    for c in times:
        won = won & (F.col(f"_t.{c}") == F.col(c))
    return top.select(*key, *times, F.coalesce(won, F.lit(False)).alias("won"), "rows")


def line_latest(keys: DataFrame, lines: DataFrame, run_id: int | None = None,
                mode: str = "argmax", prefiltered: bool = False) -> DataFrame:
    """Current row of every line of each touched order (deleted lines included,
    flagged).  ``prefiltered``: ``lines`` already holds only touched orders."""
    h = lines if prefiltered else _history(lines, keys, run_id)
    if mode == "argmax":
        cur = (h.groupBy(*LINE_KEY).agg(F.max(argmax_line_struct()).alias("w"))
               .select(*LINE_KEY, "w.*"))
    elif mode == "strict":
        cur = line_winners(h, LINE_KEY).select(
            *LINE_KEY, "occurred", "received", F.col("run_id").alias("line_run_id"),
            "prod", "amt", "is_line_deleted")
    else:
        raise ValueError(f"unknown line mode {mode!r}")
    return keys.join(cur, ORDER_KEY).select(*LINE_LATEST_COLS)
