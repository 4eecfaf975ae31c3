"""Nested assembly: header state + array of live lines -> order versions.

``assemble_versions`` takes one row per (touched key, current line) - the
left join of the header state of a touched order with the lines current at
that run - and collapses it into one version row per touched key:

* ``occurred`` / ``received``: the header's, else the lines' newest;
* ``line_cnt``: distinct live line ids (0 when none);
* ``lines``: sorted array of live line structs; NULL when the order has no
  line at all, ``[]`` when every line is deleted;
* ``seq``: (greatest event time, greatest arrival time of header and lines,
  newest line run, this run) - the order in which versions fold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.exprs import line_struct, micros, seq_struct
from orderloom.operators.latest import KEY
from orderloom.schemas import ORDER_KEY


def _line_aggs() -> list:
    live = ~F.col("is_line_deleted")
    one = line_struct("line_id", "l_occurred", "l_received", "line_run_id",
                      "run_id", "prod", "amt")
    return [
        F.max("l_occurred").alias("l_occurred"),
        F.max("l_received").alias("l_received"),
        F.max("line_run_id").alias("line_run_id"),
        F.count("line_id").alias("_n"),
        F.size(F.collect_set(F.when(live, F.col("line_id")))).alias("_cnt"),
        F.collect_set(F.when(live, one)).alias("_lines"),
    ]


def order_lines(line_latest: DataFrame) -> DataFrame:
    """Per touched key: newest line times, newest line run, live line count and
    the array of live lines (``[]`` when all are deleted)."""
    j = line_latest.withColumnsRenamed({"occurred": "l_occurred",
                                        "received": "l_received"})
    return (j.groupBy(*KEY).agg(*_line_aggs())
            .select(*KEY, F.col("l_occurred").alias("occurred"),
                    F.col("l_received").alias("received"), "line_run_id",
                    F.col("_cnt").alias("line_cnt"),
                    F.sort_array("_lines").alias("lines")))


def assemble_versions(joined: DataFrame) -> DataFrame:
    """Collapse (touched key x current line) rows into order versions.

    ``joined`` columns: run_id, key_bucket, order_id, is_order_deleted,
    h_occurred, h_received, cust (header state, NULL without header) and
    line_id, is_line_deleted, l_occurred, l_received, line_run_id, prod, amt
    (NULL without lines).  Grouping is on the touched key, which the join
    already clustered on, so no further shuffle is needed.
    """
    g = joined.groupBy(*KEY).agg(
        F.max("is_order_deleted").alias("is_order_deleted"),
        F.max("h_occurred").alias("h_occurred"),
        F.max("h_received").alias("h_received"),
        F.max("cust").alias("cust"),
        *_line_aggs())
    return _versions(g, F.col("_cnt"), F.when(F.col("_n") > 0, F.sort_array("_lines")))


def _versions(df: DataFrame, line_cnt: Column, lines: Column) -> DataFrame:
    occ = F.greatest("h_occurred", "l_occurred")
    rec = F.greatest("h_received", "l_received")
    return df.select(
        *KEY,
        F.coalesce("h_occurred", "l_occurred").alias("occurred"),
        F.coalesce("h_received", "l_received").alias("received"),
        "is_order_deleted", "cust", line_cnt.cast("bigint").alias("line_cnt"), lines.alias("lines"),
        seq_struct(micros(occ), micros(rec), F.col("line_run_id"),
                   F.col("run_id")).alias("seq"),
    )


def lines_of_order(lines: DataFrame, run_id: int, repeats: bool) -> DataFrame:
    """The current lines (``LINE_KEY``, is_line_deleted, occurred, received,
    line_run_id, prod, amt) of each order in one row, for ``versions_of_lines``.

    With ``repeats`` a line may have several rows, which differ."""
    live = ~F.col("is_line_deleted")
    live_id = F.when(live, F.col("line_id"))
    one = line_struct(run_id=F.lit(run_id))
    return lines.groupBy(*ORDER_KEY).agg(
        F.max("occurred").alias("l_occurred"), F.max("received").alias("l_received"),
        F.max("line_run_id").alias("line_run_id"), F.count("line_id").alias("_n"),
        (F.size(F.collect_set(live_id)) if repeats else F.count(live_id)).alias("_cnt"),
        F.collect_list(F.when(live, one)).alias("_lines"))


def versions_of_lines(df: DataFrame) -> DataFrame:
    """One version row for each row of ``df``: the touched key, the header
    state as in ``assemble_versions`` and the columns of ``lines_of_order``
    (NULL is no line)."""
    return _versions(df, F.coalesce("_cnt", F.lit(0)), F.when(F.col("_n") > 0, F.sort_array("_lines")))


# The columns of a version, in order.
VERSION_COLS = [*KEY, "occurred", "received", "is_order_deleted", "cust", "line_cnt", "lines", "seq"]
# A line state as ``collect_states`` gathers it.
STATE_COLS = ["line_id", "is_line_deleted", "l_occurred", "l_received", "line_run_id", "prod", "amt"]


def versions_of_states(rows: Column, repeats: bool) -> Column:
    """An array of versions (``VERSION_COLS`` but the order) for an array of
    structs ``(run_id, is_order_deleted, h_occurred, h_received, cust, _cur)``.

    One expression, so that an order's versions are made in memory: a chain of
    projections would copy its arrays into a row at every step."""
    def gather(x: Column) -> Column:
        live = F.filter(x["_cur"], lambda s: ~s["is_line_deleted"])
        one = F.sort_array(F.transform(live, lambda s: line_struct(
            s["line_id"], s["l_occurred"], s["l_received"], s["line_run_id"], x["run_id"], s["prod"], s["amt"])))
        newest = [F.array_max(x["_cur"][c]).alias(c) for c in ("l_occurred", "l_received", "line_run_id")]
        return F.struct(*[x[c].alias(c) for c in ("run_id", "is_order_deleted", "h_occurred", "h_received", "cust")],
                        *newest, F.array_max(x["_cur"]["line_id"]).isNotNull().alias("_any"), one.alias("_sorted"))

    def distinct(x: Column) -> Column:          # sorted, so equal structs are neighbours
        return x.withField("_sorted", F.filter(x["_sorted"], lambda s, i: (i == 0) | ~s.eqNullSafe(
            x["_sorted"][F.greatest(i - 1, F.lit(0))])))

    def version(x: Column) -> Column:
        if repeats:
            cnt = F.size(F.array_compact(F.array_distinct(x["_sorted"]["line_id"])))
        else:                                   # a line once; one without an id sorts first
            first = F.get(x["_sorted"]["line_id"], F.lit(0))
            cnt = F.greatest(F.size(x["_sorted"]) - first.isNull().cast("int"), F.lit(0))
        occ = F.greatest(x["h_occurred"], x["l_occurred"])
        rec = F.greatest(x["h_received"], x["l_received"])
        return F.struct(
            x["run_id"].alias("run_id"),
            F.coalesce(x["h_occurred"], x["l_occurred"]).alias("occurred"),
            F.coalesce(x["h_received"], x["l_received"]).alias("received"),
            x["is_order_deleted"].alias("is_order_deleted"), x["cust"].alias("cust"),
            F.coalesce(cnt, F.lit(0)).cast("bigint").alias("line_cnt"),
            F.when(x["_any"], x["_sorted"]).alias("lines"),
            seq_struct(micros(occ), micros(rec), x["line_run_id"], x["run_id"]).alias("seq"))
    out = F.transform(rows, gather)
    if repeats:
        out = F.transform(out, distinct)
    return F.transform(out, version)


def order_versions(keys: DataFrame, header_latest: DataFrame,
                   line_latest: DataFrame) -> DataFrame:
    """Per-run form: touched keys LEFT JOIN header state LEFT JOIN current
    lines, assembled."""
    h = header_latest.select(*KEY, "is_order_deleted",
                             F.col("occurred").alias("h_occurred"),
                             F.col("received").alias("h_received"), "cust")
    l = line_latest.select(*KEY, "line_id", "is_line_deleted",
                           F.col("occurred").alias("l_occurred"),
                           F.col("received").alias("l_received"),
                           "line_run_id", "prod", "amt")
    return assemble_versions(keys.select(*KEY).join(h, KEY, "left").join(l, KEY, "left"))
