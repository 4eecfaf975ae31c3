"""Registered queries: one per operator of the inventory, each a function of
(spark, table folder) returning a DataFrame over the whole replayed feeds.

Nested outputs are flattened for comparison with the SQL oracle: ``cust`` ->
``cust_id``, ``cust_name``; ``lines`` -> ``line_cnt`` + ``lines_text`` (sorted
``line:prod:amt`` list); ``seq`` -> ``seq_string``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.functions.exprs import lines_text, seq_string
from orderloom.operators import fold
from orderloom.operators.assemble import order_lines
from orderloom.operators.quality import (HEADER_EXPECTATIONS, LINE_EXPECTATIONS,
                                         expectation_counts, quarantine)
from orderloom.plans import history, rebuild
from orderloom.plans.pipeline import replay_tables

Query = Callable[[SparkSession, str], DataFrame]

AS_OF_RUN = 4


def flat(df: DataFrame) -> DataFrame:
    cols = []
    for c in df.columns:
        if c == "cust":
            cols += [F.col("cust.id").alias("cust_id"), F.col("cust.name").alias("cust_name")]
        elif c == "lines":
            cols.append(lines_text("lines").alias("lines_text"))
        elif c == "seq":
            cols.append(seq_string("seq").alias("seq_string"))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def _t(spark, sf):
    return replay_tables(spark, sf)


def q_replay_headers(spark, sf):
    return _t(spark, sf).raw_headers_all


def q_replay_lines(spark, sf):
    return _t(spark, sf).raw_lines_all


def q_key_bucket(spark, sf):
    t = _t(spark, sf)
    return (t.raw_lines.groupBy("key_bucket")
            .agg(F.count(F.lit(1)).alias("n_lines"),
                 F.count_distinct("hid").alias("n_orders"),
                 F.min("hid").alias("min_hid"), F.max("hid").alias("max_hid")))


def q_expect_headers(spark, sf):
    return _t(spark, sf).raw_headers


def q_expect_lines(spark, sf):
    return _t(spark, sf).raw_lines


def q_expectation_counts(spark, sf):
    t = _t(spark, sf)
    return (expectation_counts(t.raw_headers_all, HEADER_EXPECTATIONS, "raw_headers")
            .unionByName(expectation_counts(t.raw_lines_all, LINE_EXPECTATIONS, "raw_lines")))


def q_quarantine(spark, sf):
    t = _t(spark, sf)
    failed = F.array_join("failed", ",").alias("failed")
    lines = quarantine(t.raw_lines_all, LINE_EXPECTATIONS).select(
        "run_id", F.lit("line").alias("feed"), "hid", "lid", failed)
    headers = quarantine(t.raw_headers_all, HEADER_EXPECTATIONS).select(
        "run_id", F.lit("header").alias("feed"), "hid", F.lit(None).cast("string").alias("lid"), failed)
    return lines.unionByName(headers)


def q_ingest_headers(spark, sf):
    return flat(_t(spark, sf).headers)


def q_ingest_lines(spark, sf):
    return _t(spark, sf).lines


def q_touched_keys(spark, sf):
    t = _t(spark, sf)
    return rebuild.touched_keys(t.headers, t.lines)


def q_header_latest_ts(spark, sf):
    t = _t(spark, sf)
    return rebuild.header_latest_ts_all(t.headers, t.lines)


def q_header_latest(spark, sf):
    t = _t(spark, sf)
    return flat(rebuild.header_latest_all(t.headers, t.lines))


def q_header_latest_live(spark, sf):
    """Header state counting only non-deleted rows at the newest event time."""
    t = _t(spark, sf)
    return flat(rebuild.header_latest_all(t.headers, t.lines, exclude_deleted=True))


def q_line_latest_ts(spark, sf):
    t = _t(spark, sf)
    return rebuild.line_latest_ts_all(t.headers, t.lines)


def q_line_latest(spark, sf):
    t = _t(spark, sf)
    return rebuild.line_latest_all(t.headers, t.lines, "argmax")


def q_line_latest_strict(spark, sf):
    t = _t(spark, sf)
    return rebuild.line_latest_all(t.headers, t.lines, "strict")


def q_order_lines(spark, sf):
    t = _t(spark, sf)
    return flat(order_lines(rebuild.line_latest_all(t.headers, t.lines, "argmax")))


def _versions(spark, sf, mode="argmax"):
    t = _t(spark, sf)
    return rebuild.versions_all(t.headers, t.lines, mode)


def q_order_versions(spark, sf):
    return flat(_versions(spark, sf))


def q_order_versions_strict(spark, sf):
    return flat(_versions(spark, sf, "strict"))


def q_seq_string(spark, sf):
    v = _versions(spark, sf)
    return v.select("run_id", "key_bucket", "order_id", "seq.occurred_us", "seq.received_us",
                    "seq.line_run_id", F.col("seq.run_id").alias("seq_run_id"),
                    seq_string("seq").alias("seq_string"))


def q_orders_latest(spark, sf):
    return flat(fold.fold_latest(_versions(spark, sf)))


def q_orders_latest_strict(spark, sf):
    return flat(fold.fold_latest(_versions(spark, sf, "strict")))


def q_orders_latest_window(spark, sf):
    return flat(fold.latest_window(_versions(spark, sf)))


def q_orders_as_of(spark, sf):
    t = _t(spark, sf)
    early = F.col("run_id") <= AS_OF_RUN     # before any state is built
    return flat(fold.as_of(rebuild.versions_all(t.headers.where(early), t.lines.where(early)), AS_OF_RUN))


def q_order_previous_version(spark, sf):
    return flat(fold.previous_version(_versions(spark, sf), 2))


def q_order_history_sorted(spark, sf):
    w = Window.partitionBy("key_bucket", "order_id").orderBy(
        F.desc("occurred"), F.desc("received"), F.desc("run_id"))
    return flat(history.history_sorted(_versions(spark, sf).withColumn("place", F.row_number().over(w))))


def q_touched_per_run(spark, sf):
    t = _t(spark, sf)
    return history.touched_per_run(rebuild.touched_keys(t.headers, t.lines))


def q_deleted_orders(spark, sf):
    return flat(fold.tombstones(fold.fold_latest(_versions(spark, sf), keep_tombstones=True)))


def q_headerless_orders(spark, sf):
    return flat(history.headerless(fold.fold_latest(_versions(spark, sf))))


def q_line_counts_by_state(spark, sf):
    return history.lines_summary(fold.fold_latest(_versions(spark, sf)))


def _scratch(spark, what):
    """A fresh folder under the cluster's shared checkpoint dir."""
    import uuid
    from orderloom.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/orderloom-{what}-{uuid.uuid4().hex[:12]}"


def q_incremental_versions(spark, sf):
    """Versions written by the run-by-run incremental pipeline (store)."""
    from orderloom.plans.replay import replay_incremental
    store = replay_incremental(spark, sf, _scratch(spark, "incremental"))
    return flat(store.read("versions"))


def q_incremental_latest(spark, sf):
    """Latest orders read from the store: compacted base + versions since."""
    from orderloom.plans import incremental
    from orderloom.plans.replay import replay_incremental
    store = replay_incremental(spark, sf, _scratch(spark, "incremental"))
    return flat(incremental.latest(store))


def q_purged_deletes(spark, sf):
    """Deletes that the store holds after compactions with a retention time of
    900 seconds, past which a delete is key and sequence only."""
    from orderloom.plans import incremental
    from orderloom.plans.replay import replay_incremental
    store = replay_incremental(spark, sf, _scratch(spark, "incremental"))
    return flat(fold.tombstones(incremental.latest_state(store))).select("key_bucket", "order_id", "seq_string")


def q_incremental_versions_strict(spark, sf):
    """Strict versions written run by run, from compacted strict line states."""
    from orderloom.plans.replay import replay_incremental
    return flat(replay_incremental(spark, sf, _scratch(spark, "incremental"), mode="strict").read("versions"))


def q_evolved_headers(spark, sf):
    """Header records with the columns that turned up on the way, typed."""
    from orderloom.plans.evolution import read_typed
    from orderloom.plans.replay import replay_evolving
    store = replay_evolving(spark, sf, _scratch(spark, "evolving"))
    return read_typed(store, "raw_headers").select(
        "run_id", "key_bucket", "hid", "hdate", "hcust", "hcustname", "received", "priority", "channel")


def q_schema_versions(spark, sf):
    """Columns added and widened, by run."""
    from orderloom.plans.evolution import schema_versions
    from orderloom.plans.replay import replay_evolving
    return schema_versions(replay_evolving(spark, sf, _scratch(spark, "evolving")))


def q_stream_latest(spark, sf):
    """Latest orders from the Structured Streaming runner over the derived
    feeds dropped as JSON files run by run."""
    from orderloom.plans import incremental
    from orderloom.plans.replay import stream_replay
    store = stream_replay(spark, sf, _scratch(spark, "stream"))
    return flat(incremental.latest(store))


def q_records_as_json(spark, sf):
    """Every record of the feed files as JSON text with its file (both feed
    folders read at once through a glob), in the order of the run numbers in
    the paths, and read back into typed columns."""
    from orderloom.plans.replay import Replay
    root = _scratch(spark, "files")
    replay = Replay(spark, sf, f"{root}/feeds")
    for r in replay.runs:
        replay.export_json(f"{root}/in", r)
    text = history.records_as_json(spark, f"{root}/in/SO*/*")
    fields = F.from_json("json_string", "HID string, LID string, HDATE timestamp_ntz, LDATE timestamp_ntz, "
                         "HCUST string, HCUSTNAME string, PROD string, AMT double, RECEIVED timestamp_ntz")
    return text.select("run_id", "feed", fields.alias("r")).select(
        "run_id", "feed", F.col("r.HID").alias("hid"), F.col("r.LID").alias("lid"),
        F.coalesce("r.HDATE", "r.LDATE").alias("event_time"), F.col("r.HCUST").alias("hcust"),
        F.col("r.HCUSTNAME").alias("hcustname"), F.col("r.PROD").alias("prod"),
        F.col("r.AMT").alias("amt"), F.col("r.RECEIVED").alias("received"))


QUERIES: dict[str, Query] = {
    "replay_headers": q_replay_headers,
    "replay_lines": q_replay_lines,
    "key_bucket": q_key_bucket,
    "expect_headers": q_expect_headers,
    "expect_lines": q_expect_lines,
    "expectation_counts": q_expectation_counts,
    "quarantine": q_quarantine,
    "ingest_headers": q_ingest_headers,
    "ingest_lines": q_ingest_lines,
    "touched_keys": q_touched_keys,
    "header_latest_ts": q_header_latest_ts,
    "header_latest": q_header_latest,
    "header_latest_live": q_header_latest_live,
    "line_latest_ts": q_line_latest_ts,
    "line_latest": q_line_latest,
    "line_latest_strict": q_line_latest_strict,
    "order_lines": q_order_lines,
    "order_versions": q_order_versions,
    "order_versions_strict": q_order_versions_strict,
    "seq_string": q_seq_string,
    "orders_latest": q_orders_latest,
    "orders_latest_strict": q_orders_latest_strict,
    "orders_latest_window": q_orders_latest_window,
    "orders_as_of": q_orders_as_of,
    "order_previous_version": q_order_previous_version,
    "order_history_sorted": q_order_history_sorted,
    "touched_per_run": q_touched_per_run,
    "deleted_orders": q_deleted_orders,
    "headerless_orders": q_headerless_orders,
    "line_counts_by_state": q_line_counts_by_state,
    "incremental_versions": q_incremental_versions,
    "incremental_latest": q_incremental_latest,
    "purged_deletes": q_purged_deletes,
    "incremental_versions_strict": q_incremental_versions_strict,
    "evolved_headers": q_evolved_headers,
    "schema_versions": q_schema_versions,
    "stream_latest": q_stream_latest,
    "records_as_json": q_records_as_json,
}
