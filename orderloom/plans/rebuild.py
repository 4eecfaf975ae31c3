"""All runs in one job: every touched order's version at every run.

No driver loop over runs.  The state of a header or of a line after run r is
a running maximum over its runs (every "row at the maximum" rule is a struct
maximum, hence associative), so

1. per (order, run) the header partials are pre-aggregated (map-side
   combine) and a running window over the order's runs gives the header
   state at each touched run - a window over at most "runs per order" rows;
2. per (order, line, run) the line partials are pre-aggregated, and a running
   window over the line's runs gives one *line state* per run that touched
   the line, valid until the next such run (``valid_to``);
3. each touched (order, run) is joined to the line states valid at that run
   (equi-join on the order + range condition on the run) and assembled.

The versions of all but hot orders need no join: both feeds meet in one shuffle
by the order, and step 3 goes through the order's states (``_versions_gathered``).

The work grows with the states and the versions it emits, not with history
times runs.  A hot order's lines are spread by (order, line) in steps 1-2,
and in step 3 its states are salted by line over several tasks (its touched
keys repeated per salt); the assembly then merges the per-salt partials.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.assemble import VERSION_COLS, assemble_versions, versions_of_states
from orderloom.operators.latest import (KEY, LINE_KEY, LINE_LATEST_COLS,
                                        argmax_line_struct, header_partials,
                                        header_state)
from orderloom.operators.latest import touched_keys as latest_touched_keys
from orderloom.schemas import ORDER_KEY

_UNB = Window.unboundedPreceding
_CUR = Window.currentRow

# A (line, run) group with more rows than this is pre-combined before the
# line window (skew guard); the set of such groups is broadcast only when it
# has at most this many keys.
HOT_GROUP_ROWS = 100_000
BROADCAST_HOT_KEYS_MAX = 200_000
HOT_SAMPLE_FRACTION = 0.01
# An order with more line states than this is salted by line over
# HOT_ORDER_SALTS tasks in the assembly join.
HOT_ORDER_STATES = 200_000
HOT_ORDER_SALTS = 32


def header_states(headers: DataFrame, lines: DataFrame,
                  exclude_deleted: bool = False) -> DataFrame:
    """One row per touched (run_id, key_bucket, order_id) with the header
    state at that run (NULLs while the order has no header)."""
    hp = headers.select(*KEY, *header_partials(headers, exclude_deleted))
    nulls = [F.lit(None).cast(hp.schema[c].dataType).alias(c) for c in ("_hd", "_hr", "_hc")]
    # Keys touched by lines first, as a hash aggregate with map-side combine;
    # only then meet the (sort-aggregated) header structs.
    line_keys = lines.select(*KEY).distinct().select(*KEY, *nulls)
    per_run = (hp.unionByName(line_keys).groupBy(*KEY)
               .agg(F.max("_hd").alias("_hd"), F.max("_hr").alias("_hr"),
                    F.max("_hc").alias("_hc")))
    w = Window.partitionBy(*ORDER_KEY).orderBy("run_id").rowsBetween(_UNB, _CUR)
    return per_run.select(*KEY, *header_state(F.max("_hd").over(w), F.max("_hr").over(w),
                                              F.max("_hc").over(w), exclude_deleted))


def touched_keys(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """Distinct (run_id, key_bucket, order_id) of both feeds (hash aggregate
    with map-side combine)."""
    return latest_touched_keys(headers, lines)


def split_hot(df: DataFrame, keys: list[str], threshold: int = HOT_GROUP_ROWS,
              fraction: float = HOT_SAMPLE_FRACTION) -> tuple[DataFrame | None, DataFrame]:
    """Split ``df`` into rows of hot groups (about more than ``threshold``
    rows per ``keys``) and the rest.

    Hot groups are found on a row sample (``fraction``): only the sampled
    keys are shuffled and counted.  The sample only routes rows - every row
    stays in one of the two outputs.  A group near the threshold may be
    missed; it then takes the plain path, which is correct, just unsplit.
    The hot key set is at most rows / threshold; it is broadcast only when
    its counted size is under ``BROADCAST_HOT_KEYS_MAX``, otherwise the split
    is a shuffled semi/anti join.  Returns ``(None, df)`` when nothing is hot.
    """
    hot = hot_keys(df, keys, threshold, fraction)
    if hot is None:
        return None, df
    return df.join(hot, keys, "left_semi"), df.join(hot, keys, "left_anti")


def hot_keys(df: DataFrame, keys: list[str], threshold: int,
             fraction: float = HOT_SAMPLE_FRACTION, sample: DataFrame | None = None
             ) -> DataFrame | None:
    """Keys with more than about ``threshold`` rows, found on a row sample
    (``sample`` when one is shared).  A small, counted set is materialised
    as a local DataFrame and broadcast; a larger one stays a lazy DataFrame
    joined with a shuffle.  None when nothing is hot."""
    sampled = sample if sample is not None else \
        df.select(*keys).sample(withReplacement=False, fraction=fraction, seed=17)
    hot = (sampled.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
           .where(F.col("_n") > F.lit(threshold * fraction)).select(*keys))
    n_hot = hot.count()
    if n_hot == 0:
        return None
    if n_hot <= BROADCAST_HOT_KEYS_MAX:
        # bounded by the count just taken: safe to hold and broadcast
        return F.broadcast(df.sparkSession.createDataFrame(hot.collect(), hot.schema))
    return hot


def line_states(lines: DataFrame, mode: str = "argmax",
                hot_threshold: int | None = HOT_GROUP_ROWS,
                sample: DataFrame | None = None) -> DataFrame:
    """Line state after each run that touched the line, with its validity
    ``[valid_from, valid_to)`` in runs.

    ``argmax``: the greatest (occurred, received, run, prod, amt) row so far.
    ``strict``: rows of the touching run equal to the running maxima of event
    and arrival time (none -> the line is lost until touched again).
    ``maxima``: the three independent running maxima only (no row detail).

    ``argmax`` is one shuffle on the line and one sorted window pass: the
    running struct maximum over rows ordered by (run, ordering key), keeping
    the last row of each run.  Rows of hot (line, run) groups are first
    collapsed by a map-side-combined aggregate so no task receives them whole.
    """
    wl = Window.partitionBy(*LINE_KEY).orderBy("run_id")
    if mode == "argmax":
        rows = lines.select(*LINE_KEY, "run_id", argmax_line_struct().alias("_w"))
        if hot_threshold is not None:
            k = [*LINE_KEY, "run_id"]
            hk = hot_keys(rows, k, hot_threshold,
                          sample=None if sample is None else sample.select(*k))
            if hk is not None:
                hot = (rows.join(hk, k, "left_semi").groupBy(*k)
                       .agg(F.max("_w").alias("_w")))
                rows = rows.join(hk, k, "left_anti").unionByName(hot)
        w = Window.partitionBy(*LINE_KEY).orderBy("run_id", "_w")
        x = rows.select(*LINE_KEY, "run_id", F.max("_w").over(w.rowsBetween(_UNB, _CUR)).alias("_s"),
                        F.lead("run_id").over(w).alias("_next"))
        # The row after the last one of a run is the first of the next.
        last = x.where(F.col("_next").isNull() | (F.col("_next") != F.col("run_id")))
        return last.select(*LINE_KEY, F.col("run_id").alias("valid_from"),
                           F.col("_next").alias("valid_to"), "_s.*")
    if mode == "maxima":
        # fixed-width maxima: a hash aggregate with map-side combine
        per = lines.groupBy(*LINE_KEY, "run_id").agg(
            F.max("occurred").alias("occurred"), F.max("received").alias("received"))
        run = wl.rowsBetween(_UNB, _CUR)
        return per.select(*LINE_KEY, F.col("run_id").alias("valid_from"),
                          F.lead("run_id").over(wl).alias("valid_to"),
                          F.max("occurred").over(run).alias("occurred"),
                          F.max("received").over(run).alias("received"),
                          F.col("run_id").alias("line_run_id"))
    if mode == "strict":
        # Running maxima over one row a line and run (map-side combine); the
        # raw rows meet them on all values, so a hot line's are dealt out.
        per = lines.groupBy(*LINE_KEY, "run_id").agg(
            F.max("occurred").alias("_mo"), F.max("received").alias("_mr"))
        run = wl.rowsBetween(_UNB, _CUR)
        top = per.select(*LINE_KEY, "run_id", F.lead("run_id").over(wl).alias("valid_to"),
                         F.max("_mo").over(run).alias("occurred"),
                         F.max("_mr").over(run).alias("received"))
        rows = lines.select(*LINE_KEY, "run_id", "occurred", "received", "prod", "amt", "is_line_deleted")
        return (rows.join(top, [*LINE_KEY, "run_id", "occurred", "received"])
                .select(*LINE_KEY, F.col("run_id").alias("valid_from"), "valid_to",
                        "occurred", "received", F.col("run_id").alias("line_run_id"),
                        "prod", "amt", "is_line_deleted"))
    raise ValueError(f"unknown line mode {mode!r}")


def _salt_hot_orders(keys: DataFrame, states: DataFrame, threshold: int | None,
                     salts: int, sample: DataFrame | None = None
                     ) -> tuple[DataFrame, DataFrame, bool]:
    """Spread hot orders over ``salts`` join tasks.

    Orders with more than about ``threshold`` line states (found on a sample,
    see ``split_hot``) get ``_salt = pmod(xxhash64(line_id), salts)`` on the
    state side, and their touched keys are repeated once per salt; every
    other order has salt 0 on both sides.  Without hot orders nothing is
    added.  Returns (keys, states, salted).
    """
    if threshold is None:
        return keys, states, False
    hk = hot_keys(states, ORDER_KEY, threshold,
                  sample=None if sample is None else sample.select(*ORDER_KEY))
    if hk is None:
        return keys, states, False
    hot = hk.select(*ORDER_KEY, F.lit(True).alias("_hot"))
    st = (states.join(hot, ORDER_KEY, "left")
          .withColumn("_salt", F.when(F.col("_hot"), F.pmod(F.xxhash64("line_id"), F.lit(salts)))
                      .otherwise(F.lit(0)).cast("int")).drop("_hot"))
    ks = (keys.join(hot, ORDER_KEY, "left")
          .withColumn("_salt", F.explode(F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
                                         .otherwise(F.array(F.lit(0))))).drop("_hot"))
    return ks, st, True


def _lines_at_touched(keys: DataFrame, states: DataFrame, how: str,
                      hot_threshold: int | None = None, salts: int = HOT_ORDER_SALTS,
                      sample: DataFrame | None = None) -> DataFrame:
    """Touched keys x line states valid at the key's run (equi-join on the
    order, range condition on the run).  Hot orders are salted by line so
    their states spread over ``salts`` tasks (see ``_salt_hot_orders``)."""
    keys, states, salted = _salt_hot_orders(keys, states, hot_threshold, salts, sample)
    s = states.alias("s")
    k = keys.alias("k")
    cond = [F.col("s.key_bucket") == F.col("k.key_bucket"),
            F.col("s.order_id") == F.col("k.order_id"),
            F.col("s.valid_from") <= F.col("k.run_id"),
            F.col("s.valid_to").isNull() | (F.col("k.run_id") < F.col("s.valid_to"))]
    if salted:
        # only when hot orders exist: otherwise the join keeps the (bucket,
        # order) partitioning of both inputs and of the assembly after it
        cond.append(F.col("s._salt") == F.col("k._salt"))
    return s.join(k, cond, how)


def header_latest_all(headers: DataFrame, lines: DataFrame,
                      exclude_deleted: bool = False) -> DataFrame:
    return (header_states(headers, lines, exclude_deleted)
            .where(F.col("occurred").isNotNull()))


def header_latest_ts_all(headers: DataFrame, lines: DataFrame) -> DataFrame:
    return header_latest_all(headers, lines).select(*KEY, "occurred")


def line_latest_ts_all(headers: DataFrame, lines: DataFrame,
                       hot_order_states: int | None = HOT_ORDER_STATES) -> DataFrame:
    keys = touched_keys(headers, lines)
    j = _lines_at_touched(keys, line_states(lines, "maxima"), "inner", hot_order_states,
                          sample=line_sample(lines))
    return j.select("k.run_id", "k.key_bucket", "k.order_id", "s.line_id", "s.occurred",
                    "s.received", "s.line_run_id")


def line_latest_all(headers: DataFrame, lines: DataFrame, mode: str = "argmax",
                    hot_order_states: int | None = HOT_ORDER_STATES) -> DataFrame:
    """Current lines of every touched order at every run; hot orders are
    salted by line as in ``versions_all``."""
    keys, sample = touched_keys(headers, lines), line_sample(lines)
    j = _lines_at_touched(keys, line_states(lines, mode, sample=sample), "inner", hot_order_states,
                          sample=sample)
    return j.select("k.run_id", "k.key_bucket", "k.order_id",
                    *[f"s.{c}" for c in LINE_LATEST_COLS[3:]])


def line_sample(lines: DataFrame) -> DataFrame:
    """A 1% sample of the line keys, for the hot-key checks; it only routes."""
    return (lines.select(*LINE_KEY, "run_id")
            .sample(withReplacement=False, fraction=HOT_SAMPLE_FRACTION, seed=17))


def _cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the cluster's shared checkpoint folder (reliable
    checkpoint, never a local one) so later failures do not recompute it."""
    from orderloom.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def versions_all(headers: DataFrame, lines: DataFrame, mode: str = "argmax",
                 cut_lineage: bool = False,
                 hot_order_states: int | None = HOT_ORDER_STATES) -> DataFrame:
    """Every version of every touched order (the version history), one job.

    Both feeds are shuffled once, by the order, and an order's states are
    gathered there; its versions are then made row by row.  Hot orders (found
    on a 1% sample of the lines, which only routes) take ``_versions_joined``.

    ``cut_lineage`` checkpoints the states (written to
    ``spark.checkpoint.dir``) before the assembly: on a large cluster a
    lost executor then costs the assembly stage, not the scans and windows."""
    hot = None if hot_order_states is None else hot_keys(lines, ["order_id"], hot_order_states)
    if hot is None:
        return _versions_gathered(headers, lines, mode, cut_lineage)
    h, l = [(df.join(hot, "order_id", "left_semi"), df.join(hot, "order_id", "left_anti"))
            for df in (headers, lines)]
    return (_versions_joined(h[0], l[0], mode, cut_lineage, hot_order_states)
            .unionByName(_versions_gathered(h[1], l[1], mode, cut_lineage)))


def _versions_gathered(headers: DataFrame, lines: DataFrame, mode: str, cut_lineage: bool) -> DataFrame:
    """``versions_all`` of orders that each fit a task: header and line rows in
    one shuffle by the order, line states by windows in it, one row an order
    that holds its states, and one version for each run that touched it.  The
    work is that of the states and, for each version, a pass over the states
    of its order."""
    if mode not in ("argmax", "strict"):
        raise ValueError(f"unknown line mode {mode!r}")
    hp = (headers.select(*KEY, *header_partials(headers)).groupBy(*KEY)
          .agg(*[F.max(c).alias(c) for c in ("_hd", "_hc")]))
    # ``_hc`` begins with the fields of ``_hr``, so its maximum holds that one's.
    hp = hp.select(*ORDER_KEY, "run_id", F.struct("run_id", "_hd", "_hc").alias("_h"),
                   F.lit(True).alias("_is_header"))
    rows = lines.select(*LINE_KEY, "run_id", argmax_line_struct().alias("_w"),
                        F.lit(False).alias("_is_header"))
    both = rows.unionByName(hp, allowMissingColumns=True).repartition(*ORDER_KEY)
    part = [*LINE_KEY, "_is_header"]
    by_run = Window.partitionBy(*part).orderBy("run_id")
    keys = [*part, "run_id", "_h"]
    # The last row of its run; a row without a run touches the order too.
    last = F.col("_next").isNull() | ~F.col("_next").eqNullSafe(F.col("run_id"))
    if mode == "argmax":
        w = Window.partitionBy(*part).orderBy("run_id", "_w")
        x = both.select(*keys, F.max("_w").over(w.rowsBetween(_UNB, _CUR)).alias("_w"),
                        F.lead("run_id").over(w).alias("_next"))
        # The row after the last one of a run is the first of the next.
        x = x.where(F.col("_is_header") | last)
        x = x.select(*keys, "_w", F.col("_next").alias("valid_to"))
    else:
        # A row that misses a maximum stays only to tell that its run touched the order.
        so_far = by_run.rangeBetween(_UNB, _CUR)
        later = Window.partitionBy(*part).orderBy(F.desc("run_id")).rangeBetween(_UNB, -1)
        won = ((F.col("_w.occurred") == F.max("_w.occurred").over(so_far))
               & (F.col("_w.received") == F.max("_w.received").over(so_far)) & F.col("line_id").isNotNull())
        x = both.select(*keys, "_w", F.coalesce(won, F.lit(False)).alias("won"),
                        F.lead("run_id").over(by_run).alias("_next"))
        x = x.where(F.col("_is_header") | F.col("won") | last)
        x = x.select(*keys, "_w", "won", F.min("run_id").over(later).alias("valid_to"))
    won = ["won"] if mode == "strict" else []
    state = F.struct("line_id", "_w.is_line_deleted", F.col("_w.occurred").alias("l_occurred"),
                     F.col("_w.received").alias("l_received"), "_w.line_run_id", "_w.prod", "_w.amt",
                     F.col("run_id").alias("valid_from"), "valid_to", *won)
    orders = x.groupBy(*ORDER_KEY).agg(
        F.collect_list(F.when(~F.col("_is_header"), state)).alias("_states"),
        F.collect_list("_h").alias("_headers"))
    if cut_lineage:
        orders = _cut(orders)
    runs = F.array_distinct(F.concat("_states.valid_from", "_headers.run_id"))

    def at(run: Column) -> Column:
        def current(x: Column) -> Column:
            held = (x["valid_from"] <= run) & (x["valid_to"].isNull() | (run < x["valid_to"]))
            return x["won"] & held if won else held
        return F.struct(run.alias("run_id"), F.filter("_states", current).alias("_cur"),
                        F.filter("_headers", lambda h: h["run_id"].isNull() | (h["run_id"] <= run)).alias("_before"))

    def header(x: Column) -> Column:
        return F.struct(x["run_id"].alias("run_id"), x["_cur"].alias("_cur"),
                        *[F.array_max(x["_before"][c]).alias(c) for c in ("_hd", "_hc")])

    def touched(x: Column) -> Column:
        deleted, occurred, received, cust = header_state(x["_hd"], x["_hc"], x["_hc"])
        return F.struct(x["run_id"].alias("run_id"), deleted, occurred.alias("h_occurred"),
                        received.alias("h_received"), cust, x["_cur"].alias("_cur"))
    rows = F.transform(F.transform(F.transform(runs, at), header), touched)
    return (orders.select(*ORDER_KEY, F.inline(versions_of_states(rows, mode == "strict")))
            .select(*VERSION_COLS))


def _versions_joined(headers: DataFrame, lines: DataFrame, mode: str, cut_lineage: bool,
                     hot_order_states: int | None) -> DataFrame:
    """``versions_all`` with the line states joined to the touched keys, hot
    orders salted by line."""
    th = header_states(headers, lines).select(
        *KEY, "is_order_deleted", F.col("occurred").alias("h_occurred"),
        F.col("received").alias("h_received"), "cust")
    # one 1% sample of the line keys serves both hot-key checks (line rows
    # per (line, run) and per order); it is dropped once they are counted
    sample = line_sample(lines).persist()
    states = line_states(lines, mode, sample=sample)
    if cut_lineage:
        th, states = _cut(th), _cut(states)
    st = states.select(
        *LINE_KEY, "valid_from", "valid_to", "is_line_deleted",
        F.col("occurred").alias("l_occurred"), F.col("received").alias("l_received"),
        "line_run_id", "prod", "amt")
    j = _lines_at_touched(th, st, "right", hot_threshold=hot_order_states,
                          sample=sample).select(
        "k.run_id", "k.key_bucket", "k.order_id", "k.is_order_deleted", "k.h_occurred",
        "k.h_received", "k.cust", "s.line_id", "s.is_line_deleted", "s.l_occurred",
        "s.l_received", "s.line_run_id", "s.prod", "s.amt")
    sample.unpersist()
    return assemble_versions(j)
