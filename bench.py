"""Benchmark of the headline queries.

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Each query is forced completely with the ``noop`` sink (no collect to the
driver).  ``incremental_run`` times one pipeline run (the last run of the
replayed feeds) against a store holding the runs before it, compacted; the
store is prepared untimed in a scratch folder under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orderloom import checkpoint_dir, get_spark  # noqa: E402
from orderloom.operators import fold  # noqa: E402
from orderloom.plans import incremental  # noqa: E402
from orderloom.plans.pipeline import replay_tables  # noqa: E402
from orderloom.plans.queries import flat  # noqa: E402
from orderloom.plans.rebuild import line_latest_all, touched_keys, versions_all  # noqa: E402
from orderloom.plans.replay import Replay  # noqa: E402
from orderloom.plans.store import Store  # noqa: E402


def _force(df):
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": "16g"})
    t = replay_tables(spark, sf_dir)

    plans = {
        "replay_ingest": lambda: t.headers.unionByName(t.lines, allowMissingColumns=True),
        "touched_keys": lambda: touched_keys(t.headers, t.lines),
        "line_latest": lambda: line_latest_all(t.headers, t.lines),
        "order_versions": lambda: flat(versions_all(t.headers, t.lines)),
        "orders_latest": lambda: flat(fold.fold_latest(versions_all(t.headers, t.lines))),
        "orders_latest_strict": lambda: flat(fold.fold_latest(
            versions_all(t.headers, t.lines, "strict"))),
        "orders_as_of": lambda: flat(fold.as_of(versions_all(
            t.headers.where("run_id <= 4"), t.lines.where("run_id <= 4")), 4)),
        "order_previous_version": lambda: flat(fold.previous_version(
            versions_all(t.headers, t.lines), 2)),
    }
    times = {}
    # warm-up (untimed): JIT of the operators, file listing
    _force(plans["replay_ingest"]())
    _force(plans["order_versions"]())
    for name, plan in plans.items():
        t0 = time.time()
        _force(plan())
        times[name] = round(time.time() - t0, 3)

    # one incremental run against a prepared store
    scratch = f"{checkpoint_dir(spark).rstrip('/')}/orderloom-bench-{uuid.uuid4().hex[:12]}"
    replay, store = Replay(spark, sf_dir, f"{scratch}/feeds"), Store(spark, f"{scratch}/store")
    *before, last = replay.runs
    for r in before:
        incremental.process_run(store, r, *replay.raw(r), compact_every=len(before))
    t0 = time.time()
    touched = incremental.process_run(store, last, *replay.raw(last), compact_every=None)
    _force(incremental.latest(store))
    times["incremental_run"] = round(time.time() - t0, 3)
    rows = {"headers": t.headers.count(), "lines": t.lines.count(), "touched_by_last_run": touched}

    print(json.dumps({"metric": "orderloom_headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": os.path.basename(sf_dir.rstrip("/")),
                      "cpus": cpus, "rows": rows}))
    spark.stop()


if __name__ == "__main__":
    main()
