"""Versions of the all-runs rebuild from gathered states: the same rows as the
join of line states with touched keys, without that join."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom.plans.queries import flat
from orderloom.plans.rebuild import _versions_joined, versions_all
from tests.helpers import ingested


def _feed():
    day = dt.datetime(2021, 12, 1)
    later = [day + dt.timedelta(days=n) for n in range(6)]
    headers, lines = [], []
    for o in range(40):
        for run in (None, 1, 2, 3):
            if (o + (run or 0)) % 3 == 0:
                headers.append((f"O{o}", later[o % 2], "" if (o + (run or 0)) % 7 == 0 else f"C{run}", "n",
                                later[(o + (run or 0)) % 4], run))
        for ln in range(o % 4):
            for run in (None, 1, 2, 4):
                # event and arrival time rise and fall, so that strict lines are lost
                row = (f"O{o}", f"L{ln}", later[(o * ln + (run or 0)) % 4], "P", float((o + ln + (run or 0)) % 3),
                       later[(o + ln * (run or 0)) % 5], run)
                lines += [row] * (1 + (o + ln) % 2)
    return headers, lines


@pytest.mark.parametrize("mode", ["argmax", "strict"])
def test_gathered_versions(spark, mode):
    h, l = ingested(spark, *_feed())
    df = flat(versions_all(h, l, mode))
    joined = flat(_versions_joined(h, l, mode, False, None)).select(*df.columns)
    assert sorted(map(str, df.collect())) == sorted(map(str, joined.collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


@pytest.mark.parametrize("mode", ["argmax", "strict"])
def test_incremental_many_keys_shuffles_each_side_once(spark, tmp_path, monkeypatch, mode):
    """Too many touched orders to broadcast: headers, lines and keys are each
    dealt out by the order once for a join, and the versions are the rebuild's."""
    from orderloom.plans import incremental
    from orderloom.plans.store import Store
    from tests.helpers import raw
    monkeypatch.setattr(incremental, "BROADCAST_KEYS_MAX_ROWS", 0)
    monkeypatch.setattr(incremental, "PUSHED_KEYS_MAX", 0, raising=False)
    headers, lines = [[r for r in rows if r[-1] is not None] for rows in _feed()]
    store, plans, write = Store(spark, str(tmp_path / "st")), [], Store.write_run

    def seen(self, name, df, *args, **kw):
        if name == "versions":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, name, df, *args, **kw)
    monkeypatch.setattr(Store, "write_run", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in (1, 2, 3, 4):
            h, l = [[r for r in rows if r[-1] == run] for rows in (headers, lines)]
            feeds = [df.withColumn("source_file", F.lit("f")) for df in raw(spark, h, l)]
            incremental.process_run(store, run, *feeds, mode=mode, compact_every=2)
        got = flat(store.read("versions"))
        want = flat(versions_all(*ingested(spark, headers, lines), mode)).select(*got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert max(p.count("Exchange hashpartitioning") for p in plans) <= 5


def test_versions_are_made_in_one_step(spark):
    """One window over the lines, and no chain of projections that would copy
    an order's arrays into a row for each of its versions."""
    h, l = ingested(spark, *_feed())
    plan = versions_all(h, l)._jdf.queryExecution().executedPlan().toString()
    tree = plan.split("\n\n")[0]
    assert tree.count("Window [") == 1
    assert tree.count("inline(") == 1 and "explode(" not in tree


def test_replayed_feeds_are_compiled(spark, tmp_path):
    """The generators of the derived feeds hold no lambda, which would be
    interpreted row by row; keys without values and repeated rows stay."""
    from orderloom.sources.feeds import replay_feed
    day = dt.datetime(1995, 1, 1)
    keys = [None, 1, 30, 77, 89, 97, 97 * 89, 97 * 89]
    spark.createDataFrame([(k, 1, day) for k in keys], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz"
                          ).write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(1, "n")], "c_custkey bigint, c_name string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(k, n, 1, 1, 5.0, "R", day) for k in keys for n in (None, 1, 2)],
                          "l_orderkey bigint, l_linenumber bigint, l_partkey bigint, l_suppkey bigint, "
                          "l_quantity double, l_returnflag string, l_shipdate timestamp_ntz"
                          ).write.parquet(f"{tmp_path}/lineitem.parquet")
    headers, lines = replay_feed(spark, str(tmp_path))
    for feed in (headers, lines):
        assert "lambda" not in feed._jdf.queryExecution().executedPlan().toString()

    def tally(df, *cols):
        return sorted(tuple(map(str, r)) for r in df.groupBy(*cols).count().collect())
    assert tally(lines, "hid", "lid") == sorted(
        [(h, l, str(n)) for h, n in (("None", 1), ("O1", 1), ("O30", 1), ("O77", 1), ("O89", 1), ("O97", 1), ("O8633", 2))
         for l in ("None", "L1", "L2") if (h, l) not in (("None", "L1"), ("O97", "None"), ("O8633", "None"))]
        + [("None", "L1", "4"), ("O97", "None", "2"), ("O8633", "None", "4")])
    assert tally(headers, "hid") == sorted([("O1", "1"), ("O30", "2"), ("O89", "2"), ("O97", "1"), ("None", "3"),
                                            ("O8633", "4")])
