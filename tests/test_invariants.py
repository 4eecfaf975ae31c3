"""Invariants of the fold and of incremental processing (sf0.001 feeds)."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators.fold import as_of, fold_latest
from orderloom.plans import incremental
from orderloom.plans.pipeline import replay_tables
from orderloom.plans.queries import flat
from orderloom.plans.rebuild import versions_all
from orderloom.plans.replay import Replay, replay_incremental
from orderloom.plans.store import Store


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("mode", ["argmax", "strict"])
def test_incremental_equals_rebuild(spark, sf_small, tmp_path, mode):
    store = replay_incremental(spark, sf_small, str(tmp_path / "st"), mode=mode, compact_every=3)
    t = replay_tables(spark, sf_small)
    reb = versions_all(t.headers, t.lines, mode)
    assert _same(flat(store.read("versions")), flat(reb))
    assert _same(flat(incremental.latest(store)), flat(fold_latest(reb)))
    assert _same(flat(incremental.latest(store, upto=2)), flat(as_of(reb, 2)))


@pytest.mark.parametrize("which", [1, 2, 3])
def test_run_again_changes_nothing(spark, sf_small, tmp_path, which):
    """Any run again with the same records, bases before and after it."""
    root = str(tmp_path / "st")
    replay = Replay(spark, sf_small, f"{root}/_replay")
    store = Store(spark, root)
    for r in replay.runs[:4]:
        incremental.process_run(store, r, *replay.raw(r), compact_every=2)
    content = lambda s: [sorted(map(str, flat(x).collect())) for x in (
        s.read("versions"), incremental.latest(s), incremental.latest(s, upto=replay.runs[1]))]
    before = content(store)
    r = replay.runs[which]
    incremental.process_run(store, r, *replay.raw(r), compact_every=2)
    assert content(Store(spark, root)) == before
    assert store.done_runs() == replay.runs[:4]


def test_older_run_with_more_records_reaches_later_runs(spark, sf_small, tmp_path):
    root = str(tmp_path / "st")
    replay = Replay(spark, sf_small, f"{root}/_replay")
    store, plain = Store(spark, root), Store(spark, f"{root}2")
    runs = replay.runs[:3]
    for r in runs:
        h, l = replay.raw(r)
        incremental.process_run(store, r, h, l.limit(0) if r == runs[1] else l, compact_every=1)
        incremental.process_run(plain, r, h, l, compact_every=None)
    incremental.process_run(store, runs[1], *replay.raw(runs[1]), compact_every=1)
    for read in (lambda s: s.read("versions"), incremental.latest):
        assert _same(flat(read(store)), flat(read(plain)))


def test_latest_independent_of_run_split(spark, sf_small):
    t = replay_tables(spark, sf_small)
    merged = [df.withColumn("run_id", ((F.col("run_id") + 1) / 2).cast("bigint"))
              for df in (t.headers, t.lines)]
    cols = ["order_id", "occurred", "received", "is_order_deleted", "cust_id", "cust_name",
            "line_cnt", "lines_text"]
    a = flat(fold_latest(versions_all(t.headers, t.lines))).select(*cols)
    b = flat(fold_latest(versions_all(*merged))).select(*cols)
    assert _same(a, b)


def test_fold_properties(spark, sf_small):
    t = replay_tables(spark, sf_small)
    v = versions_all(t.headers, t.lines).cache()
    lat = fold_latest(v)
    assert lat.count() == lat.select("order_id").distinct().count()
    last = v.agg(F.max("run_id")).first()[0]
    assert _same(flat(as_of(v, last)), flat(lat))
    assert _same(flat(fold_latest(v.repartition(7).orderBy(F.rand(3)))), flat(lat))
    v.unpersist()


def test_hot_group_split_same_result(spark, sf_small):
    from orderloom.plans.rebuild import line_states
    t = replay_tables(spark, sf_small)
    plain = line_states(t.lines, hot_threshold=None)
    # threshold 0: every sampled (line, run) group takes the pre-combined path
    assert _same(plain, line_states(t.lines, hot_threshold=0))


def test_split_hot_keeps_every_row(spark):
    from orderloom.plans.rebuild import split_hot
    df = spark.range(20000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id")
    hot, cold = split_hot(df, ["k"], threshold=1000, fraction=0.2)
    assert [r.k for r in hot.select("k").distinct().collect()] == [0]
    assert hot.count() + cold.count() == 20000
    assert cold.where("k = 0").count() == 0


def test_cut_lineage_same_result(spark, sf_small):
    t = replay_tables(spark, sf_small)
    assert _same(flat(versions_all(t.headers, t.lines)),
                 flat(versions_all(t.headers, t.lines, cut_lineage=True)))
