"""Rows are dealt out by the order once, when they are ingested: runs,
compactions and the reading of the latest orders shuffle none of them."""

import pytest
from pyspark.sql import functions as F

from orderloom.operators.ingest import ingest_headers, ingest_lines
from orderloom.operators.quality import HEADER_EXPECTATIONS, LINE_EXPECTATIONS, expect_or_drop
from orderloom.plans import incremental
from orderloom.plans import store as S
from orderloom.plans.queries import flat
from orderloom.plans.rebuild import versions_all
from orderloom.plans.store import Store
from tests.helpers import d, raw


def _records(run):
    """Orders 1 to 40, half of them in each run, some deleted, some without a
    header; lines come again, twice over in one run, out of order and deleted."""
    ids = [i for i in range(1, 41) if (i + run) % 2]
    headers = [(f"H{i}", d(1 + (i * run) % 20), "" if (i + run) % 13 == 0 else f"C{i}", f"N{run}",
                d(1 + run, i % 24), run) for i in ids if i % 5]
    lines = [(f"H{i}", f"L{j}", d(1 + (i * run + j) % 20), f"P{k}", float((i + j + run) % 4), d(1 + run, j), run)
             for i in ids for j in (1, 2, 3) for k in range(1 + (i + j) % 2)]
    return headers, lines


RUNS = (1, 2, 3, 4, 5)


def _process(spark, store, run, mode):
    feeds = [x.withColumn("source_file", F.lit("f")) for x in raw(spark, *_records(run))]
    incremental.process_run(store, run, *feeds, mode=mode, compact_every=2)


def _want(spark, mode):
    h, l = ([r for run in RUNS for r in _records(run)[k]] for k in (0, 1))
    rh, rl = raw(spark, h, l)
    return versions_all(ingest_headers(expect_or_drop(rh, HEADER_EXPECTATIONS)),
                        ingest_lines(expect_or_drop(rl, LINE_EXPECTATIONS)), mode)


def _rows(df, columns=None):
    return sorted(map(str, df.select(*(columns or df.columns)).collect()))


@pytest.mark.parametrize("mode", ["argmax", "strict"])
def test_runs_shuffle_no_rows_by_the_order(spark, tmp_path, monkeypatch, mode):
    monkeypatch.setattr(incremental, "BROADCAST_KEYS_MAX_ROWS", 0)
    monkeypatch.setattr(incremental, "PUSHED_KEYS_MAX", 0)
    store, plans = Store(spark, str(tmp_path / "st")), {}
    write_run, write_base = Store.write_run, Store.write_base

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def seen_run(self, name, df, *args, **kw):
        plans.setdefault(name, []).append(plan(df))
        return write_run(self, name, df, *args, **kw)

    def seen_base(self, name, df, *args, **kw):
        plans.setdefault(name, []).append(plan(df))
        return write_base(self, name, df, *args, **kw)
    monkeypatch.setattr(Store, "write_run", seen_run)
    monkeypatch.setattr(Store, "write_base", seen_base)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for run in RUNS:
            _process(spark, store, run, mode)
        latest = plan(incremental.latest(store))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    line_base = incremental.LINE_BASE[mode]
    assert len(plans["versions"]) == 5 and len(plans["latest"]) == len(plans[line_base]) == 2
    for name in ("touched_keys", "versions", "latest", "header_state", line_base):
        assert not [p for p in plans[name] if "Exchange" in p], name
    assert "Exchange" not in latest
    got = flat(store.read("versions"))
    assert _rows(got) == _rows(flat(_want(spark, mode)), got.columns)


@pytest.mark.parametrize("mode", ["argmax", "strict"])
def test_buckets_grow_and_stay_right(spark, tmp_path, monkeypatch, mode):
    """Tables and bases in different numbers of buckets, opened by one runner
    after another, and a run that is written again: the rows are the rebuild's."""
    root = str(tmp_path / "st")
    for run in RUNS:
        store = Store(spark, root)
        # records outgrow the buckets in run 3
        monkeypatch.setattr(S, "BUCKET_BYTES", 2 << 20 if run < 3 else 1000)
        _process(spark, store, run, mode)
        seen = store.buckets()
        assert seen == 4 if run < 3 else seen > 4
    _process(spark, Store(spark, root), 3, mode)
    store = Store(spark, root)
    held = set()
    store.read("versions", dealt=held)
    assert {4, seen} <= held and None not in held
    got = flat(store.read("versions"))
    want = _want(spark, mode)
    assert _rows(got) == _rows(flat(want), got.columns)
    from orderloom.operators.fold import fold_latest
    got = flat(incremental.latest(store))
    assert _rows(got) == _rows(flat(fold_latest(want)), got.columns)


def test_a_folder_without_its_number_is_read_as_plain_files(spark, tmp_path):
    import os
    store = Store(spark, str(tmp_path / "st"))
    for run in (1, 2):
        _process(spark, store, run, "argmax")
    os.remove(f"{store.path('versions')}/run_id=1/{S.BUCKETS}{store.buckets()}")
    held = set()
    rows = store.read("versions", dealt=held)
    assert held == {None} and _rows(rows) == _rows(store.read("versions"))


def test_the_replayed_drops_are_compressed(spark, sf_small, tmp_path, monkeypatch):
    """The JSON drops of the streaming replay hold the feeds' records, compressed."""
    import glob

    from orderloom.plans import replay
    from orderloom.sources.feeds import replay_feed
    monkeypatch.setattr("orderloom.streaming.runner.run_available", lambda *a, **kw: None)
    replay.stream_replay(spark, sf_small, str(tmp_path))
    for name, feed in zip(replay.FIELDS, replay_feed(spark, sf_small)):
        files = glob.glob(f"{tmp_path}/in/{name}/*/part-*")
        assert files and all(f.endswith(".json.gz") for f in files)
        cols = [c.upper() for c in replay.FIELDS[name] if c not in ("hdate", "ldate", "received", "amt")]
        want = feed.where("run_id IS NOT NULL").select(*[F.col(c.lower()).alias(c) for c in cols])
        text = ", ".join(f"{c} string" for c in cols)
        assert _rows(spark.read.schema(text).json(f"{tmp_path}/in/{name}/*")) == _rows(want)
