"""Hand-written edge cases (FIXTURES.md section 2, last paragraph)."""

import json

from orderloom.operators.fold import fold_latest
from orderloom.plans.rebuild import versions_all
from orderloom.sources.feeds import read_feed
from tests.helpers import RUN_TS, d, ingested

H = "SalesOrderHeader_"


def _v(spark, hrows, lrows, mode="argmax"):
    h, l = ingested(spark, hrows, lrows)
    return versions_all(h, l, mode)


def _by(df):
    return {(r.run_id, r.order_id.replace(H, "")): r for r in df.collect()}


def test_older_event_arriving_later(spark):
    lines = [("X1", "L1", d(5), "P1", 10.0, d(5), 1),
             ("X1", "L1", d(3), "P1", 20.0, d(6), 2)]
    arg = _by(_v(spark, [], lines))
    strict = _by(_v(spark, [], lines, "strict"))
    assert [x.amt for x in arg[(2, "X1")].lines] == [10]
    # strict: newest event, newest arrival and newest run are on different
    # rows -> the line vanishes
    assert strict[(2, "X1")].lines is None and strict[(2, "X1")].line_cnt == 0


def test_same_date_delete_wins(spark):
    for order in ([("X1", d(1), "C1", "a", d(1), 1), ("X1", d(1), "", "b", d(2), 2)],
                  [("X1", d(1), "", "b", d(1), 1), ("X1", d(1), "C1", "a", d(2), 2)]):
        v = _v(spark, order, [])
        assert _by(v)[(2, "X1")].is_order_deleted is True
        assert fold_latest(v).count() == 0


def test_amount_truncation_and_null(spark):
    lines = [("X1", "L1", d(1), "P", 0.4, d(1), 1), ("X1", "L2", d(1), "P", None, d(1), 1)]
    r = _by(_v(spark, [], lines))[(1, "X1")]
    assert r.line_cnt == 1 and [(x.line_id, x.amt) for x in r.lines] == [("SalesOrderLine_L2", None)]


def test_null_ldate_takes_run_time_and_missing_lid_dropped(spark):
    lines = [("X1", "L1", None, "P", 1.0, d(1), 1), ("X1", None, d(1), "P", 1.0, d(1), 1)]
    r = _by(_v(spark, [], lines))[(1, "X1")]
    assert r.line_cnt == 1 and r.lines[0].occurred == RUN_TS


def test_deleted_order_stays_deleted_then_revives(spark):
    hdr = [("X1", d(1), "C1", "a", d(1), 1), ("X1", d(2), "", "a", d(2), 2),
           ("X1", d(4), "C1", "b", d(4), 4)]
    lines = [("X1", "L1", d(3), "P", 1.0, d(3), 3)]
    v = _v(spark, hdr, lines)
    by = _by(v)
    assert by[(3, "X1")].is_order_deleted is True
    assert fold_latest(v.where("run_id <= 3")).count() == 0
    assert by[(4, "X1")].is_order_deleted is False
    assert [r.cust.name for r in fold_latest(v).collect()] == ["b"]


def test_reingested_file_only_wins_ties(spark):
    # run 3 re-ingests run 1's file: loses to the newer event of run 2 ...
    lines = [("X1", "L1", d(1), "P", 5.0, d(1), 1), ("X1", "L1", d(2), "P", 7.0, d(2), 2),
             ("X1", "L1", d(1), "P", 5.0, d(1), 3)]
    assert [x.amt for x in _by(_v(spark, [], lines))[(3, "X1")].lines] == [7]
    # ... but wins a tie on event and arrival time (the run id breaks it)
    lines = [("X1", "L1", d(1), "P", 5.0, d(1), 1), ("X1", "L1", d(1), "P", 7.0, d(1), 2),
             ("X1", "L1", d(1), "P", 5.0, d(1), 3)]
    assert [x.amt for x in _by(_v(spark, [], lines))[(3, "X1")].lines] == [5]


def test_malformed_and_unknown_columns(spark, tmp_path):
    p = tmp_path / "SOL_9.json"
    p.write_text("\n" + json.dumps({"HID": "X1", "LID": "L1", "LDATE": "2021-12-01",
                                    "AMT": 3, "COLOUR": "red"}) + "\n//\n")
    ev = read_feed(spark, str(p), "line")
    assert ev.count() == 2 and ev.where("hid IS NULL").count() == 1  # malformed -> no hinted value
    row = ev.where("hid IS NOT NULL").selectExpr(
        "hid", "ldate", "amt", "variant_get(extra, '$.COLOUR', 'string') AS colour").first()
    assert (row.hid, row.ldate.day, row.amt, row.colour) == ("X1", 1, 3.0, "red")


def test_exclude_deleted_headers_option(spark):
    from orderloom.operators.latest import header_latest, touched_keys
    from orderloom.plans.rebuild import header_latest_all
    hdr = [("X1", d(1), "C1", "a", d(1), 1), ("X1", d(1), "", "b", d(2), 2),
           ("X2", d(1), "", "z", d(1), 1)]
    h, l = ingested(spark, hdr, [])
    allruns = {(r.run_id, r.order_id.replace(H, "")): r
               for r in header_latest_all(h, l, exclude_deleted=True).collect()}
    # X1: the delete at the same date is ignored, the live row stays; X2: only a delete -> none
    assert set(allruns) == {(1, "X1"), (2, "X1")}
    assert allruns[(2, "X1")].cust.id == "C1" and allruns[(2, "X1")].is_order_deleted is False
    keys = touched_keys(h, l).where("run_id = 2")
    per_run = header_latest(keys, h, run_id=2, exclude_deleted=True).collect()
    assert [(r.order_id, r.cust.id) for r in per_run] == [(H + "X1", "C1")]


def test_q4_strict_duplicates_count_once(spark):
    # same line, same run, same times, different amounts: both rows hold all
    # three maxima -> two structs in the array, one distinct line id
    lines = [("X1", "L1", d(1), "P", 3.0, d(1), 1), ("X1", "L1", d(1), "P", 4.0, d(1), 1)]
    r = _by(_v(spark, [], lines, "strict"))[(1, "X1")]
    assert r.line_cnt == 1 and sorted(x.amt for x in r.lines) == [3, 4]
    a = _by(_v(spark, [], lines))[(1, "X1")]
    assert a.line_cnt == 1 and [x.amt for x in a.lines] == [4]


def test_q7_strict_rebuild_can_rank_below_older_version(spark):
    lines = [("X1", "L1", d(5), "P", 1.0, d(5), 1), ("X1", "L1", d(3), "P", 2.0, d(6), 2)]
    strict = fold_latest(_v(spark, [], lines, "strict")).collect()
    argmax = fold_latest(_v(spark, [], lines)).collect()
    assert [r.run_id for r in strict] == [1]   # the run-2 rebuild lost its line, lower seq
    assert [r.run_id for r in argmax] == [2]


def test_q8_struct_sequence_orders_before_1970(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from orderloom.functions.exprs import micros, seq_string, seq_struct
    # 1e17 + a negative value prints with 17 digits and then sorts after
    # every 18-digit part of a post-1970 time
    df = spark.createDataFrame([(dt.datetime(1970, 1, 2), 1),
                                (dt.datetime(1969, 12, 31), 2)], "ts timestamp_ntz, run bigint")
    rows = df.select(seq_struct(micros("ts"), F.lit(0), F.lit(0), F.col("run")).alias("seq")) \
        .select("seq", seq_string("seq").alias("s")).collect()
    by_struct = max(rows, key=lambda r: tuple(r.seq))
    by_string = max(rows, key=lambda r: r.s)
    assert by_struct.seq.run_id == 1      # 1970-01-02 is the newer one
    assert by_string.seq.run_id == 2      # the printed form gets it wrong


def test_q10_line_structs_carry_the_version_run(spark):
    lines = [("X1", "L1", d(1), "P", 1.0, d(1), 1), ("X1", "L2", d(2), "P", 1.0, d(2), 2)]
    for (run, _), r in _by(_v(spark, [], lines)).items():
        assert all(x.run_id == run for x in r.lines)
    assert {x.line_run_id for x in _by(_v(spark, [], lines))[(2, "X1")].lines} == {1, 2}
