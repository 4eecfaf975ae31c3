"""A hot order (half of all line rows) in the all-runs rebuild: its line
states are salted over several tasks in the assembly join, and the result
is unchanged."""

import datetime as dt

from orderloom.plans.queries import flat
from orderloom.plans.rebuild import versions_all
from tests.helpers import ingested

def _feed():
    day = dt.datetime(2021, 12, 1)
    lines, headers = [], []
    for run in (1, 2, 3):
        for i in range(1500):  # the hot order: 4500 of ~9000 line rows
            lines.append(("HOT7", f"L{i}", day + dt.timedelta(days=run), "P", float(run + i % 5),
                          day + dt.timedelta(days=run, hours=1), run))
    for o in range(1500):
        for ln in range(3):
            run = 1 + (o + ln) % 3
            lines.append((f"O{o}", f"L{ln}", day + dt.timedelta(days=run), "P", 2.0,
                          day + dt.timedelta(days=run, hours=2), run))
        headers.append((f"O{o}", day, "C1", "n", day, 1))
    headers.append(("HOT7", day, "C9", "hot", day, 1))
    return headers, lines


def test_hot_order_salted_in_the_line_queries(spark):
    from orderloom.plans.rebuild import line_latest_all, line_latest_ts_all
    h, l = ingested(spark, *_feed())
    for f, kw in ((line_latest_ts_all, {}), (line_latest_all, {}), (line_latest_all, {"mode": "strict"})):
        plain = sorted(map(str, f(h, l, hot_order_states=None, **kw).collect()))
        df = f(h, l, hot_order_states=1000, **kw)
        assert "_salt" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, df.collect())) == plain


def test_hot_order_salted(spark):
    h_rows, l_rows = _feed()
    h, l = ingested(spark, h_rows, l_rows)
    plain = sorted(map(str, flat(versions_all(h, l, hot_order_states=None)).collect()))
    df = flat(versions_all(h, l, hot_order_states=1000))
    rows = sorted(map(str, df.collect()))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert rows == plain
    assert len([r for r in rows if "HOT7" in r]) == 3
