"""Every registered query against its DuckDB oracle at sf0.001 (rows,
column names and an order-insensitive hash of the values)."""

import hashlib

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.md5("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows))
                       .encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, con, name):
    df = E.queries()[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    ocols = [x[0] for x in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "order_id" in df.columns


def test_every_query_has_oracle():
    trained = {q for q in E.queries() if q == "pipeline" or q[:2] == "op"}   # see tests/llm
    assert set(E.queries()) - trained <= set(E.oracle_sql())


def test_faulty_records_reach_the_quality_queries(spark, sf_small):
    n = {q: E.queries()[q](spark, sf_small).count() for q in (
        "replay_headers", "expect_headers", "replay_lines", "expect_lines")}
    assert n["expect_headers"] < n["replay_headers"] and n["expect_lines"] < n["replay_lines"]
    feeds = {r.feed for r in E.queries()["quarantine"](spark, sf_small).collect()}
    assert feeds == {"header", "line"}
