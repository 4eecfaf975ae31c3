from pyspark.sql import functions as F

from orderloom.functions.exprs import (amt_long, header_deleted, key_bucket,
                                       line_deleted, lines_text, micros, seq_string,
                                       seq_struct)


def test_key_bucket(spark):
    df = spark.createDataFrame(
        [("H1",), ("29H99",), ("3H3333",), ("ABC",), ("1" * 25,), ("",), (None,), ("1A2",)],
        "hid string")
    got = [r.b for r in df.select(key_bucket("hid").alias("b")).collect()]
    assert got == [0, 2, 33, 0, 0, 0, 0, 0]


def test_delete_flags(spark):
    df = spark.createDataFrame([("", 0.4), ("C1", None), (None, 13.9), ("C2", -0.9)],
                               "hcust string, amt double")
    got = [tuple(r) for r in df.select(header_deleted("hcust"), line_deleted("amt"),
                                       amt_long("amt")).collect()]
    assert got == [(True, True, 0), (False, False, None), (False, False, 13), (False, True, 0)]


def test_seq_string_orders_like_tuple(spark):
    df = spark.createDataFrame([(5, 1, None, 2), (5, 10, 1, 1)],
                               "a bigint, b bigint, c bigint, d bigint")
    out = df.select(seq_struct(F.col("a"), F.col("b"), F.col("c"), F.col("d")).alias("seq"))
    rows = out.select("seq", seq_string("seq").alias("s")).collect()
    assert rows[0].s == "100000000000000005100000000000000001100000000000000000100000000000000002"
    assert sorted(rows, key=lambda r: r.s) == sorted(rows, key=lambda r: tuple(r.seq))


def test_micros_zone_free(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        v = spark.sql("SELECT TIMESTAMP_NTZ'2021-12-01 01:00:00.001001' AS t").select(
            micros("t").alias("m")).first().m
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert v == 1638320400001001


def test_lines_text(spark):
    df = spark.sql("""SELECT array(named_struct('line_id','L2','prod','P','amt',2L),
                                   named_struct('line_id','L1','prod',CAST(NULL AS STRING),'amt',1L)) AS lines
                      UNION ALL SELECT array() UNION ALL SELECT NULL""")
    got = [r.t for r in df.select(lines_text("lines").alias("t")).collect()]
    assert got == ["L1::1,L2:P:2", "", None]
