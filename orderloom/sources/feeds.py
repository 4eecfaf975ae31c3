"""Change-feed sources.

* ``read_feed`` / ``stream_feed``: JSON lines files with fixed schema hints
  (batch and Structured Streaming); columns that the hints do not name stay in
  the VARIANT column ``extra``, and malformed records become rows without
  hinted values that the expectations then drop.
* ``replay_feed``: both feeds derived, with their run ids and arrival times,
  from the ``orders``/``customer``/``lineitem`` tables - a pure DataFrame job
  whose size grows with the tables.
* ``stamp_raw``: the raw (bronze) projection - run id, key bucket, all feed
  columns, event time with fallback, arrival time, source file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.exprs import key_bucket
from orderloom.schemas import (HEADER_FEED, LINE_FEED, MAX_FILES_PER_TRIGGER)

FEEDS = {"header": HEADER_FEED, "line": LINE_FEED}
EVENT_DATE = {"header": "hdate", "line": "ldate"}


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("source_file"),
                     F.col("_metadata.file_modification_time")
                     .cast("timestamp_ntz").alias("file_mtime"))


def read_feed(spark: SparkSession, path: str | list[str], kind: str,
              received_field: str | None = None) -> DataFrame:
    """Batch read of a JSON-lines feed with the schema hints of ``kind``.

    Each record is read as one VARIANT ``extra``; the hinted columns are
    extracted with their types, unknown ones stay in it
    (``variant_get(extra, '$.X', 'int')``).  A malformed record (e.g. a file
    holding ``//``) does not fail the read.
    """
    raw = spark.read.option("singleVariantColumn", "extra").json(path)
    return _from_variant(raw, feed_schema(kind, received_field))


def feed_schema(kind: str, received_field: str | None = None) -> T.StructType:
    """Schema hints of a feed; ``received_field`` adds an arrival-time field
    carried in the payload (e.g. stamped by the producer)."""
    s = FEEDS[kind]
    if received_field:
        s = T.StructType(s.fields + [T.StructField(received_field, T.TimestampNTZType())])
    return s


def stream_feed(spark: SparkSession, path: str, kind: str,
                max_files: int = MAX_FILES_PER_TRIGGER,
                received_field: str | None = None) -> DataFrame:
    """Incremental read like ``read_feed``: every new file of the folder (or
    glob) once, at most ``max_files`` files per micro-batch; existing files
    are included."""
    raw = (spark.readStream.option("maxFilesPerTrigger", max_files)
           .option("singleVariantColumn", "extra").schema("extra variant").json(path))
    return _from_variant(raw, feed_schema(kind, received_field))


def _from_variant(raw: DataFrame, schema: T.StructType) -> DataFrame:
    cols = [F.expr(f"try_variant_get(extra, '$.{f.name}', '{f.dataType.simpleString()}')")
            .alias(f.name.lower()) for f in schema.fields]
    return raw.select(*cols, "extra", F.col("_metadata.file_path").alias("source_file"),
                      F.col("_metadata.file_modification_time").cast("timestamp_ntz")
                      .alias("file_mtime"))


def scan_glob(spark: SparkSession, pattern: str) -> DataFrame:
    """Ad-hoc JSON scan over a glob (both feed folders at once, union of the
    inferred schemas) with the file of each record."""
    return _with_file(spark.read.json(pattern))


def stamp_raw(feed: DataFrame, kind: str, run_id: Column, received: Column,
              run_ts: Column | None = None) -> DataFrame:
    """Bronze projection of a feed batch.

    ``run_id`` and ``received`` are columns (a literal for one run, or data
    columns in a replay).  The event time falls back to the run time when the
    payload has none (for lines this is live: LDATE may be NULL).
    """
    run_ts = run_ts if run_ts is not None else F.localtimestamp()
    passthrough = [c for c in feed.columns if c not in ("run_id", "received")]
    return feed.select(
        run_id.cast("bigint").alias("run_id"),
        key_bucket("hid").alias("key_bucket"),
        *passthrough,
        F.coalesce(F.col(EVENT_DATE[kind]).cast("timestamp_ntz"),
                   run_ts.cast("timestamp_ntz")).alias("occurred"),
        received.cast("timestamp_ntz").alias("received"),
    )


# --- feed replay from the base tables -------------------------------------

def _days(ts: Column, n: Column) -> Column:
    return F.timestamp_add("DAY", n, ts)


def _file_of(feed: str) -> Column:
    """The file of a replayed record, named by its run."""
    run = F.coalesce(F.col("run_id").cast("string"), F.lit("null"))
    return F.concat(F.lit(f"replay/{feed}_"), run, F.lit(".json"))


def _some(always: Column, *others: tuple[Column, Column]) -> Column:
    """An array of the records whose condition is met, without a lambda: the
    generator that reads it stays compiled."""
    none = F.slice(F.array(always), 1, 0)
    return F.concat(F.array(always), *[F.when(c, F.array(r)).otherwise(none) for c, r in others])


def replay_feed(spark: SparkSession, sf_dir: str, run_base_year: int = 1994
                ) -> tuple[DataFrame, DataFrame]:
    """Both change feeds derived from the base tables at any scale.

    Header feed: ``orders`` joined to ``customer``; orders with
    ``o_orderkey % 11 = 0`` never get a header.  Every kept order has a *new*
    header; every third an *edit* 400 days later (every thirtieth a *delete*,
    empty customer); every seventh a *same-day correction*.  Line feed: every
    ``lineitem`` row; a returned line of quantity <= 10 arrives as a delete
    (amount 0).  Some records have faults, by key: header records without a
    customer (83), a date (89) or an order (97), line records without a line
    (97) or an order (89), all to be rejected; second lines without a date
    (101), first lines of amount 0.5 (103, a delete once truncated) and lines
    of fractional amounts (107).  Arrival times are derived from the keys, and the run of a
    record is its arrival year minus ``run_base_year``.

    Returns ``(header_feed, line_feed)`` with the feed columns plus
    ``received``, ``run_id`` and ``source_file``.
    """
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderdate")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select(
        "c_custkey", "c_name")
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        "l_returnflag", "l_shipdate")

    k = F.col("o_orderkey")
    hid = F.concat(F.lit("O"), k.cast("string"))
    cust = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    day = F.col("o_orderdate")

    def rec(hdate, hcust, hname, received, hid=hid):
        return F.struct(hid.alias("hid"), hdate.alias("hdate"), hcust.alias("hcust"),
                        hname.alias("hcustname"), received.alias("received"))

    versions = _some(
        rec(day, cust, F.col("c_name"), _days(day, k % 13)),
        (k % 3 == 0, rec(_days(day, F.lit(400)),
                         F.when(k % 30 == 0, F.lit("")).otherwise(cust),
                         F.concat(F.col("c_name"), F.lit("*")),
                         _days(day, 400 + k % 13))),
        (k % 7 == 0, rec(day, cust, F.concat(F.col("c_name"), F.lit("#")),
                         _days(day, 1 + k % 13))),
        (k % 83 == 0, rec(day, F.lit(None).cast("string"), F.col("c_name"), _days(day, k % 13))),
        (k % 89 == 0, rec(F.lit(None).cast("timestamp_ntz"), cust, F.col("c_name"),
                          _days(day, k % 13))),
        (k % 97 == 0, rec(day, cust, F.col("c_name"), _days(day, k % 13),
                          F.lit(None).cast("string"))),
    )
    headers = (orders.where(k % 11 != 0)
               .join(customer, F.col("o_custkey") == F.col("c_custkey"))
               .select(F.inline(versions))
               .withColumn("run_id", (F.year("received") - run_base_year).cast("bigint"))
               .withColumn("source_file", _file_of("SOH")))

    q, order, number = F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber")
    hid = F.concat(F.lit("O"), order.cast("string"))
    lid = F.concat(F.lit("L"), number.cast("string"))
    none = F.lit(None).cast("string")
    amt = (F.when((F.col("l_returnflag") == "R") & (q <= 10), F.lit(0.0))
           .when((order % 103 == 0) & (number == 1), F.lit(0.5))
           .when(order % 107 == 0, q + 0.75).otherwise(q).cast("double"))
    ids = _some(F.struct(hid.alias("hid"), lid.alias("lid")),
                ((order % 97 == 0) & (number == 1), F.struct(hid.alias("hid"), none.alias("lid"))),
                ((order % 89 == 0) & (number == 1), F.struct(none.alias("hid"), lid.alias("lid"))))
    lines = (lineitem.select(
        F.inline(ids),
        F.when((order % 101 != 0) | (number != 2), F.col("l_shipdate")).alias("ldate"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("prod"),
        amt.alias("amt"),
        _days(F.col("l_shipdate"), F.col("l_suppkey") % 97).alias("received"))
        .withColumn("run_id", (F.year("received") - run_base_year).cast("bigint"))
        .withColumn("source_file", _file_of("SOL")))
    return headers, lines


def replay_raw(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Bronze tables of the replayed feeds (all runs)."""
    h, l = replay_feed(spark, sf_dir)
    # A replay has no wall-clock run time: the arrival time stands in for it
    # where a record has no event time.
    return (stamp_raw(h, "header", F.col("run_id"), F.col("received"), F.col("received")),
            stamp_raw(l, "line", F.col("run_id"), F.col("received"), F.col("received")))
