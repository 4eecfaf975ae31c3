"""What the operators share: tables, row keys, cut lineage, sliced batches."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.session import checkpoint_dir

#: Rows of one Arrow batch handed to Python; bounds a worker's memory where
#: texts are long (the default of 10,000 rows assumes short ones).
BATCH_ROWS = 1000

#: Rows that a Python helper works on at once, inside a batch.
SLICE_ROWS = 256

#: Most bytes of a table that an operator broadcasts after measuring it.
BROADCAST_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepare(spark: SparkSession) -> None:
    """Session settings of the Arrow exchange (never raised, only lowered)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    A lost executor loses nothing, and a loop's plan stays small.
    """
    checkpoint_dir(df.sparkSession)  # sets one in local runs
    return df.checkpoint(eager=True)


class Folder:
    """A folder of its own in the shared checkpoint folder, for the tables of
    a loop.  A checkpoint keeps what the planner knows about its columns
    (constraints, orders, partitionings), which grows from round to round
    until planning takes longer than the work; a written table starts afresh.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.tables = 0

    def written(self, df: DataFrame) -> DataFrame:
        """``df`` written as the next table, and read from there."""
        at = f"{self.path}/{self.tables}"
        self.tables += 1
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def remove(self) -> None:
        """Delete the folder; nothing may read its tables any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove shuffle files that nothing refers to any more.

    Its cleaner follows the driver's garbage collection, which a driver with
    little to do puts off; the shuffles of a finished part would fill disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def row_key(*cols: str) -> Column:
    """64-bit key of a row's columns; equal rows share it, nulls count."""
    return F.xxhash64(*[F.struct(F.col(c).isNull(), F.col(c)) for c in cols])


def settled(df: DataFrame, **cols: Column) -> DataFrame:
    """``df`` with more columns, each worked out once.  A plain projection
    would be merged into what reads it, so that a lambda or a pushed-down
    filter would split the text again for every element; a generator of one
    row is not."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def map_slices(df: DataFrame, schema: str, setup: Callable[[], Callable],
               rows: int = SLICE_ROWS) -> DataFrame:
    """``mapInArrow`` over slices of at most ``rows`` rows.

    ``setup()`` runs once per task and returns a function from a RecordBatch
    to a RecordBatch, or to an iterator of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = setup()
        for b in batches:
            for at in range(0, b.num_rows, rows):
                out = f(b.slice(at, rows))
                if isinstance(out, pa.RecordBatch):
                    yield out
                else:
                    yield from out
    prepare(df.sparkSession)
    return df.mapInArrow(run, schema)
