"""orderloom: order change-feed analytics on PySpark.

Two raw change feeds (order headers and order lines; inserts, edits and
delete markers, late, early or malformed) are turned into

* ``order_versions`` - one rebuilt "header + array of live lines" row per
  touched order per run, and
* ``orders_latest`` - one current row per order, folded from the versions
  by sequence, honouring deletes.

Every operator takes and returns DataFrames, so batch jobs, the streaming
runner and the tests share them.
"""

from orderloom.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
