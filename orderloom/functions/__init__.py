"""Column expressions shared by all operators (all JVM-side built-ins)."""

from orderloom.functions.exprs import (  # noqa: F401
    key_bucket, header_deleted, line_deleted, amt_long, micros, seq_struct,
    seq_string, line_struct, lines_text, shard_of, received_from_path,
)
