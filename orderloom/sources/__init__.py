"""Sources: JSON change-feed readers (batch and streaming), the feed replay
derived from the given base tables, and file ledgers."""

from orderloom.sources.feeds import (  # noqa: F401
    read_feed, stream_feed, replay_feed, stamp_raw, scan_glob,
)
