"""Structured Streaming runner: both feed folders -> one micro-batch per run."""

from orderloom.streaming.runner import run_available, FeedRunner  # noqa: F401
