"""Incremental month loads with Structured Streaming."""
