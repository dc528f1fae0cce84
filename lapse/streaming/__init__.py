"""Incremental (file-stream) variants of batch operators.

The reference has no event-time streaming; its only "stream" is chunked conversion of
large CSV files.  That maps to a Structured Streaming file source with
``trigger(availableNow=True)``: every new file is converted exactly once, progress
lives in a checkpoint, and a restarted job resumes where it stopped.
"""
