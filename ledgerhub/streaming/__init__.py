"""Incremental jobs on Structured Streaming; a checkpoint takes the place of a watermark query."""
