"""Structured Streaming form of the row-local stages and regional counts."""

from opinion_spark.streaming.stance import stance_counts_stream  # noqa: F401
