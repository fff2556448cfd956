"""Spark-native regional opinion analytics over short social-media posts.

Every operator takes and returns DataFrames and is built from built-in
expressions, joins, windows and aggregations so Catalyst can prune, push
down and plan them. See ``README.md`` for the operator map.
"""

from opinion_spark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
