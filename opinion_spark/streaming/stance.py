"""Per-region stance counts maintained incrementally.

The cleaning, mention, sentiment and label stages are row-local expressions,
so they apply unchanged to a streaming DataFrame. Keep-first dedup becomes
``dropDuplicates`` on the cleaned text (first arrival wins; with an
event-time column and watermark, ``dropDuplicatesWithinWatermark`` bounds
the state). The per-region class counts are a streaming aggregation whose
state is one row per region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, mentions, regional, sentiment


def stance_stream(posts: DataFrame, names: dict[str, list[str]], lexicon: dict[str, float],
                  regions: DataFrame | None = None, whole_word: bool = False,
                  event_time: str | None = None, watermark: str = "1 day") -> DataFrame:
    """Streaming (or batch) posts -> labelled, scored posts."""
    out = posts.withColumn("tweet", cleaning.replace_urls(F.col("tweet")))  # NULL texts count as copies of one
    if event_time:
        out = out.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(["tweet"])
    else:
        out = out.dropDuplicates(["tweet"])
    if regions is not None:
        out = cleaning.keep_regions(out, regions, "state")
    out = mentions.classify_mentions(out, names, "tweet", whole_word=whole_word)
    labels = list(names)
    out = mentions.exactly_one(out, labels).withColumn("processed", cleaning.strip_urls(F.col("tweet")))
    out = sentiment.lexicon_sentiment(out, lexicon, "processed").drop("processed")
    return sentiment.party_label(out, side_a=labels[1], side_b=labels[0])


def stance_counts_stream(posts: DataFrame, names, lexicon, regions: DataFrame | None = None,
                         whole_word: bool = False, event_time: str | None = None,
                         watermark: str = "1 day") -> DataFrame:
    """R3 + R4 + R5 on a stream: per-region class counts and proportions.

    Run with ``outputMode("complete")`` or ``("update")``; the counts' state is one
    row per region. Copies are remembered within the watermark of ``event_time``;
    without that column every text seen stays in the state.
    """
    scored = stance_stream(posts, names, lexicon, regions, whole_word, event_time, watermark)
    return regional.two_class_proportions(regional.class_pivot(scored))
