"""Entry A: posts -> stance labels -> predicted lead per region."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, graph, hashtags, mentions, regional, sentiment


def labelled_posts(posts: DataFrame, regions: DataFrame, names: dict[str, list[str]],
                   whole_word: bool = False) -> DataFrame:
    """C3-C6 then C9-C12: cleaned, de-duplicated, regional posts with a label."""
    cleaned = cleaning.clean_posts(posts, "tweet", regions=regions, state_col="state")
    return mentions.classify_mentions(cleaned, names, "tweet", whole_word=whole_word)


def scored_posts(labelled: DataFrame, labels: list[str], lexicon, neutral_band: float = 0.05,
                 costs: DataFrame | None = None, parse: Callable[[Column], Column] | None = None,
                 idioms: dict[str, float] = sentiment.IDIOMS) -> DataFrame:
    """Posts with exactly one side, scored and labelled.

    With ``costs`` (C16) hashtags become their words; the posts are then written
    once in the shared folder, since the tags and the texts around them are read
    apart. With ``parse`` (a column function giving an array of ``(token, dep)``)
    only the context tokens are scored.
    """
    one = mentions.exactly_one(labelled, labels)
    one = one.withColumn("processed", cleaning.strip_urls(F.col("tweet")))
    if costs is not None:
        one = hashtags.replace_hashtags(graph._checkpoint(one), costs, text="processed")
    if parse is not None:
        one = one.withColumn("processed", sentiment.context_of(parse(F.col("processed"))))
    scored = sentiment.lexicon_sentiment(one, lexicon, text="processed", idioms=idioms).drop("processed")
    return sentiment.party_label(scored, neutral_band=neutral_band,
                                 side_a=labels[1], side_b=labels[0])


def state_shares(scored: DataFrame, codes: DataFrame) -> DataFrame:
    """R1-R5 in one aggregation, R2 lookup on the small result."""
    pivot = regional.class_pivot(scored, "state", "likely_party")
    pivot = pivot.withColumn("tweet_count", F.col("total"))
    props = regional.two_class_proportions(pivot)
    return regional.lookup(props, codes, "state")


def predicted_lead(shares: DataFrame) -> DataFrame:
    """Rebalance by the global class ratio, then the lead."""
    out = regional.rebalance(shares)
    return regional.half_margin_lead(out)


def run(posts: DataFrame, regions: DataFrame, codes: DataFrame, names, lexicon,
        whole_word: bool = False, costs: DataFrame | None = None, parse=None,
        idioms: dict[str, float] = sentiment.IDIOMS) -> DataFrame:
    labelled = labelled_posts(posts, regions, names, whole_word)
    scored = scored_posts(labelled, list(names), lexicon, costs=costs, parse=parse, idioms=idioms)
    shares = state_shares(scored, codes)
    return predicted_lead(shares).select(
        "state", "state_code", "tweet_count", "n_unsure", "n_dem", "n_rep", "total",
        F.round("democratic_proportion", 9).alias("democratic_proportion"),
        F.round("republican_proportion", 9).alias("republican_proportion"),
        F.round("lead_size", 9).alias("lead_size"))
