from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, mentions
from opinion_spark.sources.dims import MENTION_NAMES


def one(spark, expr, text):
    return spark.createDataFrame([(text,)], "t string").select(expr(F.col("t")).alias("x")).first()[0]


def test_url_placeholder_and_strip(spark):
    assert one(spark, cleaning.replace_urls, "a http://x.y/z b") == "a [] b"
    assert one(spark, cleaning.strip_urls, "a www.x.y b https://q c") == "a  b  c"
    assert one(spark, cleaning.normalize_text, "A \t\n B") == "a b"


def test_distinct_then_keep_first(spark):
    rows = [("same", "Texas", "A"), ("same", "Texas", "B")]
    a = cleaning.with_ordinal(spark.createDataFrame(rows[:1], "tweet string, state string, source string"), 0)
    b = cleaning.with_ordinal(spark.createDataFrame(rows[1:], "tweet string, state string, source string"), 1)
    u = cleaning.union_sources([a, b])
    assert cleaning.distinct_rows(u).count() == 2  # source differs
    kept = cleaning.keep_first(u, ["tweet"]).collect()
    assert len(kept) == 1 and kept[0]["source"] == "A"


def test_dedup_runs_before_region_filter(spark):
    df = spark.createDataFrame([("x", None, 0), ("x", "Texas", 1)], "tweet string, state string, _ord long")
    regions = spark.createDataFrame([("Texas",)], "state string")
    assert cleaning.clean_posts(df, "tweet", regions=regions).count() == 0


def test_mention_masks(spark):
    df = spark.createDataFrame([(None,), ("it was 1945",), ("Joe said",), ("Trump and Biden",), ("nothing",)],
                               "tweet string")
    out = mentions.classify_mentions(df, MENTION_NAMES).collect()
    by = {r["tweet"]: r for r in out}
    assert by[None]["mentions_trump"] is False and by[None]["tweet_about"] == "None"
    assert by["it was 1945"]["tweet_about"] == "trump"  # substring '45' (quirk Q3)
    assert by["Joe said"]["tweet_about"] == "biden"
    assert by["Trump and Biden"]["tweet_about"] == "None"
    assert mentions.exactly_one(mentions.classify_mentions(df, MENTION_NAMES), ["trump", "biden"]).count() == 2


def test_quirk_concatenated_name(spark):
    assert "DonaldDonald Trump" in MENTION_NAMES["trump"]


def test_whole_word_option(spark):
    df = spark.createDataFrame([("Joey",), ("Joe!",), ("éJoe",)], "tweet string")
    out = {r["tweet"]: r["mentions_biden"] for r in
           mentions.classify_mentions(df, {"trump": ["Trump"], "biden": ["Joe"]}, whole_word=True).collect()}
    assert out == {"Joey": False, "Joe!": True, "éJoe": False}


def test_stage_counts(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    out = {r["stage"]: r["n_rows"] for r in cleaning.stage_counts({"a": a, "b": a.where("x > 1")}).collect()}
    assert out == {"a": 2, "b": 1}
