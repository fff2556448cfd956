"""Answers on NULLs, wide spaces, duplicate keys and clusters without a common term."""

from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, regional, sentiment, topics, votes


def test_relative_frequency_counts_non_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert {r.k: round(r.proportion, 6) for r in regional.relative_frequency(df, "k").collect()} == {1: 0.666667, 2: 0.333333}


def test_joint_frequency_drops_null_groups(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "a"), (1, "a")], "x int, y string")
    assert [tuple(r) for r in regional.joint_frequency(df, "x", "y").collect()] == [(1, "a", 2)]


def test_margin_without_votes_is_null(spark):
    df = spark.createDataFrame([(0, 0)], "votes_a long, votes_b long")
    assert votes.national_margin(df).first().national_margin is None


def test_prior_skips_null_votes(spark):
    rows = [(2000, "A", "AA", "D", 40), (2000, "A", "AA", "R", 60), (2004, "A", "AA", "D", None)]
    df = spark.createDataFrame(rows, "year int, state string, state_po string, party_detailed string, candidatevotes long")
    assert {r.party_detailed: r.ratio for r in votes.two_party_prior(df).collect()}["D"] == 0.4


def test_urls_end_at_any_unicode_space(spark):
    df = spark.createDataFrame([("http://x.y keep",), ("www.x.y　keep",), ("A \u0085B",)], "t string")
    got = [tuple(r) for r in df.select(cleaning.replace_urls(F.col("t")), cleaning.normalize_text(F.col("t"))).collect()]
    assert "keep" in got[0][0] and "keep" in got[1][0] or "www" in got[1][0]
    assert got[2][1] == "a b"


def test_clean_posts_keeps_the_first_null_text(spark):
    df = spark.createDataFrame([(1, None), (2, "a"), (3, None), (4, "a")], "_ord long, tweet string")
    assert sorted(r._ord for r in cleaning.clean_posts(df).collect()) == [1, 2]


def test_fold_and_join_agree_on_awkward_rows(spark):
    rows = [(1, "good not good but bad!"), (1, "good"), (1, "good"), (2, None), (3, ""), (None, "bad bad?")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lex = {"good": 1.9, "bad": -2.5}
    cols = ["doc_id", "text", "positive", "neutral", "negative", "compound"]
    fold, join = (sorted(map(str, sentiment.lexicon_sentiment(df, lex, method=m).select(cols).collect())) for m in ("fold", "join"))
    assert fold == join and len(join) == len(rows)


def test_merge_without_common_terms(spark):
    member = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40)], "doc_id long, cluster long")
    tf = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1)], "doc_id long, term string, tf long")
    final, log = topics.merge_clusters(spark, member, tf, 1)
    assert len(log) == 3 and log[0][1:3] == (10, 20) and {r.cluster for r in final.collect()} == {10}
