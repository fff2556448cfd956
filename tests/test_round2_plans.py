"""Entry A with hashtags and context tokens, and the dimension tables."""

from pyspark.sql import functions as F

from opinion_spark.plans import predicted
from opinion_spark.sources import dims


def test_scored_posts_split_hashtags_and_read_the_context(spark):
    posts = spark.createDataFrame(
        [(1, "a #GoodDay www.x.y", "biden"), (2, "a #GoodDay", "trump"), (3, "good", "None"), (4, None, "biden")],
        "doc_id long, tweet string, tweet_about string")
    posts = posts.withColumns({"mentions_trump": F.col("tweet_about") == "trump", "mentions_biden": F.col("tweet_about") == "biden"})
    costs = spark.createDataFrame([("good", 1.0), ("day", 2.0)], "word string, cost double")
    parse = lambda text: F.transform(F.split(text, " "), lambda t: F.struct(
        t.alias("token"), F.when(t == "Good", "ROOT").otherwise("det").alias("dep")))
    plain = {r.doc_id: r for r in predicted.scored_posts(posts, ["trump", "biden"], {"good": 2.0}).collect()}
    assert (plain[1].compound, plain[1].likely_party) == (0.0, 0)  # the tag is one unknown token
    split = {r.doc_id: r for r in predicted.scored_posts(posts, ["trump", "biden"], {"good": 2.0}, costs=costs).collect()}
    assert [split[1].likely_party, split[2].likely_party, split[4].compound] == [1, 2, None]
    assert split[1].positive < 1.0
    context = {r.doc_id: r for r in predicted.scored_posts(
        posts, ["trump", "biden"], {"good": 2.0}, costs=costs, parse=parse).collect()}
    assert (context[1].positive, context[1].compound) == (1.0, split[1].compound)


def test_dimension_tables(spark):
    assert dims.us_states_df(spark).count() == len(dims.US_STATES)
    codes = {r[0]: r[1] for r in dims.state_codes_df(spark).collect()}
    assert codes == dims.STATE_CODES
    assert dims.state_centers_df(spark).join(dims.state_codes_df(spark), "state_code", "left_anti").count() == 0
    assert dims.mention_names_df(spark).select("label").distinct().count() == 2
    stops = [r[0] for r in dims.stop_words_df(spark).collect()]
    assert sorted(stops) == dims.topic_stop_words() and "the" in stops
    assert [r[0] for r in dims.stop_words_df(spark, ["b", "a", "b"]).orderBy("word").collect()] == ["a", "b"]
