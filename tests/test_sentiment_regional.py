import math

import pytest
from pyspark.sql import functions as F

from opinion_spark.operators import regional, sentiment


def score(spark, text, lex):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return sentiment.lexicon_sentiment(df, lex).first()


@pytest.mark.parametrize("s,expected", [(1.9, 0.4404), (-2.3, -0.5106), (0.1, 0.0258)])
def test_compound_normalisation(spark, s, expected):
    assert score(spark, "word", {"word": s})["compound"] == expected


def test_negation_but_and_shares(spark):
    lex = {"good": 2.0, "bad": -2.0}
    r = score(spark, "not good", lex)
    assert r["compound"] == round(-1.48 / math.sqrt(1.48 ** 2 + 15), 4)
    r = score(spark, "good but bad", lex)  # 2*0.5 + (-2)*1.5 = -2
    assert r["compound"] == round(-2 / math.sqrt(4 + 15), 4)
    r = score(spark, "good day", lex)
    assert (r["positive"], r["neutral"], r["negative"]) == (0.75, 0.25, 0.0)
    assert score(spark, "", lex)["compound"] == 0.0


def test_party_labels(spark):
    rows = [(0.3, "biden"), (-0.3, "biden"), (0.3, "trump"), (-0.3, "trump"), (0.0258, "biden"), (0.3, "None"),
            (0.05, "biden"), (-0.05, "biden")]
    df = spark.createDataFrame(rows, "compound double, tweet_about string")
    got = [r["likely_party"] for r in sentiment.party_label(df).collect()]
    assert got == [1, 2, 2, 1, 0, 0, 1, 2]
    fb = spark.createDataFrame([(-0.03, -0.03, "biden")], "c double, f double, tweet_about string")
    assert sentiment.party_label_fallback(fb, "c", "f").first()["likely_party"] == 2


def test_context_filter(spark):
    toks = spark.createDataFrame([(1, 0, "he", "nsubj"), (1, 1, "really", "advmod"), (1, 2, "likes", "ROOT"),
                                  (1, 3, "cats", "dobj")], "doc_id long, pos int, token string, dep string")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    out = {r["doc_id"]: r["context"] for r in sentiment.context_filter(toks, docs=docs).collect()}
    assert out == {1: "he likes cats", 2: ""}


def shares(spark):
    df = spark.createDataFrame([("A", 6, 2), ("B", 2, 2), ("C", 0, 0)], "state string, n_dem long, n_rep long")
    return regional.two_class_proportions(df)


def test_proportions_rebalance_lead(spark):
    s = {r["state"]: r for r in shares(spark).collect()}
    assert (s["A"]["democratic_proportion"], s["B"]["democratic_proportion"]) == (0.75, 0.5)
    assert s["C"]["democratic_proportion"] is None
    base = shares(spark).where("state != 'C'")
    assert regional.class_totals(base).first()["tweet_ratio"] == 2.0
    rb = {r["state"]: r for r in regional.half_margin_lead(regional.rebalance(base)).collect()}
    assert rb["A"]["democratic_proportion"] == pytest.approx(60.0)
    assert rb["B"]["democratic_proportion"] == pytest.approx(33.333333, abs=1e-5)
    assert rb["A"]["lead_size"] == pytest.approx(10.0)
    assert rb["B"]["lead_size"] == pytest.approx(-16.666667, abs=1e-5)
    aw = {r["state"]: r["democratic_proportion"] for r in regional.activity_weighted(base).collect()}
    assert aw["A"] == pytest.approx(0.574074, abs=1e-6) and aw["B"] == pytest.approx(0.31)


def test_sentiment_difference_and_second_largest(spark):
    df = spark.createDataFrame([(1, 0.5), (1, -0.3), (2, 0.2)], "likely_party int, compound double")
    assert regional.sentiment_difference(df).first()[0] == pytest.approx(0.6)
    v = spark.createDataFrame([(5,), (9,), (9,), (1,)], "x int")
    assert regional.second_largest(v, "x").first()[0] == 9
    assert regional.second_largest(spark.createDataFrame([(4,)], "x int"), "x").first()[0] == 4


def test_melt_inverts_pivot(spark):
    df = spark.createDataFrame([("A", 1, 0), ("A", 2, 1), ("B", 3, 2)], "state string, id int, likely_party int")
    p = regional.class_pivot(df)
    m = regional.melt(p.select("state", "n_unsure", "n_dem", "n_rep"), ["state"], ["n_unsure", "n_dem", "n_rep"])
    assert m.agg(F.sum("count")).first()[0] == 3


def test_fold_and_join_paths_agree(spark):
    lex = {"good": 2.0, "bad": -2.0, "nice": 1.1, "awful": -2.5}
    texts = ["not good", "good but bad!", "never not nice at all?? really??", "", "plain words",
             "awful awful good but not bad", "don't like awful things!!!!!"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cols = ["doc_id", "positive", "neutral", "negative", "compound"]
    a = sorted(tuple(r) for r in sentiment.lexicon_sentiment(df, lex, method="fold").select(cols).collect())
    b = sorted(tuple(r) for r in sentiment.lexicon_sentiment(df, lex, method="join").select(cols).collect())
    assert a == b


def _compound(s):
    return round(s / math.sqrt(s * s + 15), 4)


@pytest.mark.parametrize("text,valence", [
    ("very good", 2.293), ("hardly good", 1.707), ("very bad", -2.293), ("barely bad", -1.707),
    ("very much good", 2 + 0.293 * 0.95), ("very much so good", (2 + 0.293) + 0.293 * 0.9),
    ("a GOOD day", 2.733), ("GOOD DAY", 2.0), ("a BAD day", -2.733), ("VERY good", 2 + 0.293 + 0.733),
    ("never so good", (2 + 0.293) * 1.25), ("never this good", 2.5), ("without doubt good", 2.0),
    ("least good", -1.48), ("at least good", 2.0), ("very least good", 2 + 0.293 * 0.95),
    ("not very good", (2 + 0.293) * -0.74), ("isn't really good", (2 + 0.293) * -0.74), ("never good", -1.48),
])
@pytest.mark.parametrize("method", ["fold", "join"])
def test_boosters_capitals_and_least(spark, text, valence, method):
    df = spark.createDataFrame([(text,)], "text string")
    got = sentiment.lexicon_sentiment(df, {"good": 2.0, "bad": -2.0}, method=method).first()["compound"]
    assert got == _compound(valence)


def test_rule_words_in_the_lexicon_do_not_boost_or_negate(spark):
    lex = {"good": 2.0, "very": 0.5, "not": -1.0}
    texts = [("very good",), ("not good",), (None,), ("",)]
    df = spark.createDataFrame(texts, "text string")
    for method in ("fold", "join"):
        got = {r["text"]: r["compound"] for r in sentiment.lexicon_sentiment(df, lex, method=method).collect()}
        assert got == {"very good": _compound(2.5), "not good": _compound(1.0), None: None, "": 0.0}


def test_context_of_a_parse(spark):
    df = spark.createDataFrame([([("he", "nsubj"), ("really", "advmod"), ("runs", "ROOT")],), ([],), (None,)],
                               "parse array<struct<token:string,dep:string>>")
    assert [r[0] for r in df.select(sentiment.context_of(df.parse)).collect()] == ["he runs", "", None]


def compound(total):
    return round(total / math.sqrt(total * total + 15), 4)


PHRASES = [  # text, sum of valences with good 1.9, bad -2.5, no -1.2, bomb 0.5, ass -0.5, die -2.0, heart 0.9
    ("he said this is the bomb", 3.0),  # an idiom up to the word
    ("the bomb", 0.5),  # needs three words before
    ("we all say it is bad ass there", 1.5 + 1.5),  # one from bad on, and the same up to ass
    ("food that is to die for", -2.0),  # the word in the middle is not looked at
    ("a good old bad ass there", 1.9 + 1.5 - 0.5),  # none with a word of the lexicon three places before: at ass
    ("oh yes that is a broken heart", -2.9),
    ("it is kind of good", 1.9 - 0.293),  # a softening pair
    ("it is sort of bad", -2.5 - 0.293),  # also of what is bad already
    ("kind of good", 1.9),
    ("there is no good here", 1.9 * -0.74),  # no before a word of the lexicon is none itself
    ("there is no really good", -1.2 + 1.9 * -0.74 + 0.293 * -1),
    ("no more or good", None),
    ("i say no", -1.2),
    ("good", 1.9), ("not good", 1.9 * -0.74), ("nobody good", 1.9),
]


@pytest.mark.parametrize("method", ["fold", "join"])
def test_phrases_and_no(spark, method):
    lex = {"good": 1.9, "bad": -2.5, "no": -1.2, "bomb": 0.5, "ass": -0.5, "die": -2.0, "heart": 0.9}
    df = spark.createDataFrame([(t,) for t, _ in PHRASES], "text string")
    got = {r.text: r.compound for r in sentiment.lexicon_sentiment(df, lex, method=method).collect()}
    for text, total in PHRASES:
        if total is not None:
            assert got[text] == pytest.approx(compound(total), abs=2e-4), text
    own = sentiment.lexicon_sentiment(df, lex, method=method, idioms={"say it is": 9.0, "this is the bomb": 1.0, "is the": 9.0, "yes that": 1.0})
    assert {r.text: r.compound for r in own.collect()}["he said this is the bomb"] == pytest.approx(compound(9.0), abs=2e-4)


def test_neutral_band(spark):
    """The band around 0 that counts as unsure is a parameter."""
    df = spark.createDataFrame([(c, a) for c in (-0.3, -0.05, -0.04, 0.0, 0.04, 0.05, 0.3) for a in ("biden", "trump")], "compound double, tweet_about string")
    for band in (0.05, 0.2, 0.0):
        got = {(r.compound, r.tweet_about): r.likely_party for r in sentiment.party_label(df, neutral_band=band).collect()}
        for (c, about), party in got.items():
            assert party == (0 if abs(c) < band else 1 if (c > 0) == (about == "biden") else 2) or c == 0.0
