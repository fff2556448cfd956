import pytest

from opinion_spark.operators import votes


def test_state_votes_and_margin(spark):
    rows = [("A", "JRB", 60), ("A", "DJT", 30), ("A", "X", 10), ("B", "JRB", 40), ("B", "DJT", 50), (None, "JRB", 5)]
    p = spark.createDataFrame(rows, "state_po string, candidate string, votes bigint")
    sv = votes.state_votes(p, "JRB", "DJT")
    out = {r["state_po"]: r for r in sv.collect()}
    assert out["A"]["total_votes"] == 100 and out["A"]["biden_pct"] == 60.0 and out["A"]["lead_size"] == 30.0
    assert out["B"]["total_votes"] == 90 and out["B"]["lead_size"] == pytest.approx(-11.1111, abs=1e-4)
    assert votes.national_margin(sv).first()["national_margin"] == pytest.approx(11.1111, abs=1e-4)
    pred = spark.createDataFrame([("A", 60.0, 40.0, 10.0), ("B", 33.3, 66.7, -16.6667)],
                                 "state_code string, democratic_proportion double, republican_proportion double, lead_size double")
    d = {r["state_po"]: r["lead_size_diff"] for r in votes.lead_difference(sv, pred).collect()}
    assert d["A"] == pytest.approx(20.0) and d["B"] == pytest.approx(5.5556, abs=1e-4)


def test_markers(spark):
    diffs = spark.createDataFrame([("A", 20.0), ("B", 5.5556), ("C", 0.0), ("D", -0.4), ("E", None), ("Z", 3.0)],
                                  "state_po string, lead_size_diff double")
    centers = spark.createDataFrame([(c, 1.0, 2.0) for c in "ABCDE"], "state_code string, lat double, lon double")
    m = {r["state_po"]: r for r in votes.markers(diffs, centers).collect()}
    assert set(m) == {"A", "B", "C", "D"}
    assert (m["A"]["size"], m["A"]["font"], m["A"]["color"], m["A"]["glyph"]) == (10.0, 20.0, "blue", "▲")
    assert m["B"]["size"] == pytest.approx(2.7778, abs=1e-4)
    assert m["C"]["diff"] == 1.0 and m["D"]["diff"] == -1.0 and m["D"]["color"] == "red"
    assert m["A"]["label"] == "A: 20.0%"


def test_prior_and_reweight(spark):
    h = spark.createDataFrame([(2000, "A", "AA", "US PRESIDENT", "DEMOCRAT", 100),
                               (2000, "A", "AA", "US PRESIDENT", "REPUBLICAN", 150),
                               (2000, "A", "AA", "US PRESIDENT", "OTHER", 50),
                               (2020, "A", "AA", "US PRESIDENT", "DEMOCRAT", 999)],
                              "year int, state string, state_po string, office string, party_detailed string, candidatevotes long")
    prior = {r["party_detailed"]: r["ratio"] for r in votes.two_party_prior(votes.history_filter(h)).collect()}
    assert prior == {"DEMOCRAT": pytest.approx(0.4), "REPUBLICAN": pytest.approx(0.6)}
    pr = spark.createDataFrame([("A", "AA", "DEMOCRAT", 0.4), ("A", "AA", "REPUBLICAN", 0.6),
                                ("B", "BB", "DEMOCRAT", 0.55), ("B", "BB", "REPUBLICAN", 0.45)],
                               "state string, state_po string, party_detailed string, ratio double")
    sh = spark.createDataFrame([("a", 0.75, 0.25), ("b", 0.5, 0.5)],
                               "state string, democratic_proportion double, republican_proportion double")
    out = {r["state"]: r["democratic_proportion"] for r in votes.prior_weighted(sh, pr).collect()}
    assert out["a"] == pytest.approx(0.666667, abs=1e-6) and out["b"] == pytest.approx(0.55)
