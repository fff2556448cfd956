"""Property tests (hypothesis) for invariants named in the test strategy."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from opinion_spark.operators import graph, regional, similarity, votes

SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

history_rows = st.lists(
    st.tuples(st.sampled_from([2000, 2004]), st.sampled_from(["A", "B"]),
              st.sampled_from(["DEMOCRAT", "REPUBLICAN"]), st.integers(1, 10_000)),
    min_size=1, max_size=12)


@SETTINGS
@given(history_rows)
def test_two_party_shares_sum_to_one(spark, rows):
    df = spark.createDataFrame([(y, s, s + s, "US PRESIDENT", p, v) for y, s, p, v in rows],
                               "year int, state string, state_po string, office string, party_detailed string, candidatevotes long")
    sums = votes.year_shares(df).groupBy("year", "state").agg(F.sum("share").alias("t")).collect()
    assert all(r["t"] == pytest.approx(1.0) for r in sums)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(1, 50)), min_size=1, max_size=8))
def test_rebalanced_shares_sum_to_100(spark, counts):
    df = spark.createDataFrame([(f"S{i}", a, b) for i, (a, b) in enumerate(counts)],
                               "state string, n_dem long, n_rep long")
    out = regional.rebalance(regional.two_class_proportions(df)).collect()
    for r in out:
        if r["democratic_proportion"] is not None:
            assert r["democratic_proportion"] + r["republican_proportion"] == pytest.approx(100.0)


@SETTINGS
@given(st.lists(st.text(alphabet="abcde ", min_size=4, max_size=40), min_size=2, max_size=6))
def test_estimated_jaccard_symmetric_and_one_on_self(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sigs = {r["doc_id"]: r["sig"] for r in similarity.minhash(df, 16, 3).collect()}  # tiny fixture
    pairs = spark.createDataFrame([(i, j, sigs[i], sigs[j]) for i in sigs for j in sigs],
                                  "i long, j long, a array<int>, b array<int>")
    rows = pairs.select("i", "j", similarity.estimated_jaccard(F.col("a"), F.col("b")).alias("s")).collect()
    s = {(r["i"], r["j"]): r["s"] for r in rows}
    for (i, j), v in s.items():
        assert v == s[(j, i)]
        if i == j:
            assert v == 1.0


@settings(max_examples=2, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=15))
def test_louvain_partition_covers_every_vertex_once(spark, pairs):
    v = spark.createDataFrame([(i,) for i in range(10)], "id long")
    e = spark.createDataFrame([(a, b, 1.0) for a, b in pairs if a != b] or [(0, 1, 1.0)],
                              "src long, dst long, similarity double")
    p = graph.louvain(v, e).collect()
    assert sorted(r["id"] for r in p) == list(range(10))
