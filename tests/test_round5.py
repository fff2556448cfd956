"""Links stored by vertex, blocks read from the shared folder, edges that are never shuffled, posts scored once."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_spark.operators import graph, links, similarity
from opinion_spark.plans import queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def graph_of(spark, n=24, groups=3, seed=5):
    rng = random.Random(seed)
    rows = [(i, j, rng.choice([0.25, 0.5, 1.0])) for i in range(n) for j in range(i) if rng.random() < (0.5 if i % groups == j % groups else 0.06)]
    rows += [(7, 3, None), (5, 5, 1.0), (None, 4, 1.0), *rows[:5]]  # repeated, reversed, empty and looping edges
    return spark.createDataFrame([(i * 10,) for i in [*range(n), n + 3, 2]] + [(None,)], "id long"), spark.createDataFrame(
        [(None if a is None else a * 10, b * 10, w) for a, b, w in rows], "src long, dst long, similarity double")


def test_sweeps_read_stored_links_with_the_result_of_joins(spark, monkeypatch):
    v, e = graph_of(spark)
    joined = sorted(map(tuple, graph._louvain_joined(v, e, "similarity", 1e-4).collect()), key=str)
    monkeypatch.setattr(graph, "_louvain_joined", lambda *a: pytest.fail("links were joined"))
    assert len(joined) == 27 and 1 < len({c for _, c in joined}) < 15
    monkeypatch.setattr(links, "FLUSH", 7)
    monkeypatch.setattr(links, "FILE", 50)
    monkeypatch.setattr(links, "PART", 20)
    some = v.where("id < 100 or id is null")  # other ends of edges are numbered, too
    assert sorted(map(tuple, graph.louvain(some, e).collect()), key=str) == [x for x in joined if x[0] is None or x[0] < 100]


def test_large_graphs_are_joined(spark, monkeypatch):
    monkeypatch.setattr(graph, "FEW", 3)
    monkeypatch.setattr(graph, "_louvain_joined", lambda v, e, w, t: v)
    v, e = graph_of(spark, 8)
    assert graph.louvain(v, e) is v


def test_best_move_by_table_and_by_sums(spark):
    rng = np.random.RandomState(2)
    for many in (3, 40):
        row, cand = np.sort(np.append(np.arange(9), rng.randint(0, 9, 200))), rng.randint(0, many, 209)
        w, own, k = rng.randint(1, 4, 209) / 4, rng.randint(0, many, 9), rng.rand(9)
        tot = rng.rand(many) + 1
        one, two = links.best(row, cand, w, own, k, tot, 30.0), links.best(row, cand, np.where(w == 0.25, 0.0, w), own, k, tot, 30.0)
        for got, w in ((one, w), (two, np.where(w == 0.25, 0.0, w))):
            for r in range(9):
                gains = {c: round(sum(w[(row == r) & (cand == c)]) / 30 - tot[c] * k[r] / 1800, 12) for c in set(cand[row == r]) - {own[r]}}
                if gains:
                    assert got[1][r] == pytest.approx(max(gains.values()), abs=1e-11)
                    assert got[0][r] == min(c for c, g in gains.items() if g == max(gains.values()))
                assert got[2][r] == pytest.approx(sum(w[(row == r) & (cand == own[r])]) / 30 - (tot[own[r]] - k[r]) * k[r] / 1800, abs=1e-11)


def test_modularity_shuffles_no_edge(spark):
    v, e = graph_of(spark)
    part = v.select("id", (F.col("id") % 3).cast("string").alias("community"))
    q = graph.modularity(part, e)
    want = q.first()[0]
    assert "SortMergeJoin" not in plan(q) and plan(q).count("BroadcastHashJoin") >= 2
    with pytest.MonkeyPatch.context() as m:
        m.setattr(graph, "FEW", 0)
        assert graph.modularity(part, e).first()[0] == pytest.approx(want, abs=1e-12)


def test_blocks_are_written_once(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(f"d{i}", [rng.randrange(3) + 256 * rng.randrange(2) for _ in range(12)]) for i in range(50)] + [(None, [0] * 12), ("d1", [0] * 12)]
    found = similarity.similar_pairs(spark.createDataFrame(rows, "doc_id string, sig array<int>"), 4, 2, 0.25, None)
    want = sorted((min(a, b), max(a, b), sum(p == q for p, q in zip(x, y)) / 12) for i, (a, x) in enumerate(rows) for b, y in rows[:i]
                  if None not in (a, b) and a != b and sum(p == q for p, q in zip(x, y)) >= 3 and any(x[k:k + 2] == y[k:k + 2] for k in (0, 2, 4, 6)))
    assert sorted(map(tuple, found.collect())) == want and len(want) > 90
    assert "Exchange" not in plan(found)


def test_score_filters_score_a_post_once(spark, tmp_path):
    texts = ["the cat is of the den", "les amis de la ville", "the the in la la", "la la les", "the cat is of the den", "the les", "nothing", None, "les", "the in in in in"]
    spark.createDataFrame([(i, t, f"s-{i % 2}") for i, t in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(10)], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "A", 0), (1, "B", 1), (2, "C", 9)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    found = queries.n6_score_filters(spark, str(tmp_path))
    scored = queries._scored(spark, str(tmp_path))
    want = {r["doc_id"]: "positive" if r["compound"] > 0.05 else "negative" for r in scored.collect() if r["compound"] > 0.05 or r["compound"] < 0}
    assert dict(map(tuple, found.collect())) == want and set(want.values()) == {"positive", "negative"}
    assert "regexp_extract_all" not in plan(found) and "Window" not in plan(found)  # no filter scores what the dedup reads


def test_bucket_pairs_shuffle_members_and_not_pairs(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.randrange(2) * 9 + b // 4 if b % 4 < 2 else rng.randrange(6) for b in range(12)]) for i in range(70)]
    rows += [(100 + i, rows[i % 3][1]) for i in range(12)]  # copies
    sigs = spark.createDataFrame(rows + [(None, rows[0][1])], "doc_id long, sig array<int>")
    monkeypatch.setattr(similarity.sketches, "SETS", 5)
    for lo, hi in ((0.2, 0.7), (0.5, None)):
        want = []
        for i, x in rows:
            for j, y in rows:
                s = len({*x} & {*y}) / len({*x} | {*y})
                if i < j and lo <= s and (hi is None or s < hi):
                    want += [(b, i, j, s) for b in range(6) if x[2 * b:2 * b + 2] == y[2 * b:2 * b + 2]]
        for block in (8, 2048):
            found = similarity.bucket_pairs(sigs, 6, 2, lo, hi, block=block)
            assert sorted((r["band"], r["src"], r["dst"], r["similarity"]) for r in found.collect()) == sorted(want) and len(want) > 300
    assert "array_intersect" not in plan(found)  # no pair carries signatures
