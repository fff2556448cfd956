"""Hashtags by text, merging by maintained sums, cuts and ranks without a whole sort, joins of hot groups."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from opinion_spark import tables
from opinion_spark.operators import hashtags, topics


def test_hashtags_of_rows_that_share_an_id(spark):
    """Repeated and null ids, repeated texts, a very long tag, clashing columns."""
    costs = hashtags.word_costs(spark.createDataFrame([(w, 9 - i) for i, w in enumerate(["trump", "is", "orange", "vote", "blue"])], "word string, count long"))
    long = "#" + "voteblue" * 40
    rows = [(1, "a #TrumpIsOrange b"), (1, "x #VoteBlue y"), (None, "n #VoteBlue"), (None, "n #VoteBlue"), (None, None), (2, "#VoteBlue#TrumpIsOrange #VoteBlue"), (3, long), (4, "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("tag", F.lit("clash")).withColumn("run", F.lit(1)).withColumn("seg", F.lit(2))
    got = hashtags.replace_hashtags(docs, costs)
    assert got.columns == docs.columns
    want = [(1, "a Trump Is Orange b"), (1, "x Vote Blue y"), (None, "n Vote Blue"), (None, "n Vote Blue"), (None, None), (2, "Vote BlueTrump Is Orange Vote Blue"),
            (3, " ".join(["vote", "blue"] * 40)), (4, "plain")]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=key) == sorted(want, key=key)


def test_candidates_are_all_the_known_substrings(spark):
    rng = random.Random(1)
    words = {"".join(rng.choice("ab") for _ in range(rng.choice([1, 2, 3, 7, 12, 21]))) for _ in range(40)}
    costs = spark.createDataFrame([(w, 1.0) for w in words], "word string, cost double")
    parts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(20)] + [max(words, key=len) * 2]
    runs = spark.createDataFrame([(p, p, len(p)) for p in sorted(set(parts))], "part string, low string, n int")
    got = hashtags.candidates(runs, costs, max(map(len, words))).collect()
    found = {(r.part, r.end, r.len) for r in got if r.word in words}
    want = {(p, j, j - i) for p in set(parts) for i in range(len(p)) for j in range(i + 1, len(p) + 1) if p[i:j] in words}
    assert found == want and all(r.word == r.part[r.end - r.len:r.end] for r in got)
    assert {(r.part, r.end) for r in got if r.len == 1} == {(p, i + 1) for p in set(parts) for i in range(len(p))}
    assert len(got) < sum(len(p) * (len(p) + 1) // 2 for p in set(parts))


def brute_merge(membership, tf, target):
    """The greedy merge with every similarity computed anew each round."""
    owner, log = {c: c for c in set(membership.values())}, []
    while len(set(owner.values())) > target:
        now = defaultdict(Counter)
        for (doc, term), n in tf.items():
            if doc in membership:
                now[owner[membership[doc]]][term] += n
        clusters = sorted(set(owner.values()))
        n, df = len(clusters), Counter(t for c in now for t in now[c])
        vec = {c: {t: k * (math.log((1 + n) / (1 + df[t])) + 1) for t, k in now[c].items()} for c in clusters}
        size = {c: math.sqrt(sum(x * x for x in vec[c].values())) for c in clusters}
        best = None
        for i, a in enumerate(clusters):
            for b in clusters[i + 1:]:
                dot = sum(x * vec[b][t] for t, x in vec[a].items() if t in vec[b])
                if set(vec[a]) & set(vec[b]) and (best is None or round(dot / size[a] / size[b], 12) > best[0]):
                    best = (round(dot / size[a] / size[b], 12), a, b)
        cos, a, b = best or (0.0, *clusters[:2])
        log.append((len(log), a, b, pytest.approx(cos)))
        owner = {c: a if o == b else o for c, o in owner.items()}
    return {d: owner[c] for d, c in membership.items()}, log


@pytest.mark.parametrize("seed,clusters,terms", [(1, 7, 12), (2, 9, 200), (3, 5, 3)])
def test_merging_equals_recomputing(spark, seed, clusters, terms):
    rng = random.Random(seed)
    membership = {d: 100 + 7 * rng.randrange(clusters) for d in range(60)}
    tf = {(d, f"t{int(rng.random() ** 2 * terms)}"): rng.randint(1, 5) for d in range(70) for _ in range(6)}
    m = spark.createDataFrame([*membership.items(), (999, None)], "doc_id long, cluster long")
    t = spark.createDataFrame([(d, w, n) for (d, w), n in tf.items()], "doc_id long, term string, tf long")
    final, log = topics.merge_clusters(spark, m, t, 2)
    want, want_log = brute_merge(membership, tf, 2)
    assert log == want_log and {r.doc_id: r.cluster for r in final.collect()} == want


def test_merge_state_equals_a_new_one(spark):
    rng = random.Random(5)
    counts = {(c, f"t{int(rng.random() ** 2 * 40)}"): rng.randint(1, 9) for c in range(8) for _ in range(25)}
    frame = lambda x: spark.createDataFrame([(c, t, n) for (c, t), n in x.items()], "c int, term string, tf long")
    state = topics.PairState(frame(counts), tables.Scratch(spark, "test"))
    for a, b in ((2, 5), (0, 2), (6, 7)):
        state.merge(a, b)
        merged = Counter()
        for (c, t), n in counts.items():
            merged[a if c == b else c, t] += n
        counts = dict(merged)
        fresh = topics.PairState(frame(counts), tables.Scratch(spark, "test"))
        assert sorted(map(tuple, state.sums.collect())) == sorted(map(tuple, fresh.sums.collect()))
        assert sorted(str(r) for r in state.postings.collect()) == sorted(str(r) for r in fresh.postings.collect())


@pytest.mark.parametrize("most", [1, 5, 17, 1000])
def test_most_frequent_against_a_sort(spark, most):
    rng = random.Random(most)
    rows = list({(c, f"w{rng.randint(0, 400)}"): 0 for c in range(3) for _ in range(150)})
    rows = [(c, t, 2, rng.choice([1, 1, 1, 2, 3, 9])) for c, t in rows] + [(9, "only", 2, 4)]
    got = topics.most_frequent(spark.createDataFrame(rows, "cluster int, term string, df long, cf long"), most, shards=3).collect()
    want = {r for c in {r[0] for r in rows} for r in sorted((r for r in rows if r[0] == c), key=lambda r: (-r[3], r[1]))[:most]}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("n", [0, 1, 50, 700])
def test_ranks_against_a_sort(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1, 1, 1, 2, 3]), f"w{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "c long, w string").repartition(3)
    got = tables.ranked(df, [F.col("c").desc(), F.col("w").asc()], "at", tables.Scratch(spark, "test"))
    assert "SinglePartition" not in got._jdf.queryExecution().toString()
    assert {(r.c, r.w): r["at"] for r in got.collect()} == {r: i for i, r in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("most", [1, 4, 10_000])
def test_attach_equals_a_join(spark, how, most):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"g{i % 30}") for i in range(200)] + [(900, None), (901, "alone")], "i long, g string")
    groups = rows.where("g <> 'alone'").groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    got = tables.attach(rows, groups, ["g"], "n", how, most)
    want = rows.join(groups, "g", how)
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_scratch_tables_are_deleted(spark, tmp_path):
    s = tables.Scratch(spark, "gone")
    first, second = s.written(spark.range(3), "t"), s.written(spark.range(4), "t")
    paths = list(s.paths["t"])
    s.drop("t", but_last=True)
    assert second.count() == 4 and s.paths["t"] == paths[1:]
    with pytest.raises(Exception, match="(?i)not exist|FileNotFound|FAILED_READ"):
        first.collect()
    s.drop("t", "never")
    assert not s.paths
