"""Mixing, near-duplicates and top-k."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from opinion_spark.llm import mixing, near, topk
from tests.llm import helpers as H


def test_sainte_lague_by_quotients():
    rng = random.Random(1)
    for _ in range(150):
        votes = [rng.choice([0, 1, 5, rng.randint(1, 1000)]) for _ in range(rng.randint(1, 9))]
        seats = rng.randint(0, 60)
        most = [rng.randint(0, 30) for _ in votes] if rng.random() < 0.5 else None
        got = mixing.sainte_lague([float(v) for v in votes], seats, most)
        if most is None:
            assert got == H.sainte_lague(votes, seats)
        else:
            assert all(g <= m for g, m in zip(got, most)) and sum(got) == sum(H.sainte_lague(votes, seats, most))


def test_source_quota_is_sainte_lague(spark):
    """floor(target / block + 1/2) is the allocation of that many seats by highest quotients."""
    votes = [137.0, 59.5, 1003.0, 4.0, 88.25]
    seats = [int(v / 4 + 0.5) for v in votes]
    assert H.sainte_lague(votes, sum(seats)) == seats


def mix_rows(n=400, seed=2):
    rng = random.Random(seed)
    return [(i, " ".join("w" for _ in range(rng.choice([0, 1, 7, 60, 300]))), "en", rng.choice(["a", "a", "a", "b", "\u00e9", "Z", None]), 1) for i in range(n)]


def test_mix_targets_and_limits(spark):
    data = mix_rows()
    got = mixing.mix(spark.createDataFrame(data, H.DOC_SCHEMA)).collect()
    sizes = {}
    for _, text, _, source, _ in data:
        sizes[source] = sizes.get(source, 0) + len(H.words(text))
    want = H.targets(sizes)
    assert len(got) == len(data) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert all(abs(r.target - want[r.source]) < 1e-6 and r.source_size == sizes[r.source] for r in got)
    for source, taken in H.by_source((r.source, r.taken) for r in got).items():
        assert abs(taken - want[source]) <= 8
    again = mixing.mix(spark.createDataFrame(data[::-1], H.DOC_SCHEMA).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_with_many_shards(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    data = mix_rows(600, 5)
    got = mixing.mix(spark.createDataFrame(data, H.DOC_SCHEMA)).collect()
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    target = {r.source: r.target for r in got}
    for source, taken in H.by_source((r.source, r.taken) for r in got).items():
        assert abs(taken - target[source]) <= max(60, 0.01 * target[source])


def test_mix_awkward_rows(spark):
    got = mixing.mix(H.docs(spark)).collect()
    assert len(got) == len(H.DOCS) and all(r.taken <= 2 * r.size for r in got)
    assert mixing.mix(H.docs(spark).limit(0)).count() == 0


def test_pipeline_mix_comes_to_the_targets(spark, monkeypatch):
    """Rates of 0.4 to 2, among them ones that a rounded rate would delete or double; repeated and null ids."""
    rng = random.Random(11)
    words = {"a": 4000, "b": 9000, "c": 4000, "d": 4000, "e": 300, "f": 4000, "g": 4000, "h": 300}
    data = []
    for source, n in words.items():
        while n > 0:
            size = min(n, rng.choice([1, 5, 20, 60]))
            n -= size
            data.append((rng.choice([None, 7, len(data), len(data), len(data)]), " ".join(f"w{len(data)}" for _ in range(size)), "en", source, 1))
    data += [(5000, None, "en", "a", 1), (5001, "", "en", "b", 1)]
    rng.shuffle(data)
    goal = H.targets(words)
    assert goal["b"] < 0.48 * words["b"]
    for shard_words, shards in ((1 << 20, 1), (1500, 7)):
        monkeypatch.setattr(mixing, "SHARD_WORDS", shard_words)
        got = corpus_pipeline.mixed(spark, spark.createDataFrame(data, H.DOC_SCHEMA).repartition(3), "").collect()
        out = H.by_source((r.source, len(H.words(r.text))) for r in got)
        for source in words:
            assert abs(out[source] - goal[source]) <= 60 * shards, source
        assert abs(sum(out.values()) - 1.5 * sum(words.values())) <= 60 * shards * len(words)
        long = sum(len(H.words(r.text)) == 60 for r in got if r.source == "b")  # no size is preferred
        assert abs(long / sum(r[3] == "b" and len(H.words(r[1])) == 60 for r in data) - goal["b"] / words["b"]) < 0.05
        times = Counter(r.text for r in got)
        assert all(times[r[1]] <= 2 for r in data) and not times[None] and not times[""]


def test_pipeline_mix_of_equal_rows(spark):
    row = (3, "one two three four", "en", "a", 1)
    got = corpus_pipeline.mixed(spark, spark.createDataFrame([row] * 40, H.DOC_SCHEMA), "").collect()
    assert len(got) == 60 and {tuple(r) for r in got} == {row}


def family(n, words, seed, rate):
    """A base text and copies in which each word is replaced with a chance of up to ``rate``."""
    rng = random.Random(seed)
    base = [f"b{seed}w{rng.randint(0, 5000)}" for _ in range(words)]
    for k in range(n):
        p = rate * k / max(1, n - 1)
        yield " ".join(f"n{rng.randint(0, 10 ** 6)}" if rng.random() < p else w for w in base)


def test_near_against_all_pairs(spark):
    texts = [t for s, (n, w, r) in enumerate([(40, 150, 0.08), (25, 30, 0.05), (20, 600, 0.05), (12, 7, 0.1), (1, 50, 0)]) for t in family(n, w, s, r)]
    texts += [texts[3], texts[3].upper(), texts[50].replace(" ", "\n"), "a b", "a b", "A  b", "one two three four five", ""]
    chain = [f"c{i}" for i in range(300)]
    for k in range(12):  # each links to the next only
        texts.append(" ".join(chain[k * 9:k * 9 + 130]))
    order = list(range(len(texts)))
    random.Random(9).shuffle(order)
    data = {10 + i: texts[j] for i, j in enumerate(order)}
    want = H.components(data)
    assert 20 < len(set(want.values())) < len(want)
    got = near.components(spark.createDataFrame([(i, t, None, None, 0) for i, t in data.items()], H.DOC_SCHEMA)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(H.shingles(data[r.doc_id])) and r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_at_other_thresholds(spark):
    """Copies from 0.5 to 0.95, found down to each threshold; the pipeline's stage finds those of 0.80 to 0.849."""
    rng, texts = random.Random(3), []
    for k in range(40):
        base = [f"p{k}w{i}" for i in range(rng.choice([60, 300, 900]))]
        cut = round(len(base) * rng.uniform(0.03, 0.35))
        texts += [" ".join(base), " ".join(base[:-cut] + [f"q{k}w{i}" for i in range(cut)])]
    data = dict(enumerate(texts, 1))
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in data.items()], H.DOC_SCHEMA)
    counts = []
    for percent in (85, 80, 60):
        want = H.components(data, percent)
        got = near.components(df, percent).collect()
        assert {r.doc_id: r.component_id for r in got} == want, percent
        counts.append(len(set(want.values())))
    assert counts[0] > counts[1] > counts[2]
    assert corpus_pipeline.distinct_documents(spark, df, "").count() == counts[1]


def test_near_cuts_follow_from_the_threshold():
    for percent in (50, 70, 80, 85, 95):
        t, k = percent / 100, near.band_rows(percent)
        assert (1 - t ** k) ** (near.REGISTERS // k) <= near.MISS
        assert (t - near.least_estimate(percent)) / (t * (1 - t) / near.REGISTERS) ** 0.5 > 5.9
    assert near.band_rows(85) == 8


def test_digests_lose_no_link(spark):
    """Pairs at the threshold exactly, of sizes at which most registers are empty on one side."""
    rng, rows = np.random.default_rng(5), []
    for n, pairs in ((20, 3000), (160, 1000), (400, 500)):
        for _ in range(pairs):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * n, dtype="uint64") * np.uint64(2) + np.uint64(1))
            rng.shuffle(pool)
            both, apart = 17 * n // 20, 3 * n // 20
            a, b = np.sort(pool[:both + apart // 2]), np.sort(np.concatenate([pool[:both], pool[both + apart // 2:both + apart]]))
            rows.append((near.digest(near.registers(a)), near.digest(near.registers(b)), len(a) + len(b)))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, n long")
    assert df.where(~near.digests_agree(F.col("x"), F.col("y"), F.col("n"), 85)).count() == 0


def test_near_awkward_rows(spark):
    got = near.components(H.docs(spark)).collect()
    assert len(got) == len(H.DOCS)
    by = {r.doc_id: r for r in got}
    assert by[H.BIG].component_id == 4 and not by[H.BIG].kept and by[6].component_id == 5
    assert by[None].component_id is None and by[None].kept
    assert by[2].n_shingles == by[3].n_shingles == 0 and by[2].kept and by[3].kept
    assert near.components(H.docs(spark).limit(0)).count() == 0


def test_registers_and_estimate():
    rng = np.random.default_rng(4)
    pool = np.unique(rng.integers(0, 1 << 63, 4000, dtype="uint64") * np.uint64(2) + np.uint64(1))
    for share in (0.2, 0.6, 0.9):
        n = int(1500 * share)
        a, b = np.sort(pool[:1500]), np.sort(np.concatenate([pool[:n], pool[2000:3500 - n]]))
        true = n / (3000 - n)
        assert abs(near.estimate(near.registers(a), near.registers(b)) - true) < 0.12
    # merging registers of parts gives the whole's: the least hash of a bucket has the greatest count of zeros
    assert (near.registers(np.empty(0, "uint64")) == near.EMPTY).all()


def brute_top(vectors, k):
    q = {i: [int(np.floor(64.0 * float(np.float32(x)))) for x in v] for i, v in vectors}
    out = []
    for i in sorted(x for x in q if x % 20 == 0):
        scores = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in q if j != i)[:k]
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    return out


def test_top_k_against_all_scores(spark):
    rng = random.Random(8)
    vectors = [(i, [rng.choice([0.0, rng.gauss(0, 0.2), -0.5]) for _ in range(6)]) for i in range(300)]
    vectors += [(1000 + i, [0.25] * 6) for i in range(60)]  # ties
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").withColumn("rank", F.lit(0))
    for blocks in ((64, 5), (8192, 1024)):
        got = H.rows(topk.top_k(topk.quantised(df), F.col("vec_id") % 20 == 0, 20, *blocks))
        assert sorted(got) == sorted(brute_top(vectors, 20))


def test_top_k_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    data = [(0, [1.0, 2.0]), (20, [1.0, -2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (5, [1.0, 2.0]), (5, [1.0, 2.0]),
            (40, [0.0, 0.0]), (None, [1.0, 1.0]), (7, [1.0]), (60, [inf, 1.0]), (80, [1e9, -1e9])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("v", F.lit(1))
    got = H.rows(topk.top_k(topk.quantised(df), F.col("vec_id") % 20 == 0))
    clean = [(0, [1.0, 2.0]), (20, [1.0, -2.0]), (5, [1.0, 2.0]), (40, [0.0, 0.0]), (80, [1e9, -1e9])]
    assert sorted(got) == sorted(brute_top(clean, 20))
    assert topk.top_k(topk.quantised(df.limit(0)), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_of_vectors_of_several_lengths(spark):
    """Each length is searched apart; none is dropped, however rare, empty vectors neither."""
    rng = random.Random(2)
    data = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(40)] + [(100 + i, [rng.gauss(0, 1) for _ in range(2)]) for i in range(7)] + [(220, []), (221, []), (240, [1.0] * 9)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = H.rows(topk.top_k(topk.quantised(df), F.col("vec_id") % 20 == 0, 5, 10, 2))
    want = [r for n in (0, 2, 4, 9) for r in brute_top([d for d in data if len(d[1]) == n], 5)]
    assert sorted(got) == sorted(want) and (220, 1, 221, 0) in got


def test_pipeline_keeps_rows_apart_by_text(spark, tmp_path):
    """Rows that repeat an id but not the text stay; copies without an id go; of a group the smallest id stays."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    data = [(7, a, "en", "s", 1), (3, a + " x", "en", "s", 1), (None, a, "en", "s", 1), (None, b, "en", "t", 1), (None, b, "en", "t", 1), (7, "other words in this text here", "en", "s", 1),
            (9, None, "en", "s", 1), (9, "", "en", "s", 1), (None, None, None, None, None)]
    H.docs(spark, data).withColumn("_row", F.lit("clash")).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    out = corpus_pipeline.distinct_documents(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted([(r.doc_id, r.text) for r in out.collect()], key=str)
    assert got == sorted([(3, a + " x"), (None, b), (7, "other words in this text here"), (9, None), (9, ""), (None, None)], key=str)
    assert corpus_pipeline.distinct_documents(spark, docs.limit(0), "").count() == 0
