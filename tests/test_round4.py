"""Crowded buckets by blocks, signatures row by row, terms counted inside rows, lexicon words alone scored."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from opinion_spark.operators import sentiment, similarity, topics


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_crowded_buckets_are_compared_block_by_block(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(3) + 256 * rng.randrange(2) for _ in range(12)]) for i in range(60)] + [(None, [0] * 12)]
    sigs = spark.createDataFrame(rows, "doc_id long, sig array<int>")

    def pairs(hi):
        return {(r["src"], r["dst"]): r["similarity"] for r in similarity.similar_pairs(sigs, 4, 2, 0.25, hi).collect()}

    with monkeypatch.context() as m:
        m.setattr(similarity, "CROWDED", 0)
        joined = {hi: pairs(hi) for hi in (None, 0.4)}
    monkeypatch.setattr(similarity, "_cell_join", lambda cells: pytest.fail("crowded buckets were joined"))
    want = {}
    for i, x in rows[:60]:
        for j, y in rows[:60]:
            if i < j and any(x[b * 2:b * 2 + 2] == y[b * 2:b * 2 + 2] for b in range(4)):
                s = sum(p == q for p, q in zip(x, y)) / 12
                if s >= 0.25:
                    want[i, j] = s
    assert pairs(None) == joined[None] == want and len(want) > 100
    assert pairs(0.4) == joined[0.4] == {k: s for k, s in want.items() if s < 0.4}


def test_xor_signatures_match_brute_force(spark):
    texts = [(1, "abcde éfgh"), (2, "abc"), (3, None), (1, "zzzzyx"), (None, "aé😀bcd"), (4, "")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    k, q, prime = 70, 4, similarity.PRIME
    a, b = similarity.permutations(k)
    h = lambda c: int(hashlib.md5(c.encode()).hexdigest()[:8], 16) % prime
    want = {}
    for key, t in texts:
        for i in range(len(t or "") - q + 1):
            for p in range(k):
                v = 0
                for c in t[i:i + q]:
                    v ^= (a[p] * h(c) + b[p]) % prime
                want.setdefault(key, [prime + 1] * k)[p] = min(v, want.get(key, [prime + 1] * k)[p])
    got = similarity.minhash(df, k, q, shingle_hash="char_xor")
    assert "regexp_extract_all" not in plan(got)  # no row for each position
    assert {r["doc_id"]: r["sig"] for r in got.collect()} == want


def test_bucket_pairs_read_written_signatures(spark):
    df = spark.createDataFrame([(i, "some text of words " + "x" * i) for i in range(6)], "doc_id long, text string")
    out = similarity.bucket_pairs(similarity.minhash(df, 12, 3, shingle_hash="char_xor"), 6, 2, 0.0, None)
    assert "MapInArrow" not in plan(out) and "regexp_extract_all" not in plan(out)  # signed once, not for every reader


def test_terms_are_counted_inside_rows(spark):
    text = "The cat the dog a 9 cat_1 cat"
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "the")], "doc_id long, text string")
    tf = topics.term_counts(docs, ["the"])
    assert "Exchange hashpartitioning" not in plan(tf)
    assert sorted(tuple(r) for r in tf.collect()) == [(1, "cat", 2), (1, "cat_1", 1), (1, "dog", 1)]
    twice = docs.union(docs.where("doc_id = 1")).union(spark.createDataFrame([(None, "dog"), (None, "dog dog")], docs.schema))
    for together in (False, True):
        got = topics.term_counts(twice, ["the"], together=together)
        assert {(r[0], r[1]): r[2] for r in got.collect()} == {
            (1, "cat"): 4, (1, "cat_1"): 2, (1, "dog"): 2, (None, "dog"): 3}
        assert got.count() == 4


def test_weights_of_texts_dealt_out_by_key_shuffle_no_terms(spark):
    docs = spark.createDataFrame([(i, f"word{i % 3} other{i % 2} more") for i in range(12)], "doc_id long, text string")
    vocab = spark.createDataFrame([(f"word{i}", 4) for i in range(3)], "term string, df long")
    w = topics.tfidf(topics.term_counts(docs, [], together=True), F.broadcast(vocab), F.lit(12))
    assert plan(w).count("Exchange hashpartitioning") == 1  # the texts
    assert w.count() == 12


def test_joined_lexicon_reads_distinct_words_only(spark):
    lex = {"good": 2.0, "bad": -1.5, "fine": 0.7, "no": -1.2, "not": -0.3}
    texts = ["good BAD but not fine!", "never so good, no good", "", None, "good " * 40 + "bad?", "nothing here", "but good but bad", "good BAD but not fine!"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    cols = ["doc_id", "positive", "neutral", "negative", "compound"]
    joined = sentiment.lexicon_sentiment(df, lex, method="join").select(cols)
    assert "posexplode" not in plan(joined)  # no row for each token
    fold = sentiment.lexicon_sentiment(df, lex, method="fold").select(cols)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, fold.collect()))
    # a word with two entries counts once for each
    two = spark.createDataFrame([("good", 1.0), ("good", 2.0)], "word string, valence double")
    r = sentiment.lexicon_sentiment(df.where("doc_id = 6"), two, method="join").first()
    assert r["positive"] > 0 and r["compound"] > sentiment.lexicon_sentiment(df.where("doc_id = 6"), {"good": 2.0}, method="join").first()["compound"]
