"""Language ID, BPE and toxicity."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinion_spark.llm import bpe, language, toxicity
from tests.llm import helpers as H

SF = "/root/testdata/sf0.01"


def sf(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


def test_language_held_out_accuracy(spark):
    d = sf(spark, "documents")
    got = language.query(spark, SF).join(d.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 200 and (got.lang == got.lang_pred).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_proportions_of_a_mixture(spark):
    d = sf(spark, "documents")
    langs, prob = language.learn_from(d)
    text = {r.lang: r.t for r in d.where("length(text) > 3000").groupBy("lang").agg(F.min("text").alias("t")).collect()}
    mixed = spark.createDataFrame([(1, text["en"][:2000] + " " + text["de"][:1000], None, None, None)], H.DOC_SCHEMA)
    r = language.identify(mixed, (langs, prob), ["doc_id"]).first()
    assert r.lang_pred == "en" and set(r.langs) >= {"en", "de"} and 0.5 < r.score < 0.85


def test_pipeline_keeps_texts_in_several_languages(spark):
    import corpus_pipeline

    d = spark.read.parquet(f"{SF}/documents.parquet")
    parts = d.where("n_chars > 600").groupBy("lang").agg(F.min("text").alias("t")).orderBy("lang").limit(3).collect()
    rows = [(10 ** 9, " ".join(r.t[:600] for r in parts), None, "a", 1800), (10 ** 9 + 1, "123", None, "a", 3)]
    docs = d.unionByName(spark.createDataFrame(rows, d.select("doc_id", "text", "lang", "source", "n_chars").schema))
    r = language.identify(docs.where("doc_id >= 1000000000"), language.learn_from(docs), ["doc_id"]).where("score > 0").collect()
    assert len(r) == 1 and len(r[0].langs) == 3 and r[0].score < 0.5
    kept = corpus_pipeline.languages(spark, docs, SF).where("doc_id >= 1000000000").collect()
    assert [x.doc_id for x in kept] == [10 ** 9]


def test_language_awkward_rows(spark):
    d = H.docs(spark)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(d, language.learn_from(d), ["doc_id"]).collect()}
    assert got[2] == got[3] == got[7] == ("und", 0.0) and got[H.BIG][0] != "und"
    empty = d.limit(0)
    assert language.identify(empty, language.learn_from(empty), ["doc_id"]).count() == 0
    assert {r.lang_pred for r in language.identify(d, language.learn_from(empty), ["doc_id"]).collect()} == {"und"}


def test_language_sets_against_all_sets():
    """The chosen set's penalised likelihood is that of the best of all sets, its shares the most likely ones."""
    import itertools

    rng = np.random.default_rng(1)
    hit = 0
    for _ in range(12):
        prob = rng.dirichlet(np.full(300, 0.05), size=4).T + 1e-6
        prob /= prob.sum(axis=0)
        true = rng.choice(4, rng.integers(1, 4), replace=False)
        counts = rng.multinomial(900, prob[:, true] @ rng.dirichlet(np.full(len(true), 5.0))).astype(float)

        def likelihood(langs, counts=counts, prob=prob):
            w = np.full(len(langs), 1 / len(langs))
            for _ in range(500):
                m = prob[:, langs] @ w
                w = w * (prob[:, langs].T @ (counts / m)) / counts.sum()
            return counts @ np.log(prob[:, langs] @ w), w

        def worth(langs):
            return 2 * likelihood(langs)[0] / 3 - (len(langs) - 1) * np.log(300)

        best = max((list(c) for n in range(1, 5) for c in itertools.combinations(range(4), n)), key=worth)
        chosen, share = language.proportions(counts, prob)
        assert worth(chosen) >= worth(best) - 3 and abs(share.sum() - 1) < 1e-9
        assert np.abs(share - likelihood(chosen)[1]).max() < 0.02
        hit += set(chosen) == set(best)
    assert hit >= 11


def test_learning_from_a_billionth_of_the_rows(spark, monkeypatch):
    """The sample's bound counts hashes of 62 bits, so a sample of any share learns; rows without an id and copies are sampled like others."""
    from opinion_spark.llm import common

    assert common.sample_cut(1000, 10 ** 12) == (1000 << 62) // 10 ** 12 > 0 and common.sample_cut(5, 5) == 1 << 62
    words = {"en": "the and of house water", "fr": "le et de maison eau"}
    data = [(None if i % 4 == 0 else i, f"{words[x]} {chr(97 + i % 26)}{chr(97 + i // 26)}", x, "s", 1) for i in range(400) for x in words]
    data += [(None, "the and of house water", "en", "s", 1)] * 300
    d = spark.createDataFrame(data, H.DOC_SCHEMA)
    seen = []
    whole = common.sample_cut
    monkeypatch.setattr(language, "sample_cut", lambda sample, n: seen.append(n) or whole(sample, n * 10 ** 9) * 10 ** 8)
    langs, prob = language.learn(d, sample=100)
    assert langs == ["en", "fr"] and sorted(seen) == [400, 700]
    got = {r.text: r.lang_pred for r in language.identify(d, (langs, prob), ["text"]).collect()}
    assert {got["the and of house water"], got["le et de maison eau ab"]} == {"en", "fr"}


def test_kept_columns_may_have_any_name(spark):
    d = spark.createDataFrame([(1, "the house", "kept")], "doc_id long, text string, _text string")
    got = language.identify(d, (["en"], np.full((language.BUCKETS, 1), 1.0 / language.BUCKETS)), ["doc_id", "_text"]).first()
    assert (got.doc_id, got._text, got.lang_pred) == (1, "kept", "en")


def test_language_is_learned_outside_the_fold(spark):
    d = spark.createDataFrame([(i, "alpha beta", "xx", "s", 1) for i in range(50)], H.DOC_SCHEMA)
    held = d.where(language.held_out())
    assert 5 < held.count() < 45 and language.learn_from(held)[0] == []


def naive_bpe(word, vocab):
    parts = [vocab.ids[word[i:i + 1]] for i in range(len(word))]
    while True:
        found = [(vocab.ranks[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in vocab.ranks]
        if not found:
            return parts
        _, i = min(found)
        parts[i:i + 2] = [vocab.ranks[parts[i], parts[i + 1]][1]]


def test_bpe_merges_like_the_plain_rule():
    vocab = bpe.load(bpe.vocabulary())
    rng = random.Random(3)
    for _ in range(300):
        w = bytes(rng.choice(b"aeinorst thl\xc3\xa9") for _ in range(rng.randint(1, 40)))
        assert bpe.merge_word(w, vocab) == naive_bpe(w, vocab)
    assert bpe.merge_word(b"a" * 5000, vocab) == naive_bpe(b"a" * 5000, vocab)


def test_bpe_remembers_two_generations():
    """The same ids whatever the cache forgets."""
    vocab = bpe.load(bpe.vocabulary())
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 3))) for _ in range(500)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(20)]
    for size in (1, 7, 100):
        encode = bpe.encoder(vocab, cache_words=size)
        assert [encode(t) for t in texts] == [bpe.encoder(vocab)(t) for t in texts]


def test_bpe_equals_the_library(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.vocabulary())
    extra = [(100 + i, x, "", "", 0) for i, x in enumerate(
        ["I'll don't WE'RE it's", "  two  spaces \n\n tab\t", "\u00a0nb\u2003sp\u3000", "e\u0301\u00df\u4f60\u597d\U0001f600 12\u00bd\u0663", "<|endoftext|><|endoftext|> a"])]
    d = H.docs(spark, H.DOCS + extra)
    text = {r[0]: r[1] or "" for r in H.DOCS + extra}
    got = bpe.encode_decode(d, bpe.vocabulary(), keep_ids=True).collect()
    assert len(got) == len(H.DOCS + extra)
    for r in got:
        ids = t.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.decoded == t.decode(ids, skip_special_tokens=False) == text[r.doc_id]
        assert r.decoded_sha256 == H.sha(r.decoded)
    assert bpe.encode_decode(d.limit(0), bpe.vocabulary()).count() == 0


def test_scores_under_one_half_fall_with_the_best_segment():
    m = toxicity.Model({"bad": 1.2, "odd": 0.4}, lam=1.0, log_k=0.0, a=-1.0, b=2.0)

    class Shared:
        value = vars(m)

    of = toxicity._scorer(Shared)()
    some = ["bad bad bad bad bad bad", "bad " + "fine " * 30, "odd " + "fine " * 30, "fine " * 30, "", None]
    got = [of(t)[0] for t in some]
    assert got[0] >= 0.5 > got[1] > got[2] > got[3] == got[4] == got[5] == 0.0
    assert [of(t)[1] for t in some] == [1, 0, 0, 0, 0, 0]


def test_maximal_segments_against_the_definition():
    def brute(x):
        """The best segment, then left and right of it (Ruzzo and Tompa's recursive definition)."""
        best = max(((sum(x[i:j]), -(j - i), i, j) for i in range(len(x)) for j in range(i + 1, len(x) + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return brute(x[:i]) + [(i, j)] + [(a + j, b + j) for a, b in brute(x[j:])]

    rng = random.Random(5)
    for _ in range(200):
        x = [rng.choice([-7, -3, -2, 4, 5, 1]) + rng.random() / 100 for _ in range(rng.randint(0, 14))]
        got = toxicity.maximal_segments(x)
        assert [(a, b) for a, b, _ in got] == brute(x)
        assert all(math.isclose(s, sum(x[a:b]), abs_tol=1e-9) for a, b, s in got)


def test_toxicity_held_out(spark):
    got = toxicity.query(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, clean = got[got.toxic == 1], got[got.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.9 and (clean.predicted == 1).mean() < 0.02
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()


def test_toxicity_finds_the_passage(spark):
    d = [(i, f"plain words number{i} here and there", "en", "s", 1) for i in range(60)]
    d += [(100 + i, f"plain words number{i} awful nasty here", "en", "s", 1) for i in range(60)]
    marks = spark.createDataFrame([(r[0], int(r[0] >= 100)) for r in d] + [(None, 1), (7, None)], "doc_id long, toxic int")
    docs = spark.createDataFrame(d, H.DOC_SCHEMA)
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.learn(docs, marks), ["doc_id"]).collect()}
    assert all(got[i].predicted == int(i >= 100) for i in got)
    p = got[103].passages[0]
    assert "awful nasty" in d[63][1][p.start:p.end]


def test_toxicity_awkward_rows(spark):
    d = H.docs(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    for marks in (none, spark.createDataFrame([(H.BIG, 0), (4, 1), (4, 0), (None, 1), (8, None)], "doc_id long, toxic int")):
        got = toxicity.score(d, toxicity.learn_from(d, marks), ["doc_id"]).collect()
        assert len(got) == len(H.DOCS) and all(0 <= r.score <= 1 for r in got)
        assert all(r.predicted == 0 for r in got if r.doc_id in (2, 3, 7))
    assert toxicity.score(d.limit(0), toxicity.learn_from(d.limit(0), none), ["doc_id"]).count() == 0


@pytest.mark.parametrize("text", [None, "", "12 34"])
def test_no_letters_no_trigrams(text):
    assert language.trigrams(text) is None
