import math

import pytest
from pyspark.sql import functions as F

from opinion_spark.operators import graph, hashtags, similarity, topics


def test_shingles(spark):
    df = spark.createDataFrame([("abcabc",), ("abc",)], "t string")
    out = [sorted(r[0]) for r in df.select(similarity.shingles(F.col("t"), 4)).collect()]
    assert out == [["abca", "bcab", "cabc"], []]


def test_bands_and_check(spark):
    df = spark.createDataFrame([([1, 2, 3, 4, 5, 6],)], "sig array<int>")
    assert df.select(F.size(similarity.band_keys(F.col("sig"), 2, 3))).first()[0] == 2
    with pytest.raises(ValueError):
        similarity.check_bands(6, 2, 4)


def test_jaccard_measures(spark):
    df = spark.createDataFrame([([1, 2, 3], [3, 1, 9])], "a array<int>, b array<int>")
    r = df.select(similarity.estimated_jaccard(F.col("a"), F.col("b")),
                  similarity.value_set_jaccard(F.col("a"), F.col("b"))).first()
    assert (r[0], r[1]) == (0.0, 0.5)


def test_char_xor_anagrams_collide(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, "dcba"), (3, "abce")], "doc_id long, text string")
    sig = {r["doc_id"]: r["sig"] for r in similarity.minhash(df, 8, 4, shingle_hash="char_xor").collect()}
    assert sig[1] == sig[2] and sig[1] != sig[3]


def test_similar_pairs_match_brute_force(spark):
    texts = ["the quick brown fox jumps", "the quick brown fox leaps", "a completely different line",
             "the quick brown cat jumps", "", "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sig = similarity.minhash(df, 40, 3)
    sigs = {r["doc_id"]: r["sig"] for r in sig.collect()}
    got = {(r["src"], r["dst"]): r["similarity"] for r in similarity.similar_pairs(sig, 20, 2, 0.0, None, block=2).collect()}
    want = {}
    for i in sigs:
        for j in sigs:
            if i < j and any(sigs[i][b * 2:b * 2 + 2] == sigs[j][b * 2:b * 2 + 2] for b in range(20)):
                want[(i, j)] = sum(x == y for x, y in zip(sigs[i], sigs[j])) / 40
    assert got == pytest.approx(want)
    assert 4 not in sigs and 5 in sigs  # "" is shorter than q: no signature; "abc" has one shingle


def test_band_filter_bounds(spark):
    # signatures of ten values that agree with the first one in 1, 2, 3 and 4 places
    rows = [(0, list(range(10)))] + [(n, [i if i < n else 100 * n + i for i in range(10)]) for n in (1, 2, 3, 4)]
    sigs = spark.createDataFrame(rows, "doc_id long, sig array<int>")
    pairs = similarity.similar_pairs(sigs, 10, 1, 0.2, 0.4).where("src = 0").collect()
    assert {r["dst"]: r["similarity"] for r in pairs} == {2: 0.2, 3: 0.3}
    assert len(similarity.similar_pairs(sigs, 10, 1, 0.2, 0.4, index_block=3).where("src = 0").collect()) == 1


def test_louvain_two_triangles(spark):
    v = spark.createDataFrame([(i,) for i in range(7)], "id long")
    e = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0), (0, 2, 1.0), (3, 4, 1.0), (4, 5, 1.0), (3, 5, 1.0),
                               (2, 3, 1.0)], "src long, dst long, similarity double")
    p = graph.louvain(v, e)
    comm = {r["id"]: r["community"] for r in p.collect()}
    assert len(comm) == 7 and comm[0] == comm[1] == comm[2] != comm[3] == comm[4] == comm[5]
    assert comm[6] not in (comm[0], comm[3])
    assert graph.modularity(p, e).first()[0] == pytest.approx(0.357143, abs=1e-6)


def test_tfidf_idf_and_mean(spark):
    tf = spark.createDataFrame([(d, "a", 1) for d in range(1)] + [(d, "b", 1) for d in range(2)] +
                               [(d, "c", 1) for d in range(4)], "doc_id long, term string, tf long")
    vocab = topics.vocabulary(tf, 4, min_df=1, max_df=1.0, max_features=None)
    idf = {r["term"]: math.log(5 / (r["df"] + 1)) + 1 for r in vocab.collect()}
    assert idf["a"] == pytest.approx(1.916291, abs=1e-6) and idf["b"] == pytest.approx(1.510826, abs=1e-6)
    assert idf["c"] == 1.0
    w = spark.createDataFrame([(0, "a", 1.0)], "doc_id long, term string, tfidf double")
    mem = spark.createDataFrame([(d, 1) for d in range(4)], "doc_id long, cluster int")
    sizes = spark.createDataFrame([(1, 4)], "cluster int, size long")
    assert topics.cluster_term_scores(w, mem, sizes).first()["score"] == 0.25


def test_term_weights(spark):
    top = spark.createDataFrame([(1, 1, "x"), (1, 2, "y"), (1, 3, "z")], "cluster int, rank int, term string")
    out = topics.term_weights(top, 6).orderBy("rank").collect()
    assert [round(r["size"], 4) for r in out] == [50.0, 42.5, 36.125]
    assert [round(r["opacity"], 6) for r in out] == [1.0, 0.833333, 0.666667]


def brute_segment(s, cost):
    best = [(0, 0.0, 0, [])]
    for i in range(1, len(s) + 1):
        opts = []
        for k in range(1, i + 1):
            w, (u, c, _, words) = s[i - k:i], best[i - k]
            if w.lower() in cost:
                opts.append((u, c + cost[w.lower()], k, words + [w]))
            elif k == 1:
                opts.append((u + 1, c, k, words + [w]))
        best.append(min(opts, key=lambda o: o[:3]))
    return best[-1][1], best[-1][3]


def test_hashtags_cut_at_separators_and_digits(spark):
    words = ["vote", "blue", "trump", "the"]
    costs = hashtags.word_costs(spark.createDataFrame([(w, 4 - i) for i, w in enumerate(words)], "word string, count long"))
    want = {"Vote_Blue": "Vote Blue", "Trump2020": "Trump 2020", "2020Trump": "2020 Trump", "ZqTheBlue": "Z q The Blue", "7": "7"}
    tags = spark.createDataFrame([(t,) for t in [*want, "_", "Trump2020", None]], "tag string")
    got = {r["tag"]: r for r in hashtags.segment_tags(tags, costs).collect()}
    assert {t: " ".join(r["words"]) for t, r in got.items()} == want
    assert got["ZqTheBlue"]["unknown"] == 2 and got["7"]["cost"] == 0
    docs = spark.createDataFrame([(1, "a #_ b #Vote_Blue"), (2, None), (3, "# #")], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in hashtags.replace_hashtags(docs, costs).collect()} == {
        1: "a #_ b Vote Blue", 2: None, 3: "# #"}


def test_word_ranks_match_one_sort(spark):
    rows = [("b", 3), ("abcd", 1), ("abce", 1), ("abc", 1), ("z", 1), ("a", 3), ("é", 1), ("ab", 2)]
    costs = {r["word"]: r["cost"] for r in hashtags.word_costs(spark.createDataFrame(rows, "word string, count long")).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[0].encode()))
    assert costs == pytest.approx({w: math.log((i + 1) * math.log(len(rows))) for i, (w, _) in enumerate(order)})


def test_hashtag_segmentation_vs_brute_force(spark):
    words = ["the", "is", "trump", "or", "orange", "range", "to"]
    wc = spark.createDataFrame([(w, 7 - i) for i, w in enumerate(words)], "word string, count long")
    costs = hashtags.word_costs(wc)
    cmap = {r["word"]: r["cost"] for r in costs.collect()}
    assert cmap["is"] == pytest.approx(1.3589, abs=1e-4) and cmap["orange"] == pytest.approx(2.2752, abs=1e-4)
    tags = ["trumpisorange", "TheRange", "toor", "xyz"]
    got = {r["tag"]: (r["cost"], r["words"]) for r in
           hashtags.segment_tags(spark.createDataFrame([(t,) for t in tags], "tag string"), costs).collect()}
    for t in tags:
        c, w = brute_segment(t, cmap)
        assert got[t][1] == w
    assert got["trumpisorange"][0] == pytest.approx(5.3984, abs=1e-4)
    docs = spark.createDataFrame([(1, "x #TrumpIsOrange y"), (2, "plain")], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in hashtags.replace_hashtags(docs, costs).collect()}
    assert out == {1: "x Trump Is Orange y", 2: "plain"}
