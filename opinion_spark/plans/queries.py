"""Registered queries: one per inventory item, each over whole driver tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal the matching oracle SQL's (see ``oracle.py``). It is lazy but where an
iterative operator or a table written for several readers needs jobs to be built
(Entry A and B, C14, C17, N6, L13, the T8 loop).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, mentions, regional, sentiment, similarity, votes
from opinion_spark.plans import actual, predicted
from opinion_spark.sources import bindings as B

LABELS = list(B.MENTION_NAMES)  # ["trump", "biden"]


def _labelled(spark, sf):
    return predicted.labelled_posts(B.posts(spark, sf), B.regions(spark, sf), B.MENTION_NAMES,
                                    whole_word=True)


def _scored(spark, sf):
    return predicted.scored_posts(_labelled(spark, sf), LABELS, B.LEXICON, idioms=B.IDIOMS)


def _shares(spark, sf):
    return predicted.state_shares(_scored(spark, sf), B.state_codes(spark, sf))


def r9(x: str) -> F.Column:
    return F.round(x, 9).alias(x)


# ---------------------------------------------------------------- entry A ---

def a_predicted_lead(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: C3-C6, C9-C14, N1-N3, R1-R5, J1, R7, R8, R10 on posts that end in a hashtag."""
    posts = B.posts(spark, sf).withColumn("tweet", _with_tag(F.col("tweet")))
    return predicted.run(posts, B.regions(spark, sf), B.state_codes(spark, sf), B.MENTION_NAMES, B.LEXICON,
                         whole_word=True, costs=_word_costs(spark, sf), parse=_parse, idioms=B.IDIOMS)


def a_predicted_lead_full_text(spark: SparkSession, sf: str) -> DataFrame:
    """Entry A without hashtag splitting, scored on the full texts."""
    return predicted.run(B.posts(spark, sf), B.regions(spark, sf), B.state_codes(spark, sf),
                         B.MENTION_NAMES, B.LEXICON, whole_word=True, idioms=B.IDIOMS)


def c5_clean_posts(spark, sf):
    """URL placeholder, keep-first dedup by text, region filter."""
    posts = B.posts(spark, sf)
    out = cleaning.clean_posts(posts, "tweet", regions=B.regions(spark, sf), state_col="state")
    return out.select("doc_id", "source", "state", "tweet")


def c3_distinct_rows(spark, sf):
    """C2 + C3: union of two tags of the same rows, full-row distinct."""
    base = B.posts(spark, sf).select("doc_id", "tweet", "state", "_ord")
    a = cleaning.tag_source(base, "A")
    b = cleaning.tag_source(base, "B").withColumn("_ord", cleaning.ordinal(F.col("_ord.source") + (1 << 32), F.col("_ord.row")))
    both = cleaning.union_sources([a, b])
    return cleaning.distinct_rows(both).select("doc_id", "source", "state")


def c7_normalize_text(spark, sf):
    """C7 + C13 on whole texts: lower/whitespace-collapse and URL strip."""
    d = B.table(spark, sf, "pages").select("page_id", "url", "html")
    txt = F.concat(F.lit("see "), F.col("url"), F.lit(" "), F.col("html"))
    return d.select("page_id",
                    F.md5(cleaning.normalize_text(txt)).alias("normalized_md5"),
                    F.md5(cleaning.strip_urls(txt)).alias("stripped_md5"),
                    F.length(cleaning.strip_urls(txt)).alias("stripped_len"),
                    F.md5(cleaning.replace_urls(txt)).alias("placeholder_md5"))


def c12_mention_labels(spark, sf):
    """Masks and the exclusive label for every cleaned post."""
    return _labelled(spark, sf).select("doc_id", "mentions_trump", "mentions_biden", "tweet_about")


def c9_substring_mentions(spark, sf):
    """C8/C9 with the analysis' own name lists as unescaped substrings (Q1, Q3)."""
    from opinion_spark.sources.dims import MENTION_NAMES

    docs = B.table(spark, sf, "documents").select("doc_id", F.col("text").alias("tweet"))
    out = mentions.classify_mentions(docs, MENTION_NAMES, "tweet", whole_word=False)
    return out.select("doc_id", "mentions_trump", "mentions_biden", "tweet_about")


def c15_stage_counts(spark, sf):
    """C15 with C10/C11: row counts per stage."""
    posts = B.posts(spark, sf)
    cleaned = cleaning.clean_posts(posts, "tweet", regions=B.regions(spark, sf))
    lab = mentions.classify_mentions(cleaned, B.MENTION_NAMES, "tweet", whole_word=True)
    about = F.col("tweet_about")
    later = cleaning.condition_counts(lab, {
        "regional": F.lit(True), "only_trump": about == "trump", "only_biden": about == "biden",
        "exactly_one": about.isin(LABELS)})
    return cleaning.stage_counts({"initial": posts}).unionByName(later)


def c19_score_columns(spark, sf):
    """Default score columns on the exactly-one posts."""
    lab = mentions.exactly_one(_labelled(spark, sf), LABELS)
    return cleaning.add_score_columns(lab).select("doc_id", "positive", "neutral", "negative",
                                                  "compound", "likely_party")


def n2_lexicon_sentiment(spark, sf):
    """N2 on every document's whole text."""
    d = B.docs(spark, sf)
    return sentiment.lexicon_sentiment(d, B.LEXICON, "text", idioms=B.IDIOMS).select(
        "doc_id", "positive", "neutral", "negative", "compound")


def n2_lexicon_sentiment_joined(spark, sf):
    """N2 through the large-lexicon path (tokens exploded, lexicon joined)."""
    d = B.docs(spark, sf)
    return sentiment.lexicon_sentiment(d, B.LEXICON, "text", method="join", idioms=B.IDIOMS).select(
        "doc_id", "positive", "neutral", "negative", "compound")


def n3_party_label(spark, sf):
    return _scored(spark, sf).select("doc_id", "tweet_about", "compound", "likely_party")


def _parse(text: F.Column) -> F.Column:
    """Rule-based stand-in for a parser: an array of ``(token, dep)``."""
    def labelled(token, i):
        dep = (F.when(i == 0, "ROOT").when(token.rlike(r"^\p{Lu}"), "nsubj")
               .when(F.length(token) >= 8, "pobj").otherwise("amod"))
        return F.struct(token.alias("token"), dep.alias("dep"))

    return F.transform(F.regexp_extract_all(text, F.lit(sentiment.TOKEN_PATTERN), 0), labelled)


def _context_tokens(spark, sf):
    """Parser-shaped token table derived from documents (rule-based labels)."""
    d = B.docs(spark, sf)
    t = d.select("doc_id", F.posexplode(_parse(F.col("text"))).alias("pos", "t"))
    return t.select("doc_id", "pos", "t.token", "t.dep")


def n1_context_filter(spark, sf):
    """Kept dependency labels rejoined in order; docs without any -> ''."""
    docs = B.table(spark, sf, "documents").select("doc_id")
    ctx = sentiment.context_filter(_context_tokens(spark, sf), docs=docs)
    return ctx.select("doc_id", F.md5("context").alias("context_md5"), F.length("context").alias("context_len"))


def n4_party_fallback(spark, sf):
    """Context score with full-text fallback in [0, band)."""
    lab = mentions.exactly_one(_labelled(spark, sf), LABELS)
    ctx = sentiment.context_filter(_context_tokens(spark, sf), docs=lab.select("doc_id"))
    j = lab.join(ctx, "doc_id")
    j = sentiment.lexicon_sentiment(j, B.LEXICON, "context", prefix="ctx_", idioms=B.IDIOMS)
    j = sentiment.lexicon_sentiment(j, B.LEXICON, "tweet", prefix="full_", idioms=B.IDIOMS)
    out = sentiment.party_label_fallback(j, "ctx_compound", "full_compound")
    return out.select("doc_id", "ctx_compound", "full_compound", "likely_party")


def n5_class_summary(spark, sf):
    return sentiment.class_summary(_scored(spark, sf))


def n6_score_filters(spark, sf):
    """Both filters in one pass; no score meets both.

    Scores are written first: Catalyst would move filters on them below the dedup, as conditions that score all documents again.
    """
    from opinion_spark.operators import graph

    scores = graph._checkpoint(_scored(spark, sf).select("doc_id", "compound"))
    return sentiment.score_kinds(scores).select("doc_id", "kind")


def n7_random_sample(spark, sf):
    """Exactly 100 random posts (a sampling operator; rows-only check)."""
    return sentiment.random_sample(_scored(spark, sf), 100).select("doc_id", "likely_party")


def n7_sample_summary(spark, sf):
    """N7, what every draw must meet: its size, distinct ids, all from the input."""
    s = _scored(spark, sf)
    drawn = sentiment.random_sample(s, 100).select("doc_id")
    known = s.select("doc_id", F.lit(1).alias("known"))
    return drawn.join(known, "doc_id", "left").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("doc_id").alias("n_ids"), F.count("known").alias("n_known"))


def n8_seeded_sample(spark, sf):
    s = sentiment.seeded_sample_per_class(_scored(spark, sf), 10, seed=42)
    return s.select("doc_id", "likely_party", "sample_rank")


def n9_sample_listing(spark, sf):
    s = sentiment.seeded_sample_per_class(_scored(spark, sf), 10, seed=42)
    s = sentiment.sample_listing(s, "tweet")
    return s.select("doc_id", "likely_party", F.md5("listing").alias("listing_md5"),
                    F.length("listing").alias("listing_len"))


# --------------------------------------------------------------- regional ---

def r1_frequency(spark, sf):
    """R1 + R2: posts per state, state code looked up (unmapped -> NULL)."""
    freq = regional.frequency_table(_scored(spark, sf), "state", "tweet_count")
    return regional.lookup(freq, B.state_codes(spark, sf), "state")


def r3_class_pivot(spark, sf):
    """Class pivot, total, two-class and all-post proportions."""
    p = regional.class_pivot(_scored(spark, sf))
    p = regional.share_of_total(regional.two_class_proportions(p))
    return p.select("state", "n_unsure", "n_dem", "n_rep", "total", r9("democratic_proportion"),
                    r9("republican_proportion"), r9("dem_share_of_all"), r9("rep_share_of_all"))


def r7_class_totals(spark, sf):
    return regional.class_totals(_shares(spark, sf)).select("total_dem", "total_rep", r9("tweet_ratio"))


def r9_rebalance_plain(spark, sf):
    """Side B scaled by the class ratio, no renormalisation."""
    out = regional.rebalance(_shares(spark, sf), renormalize=False)
    return out.select("state", r9("democratic_proportion"), r9("republican_proportion"))


def r12_tick_edges(spark, sf):
    """R11 + R12 on the rebalanced share."""
    lead = predicted.predicted_lead(_shares(spark, sf))
    return regional.tick_edges(lead, "democratic_proportion").select("tick", r9("edge"), "label")


def r11_range(spark, sf):
    lead = predicted.predicted_lead(_shares(spark, sf))
    return regional.measure_range(lead, "democratic_proportion").select(
        r9("min_value"), r9("max_value"), r9("mid_value"))


def r13_lead_category(spark, sf):
    lead = predicted.predicted_lead(_shares(spark, sf))
    return lead.select("state", regional.lead_category(F.col("lead_size")).alias("category"))


def r14_party_totals(spark, sf):
    return regional.party_totals(_shares(spark, sf))


def r15_melt(spark, sf):
    return regional.melt(_shares(spark, sf).select("state", "n_dem", "n_rep"), ["state"],
                         ["n_dem", "n_rep"], "party", "count")


def r16_sentiment_difference(spark, sf):
    return regional.sentiment_difference(_scored(spark, sf))


def r17_first_per_group(spark, sf):
    """First post's source per state (input order), ordered by R1."""
    cleaned = cleaning.clean_posts(B.posts(spark, sf), "tweet", regions=B.regions(spark, sf))
    first = regional.first_per_group(cleaned, "state", "source", "_ord")
    freq = regional.frequency_table(cleaned, "state", "tweet_count")
    return freq.join(first, "state", "left")


def r18_joint_frequency(spark, sf):
    return regional.joint_frequency(_scored(spark, sf), "likely_party", "state")


def r19_relative_frequency(spark, sf):
    return regional.relative_frequency(_scored(spark, sf), "likely_party")


def r20_second_largest(spark, sf):
    return regional.second_largest(_shares(spark, sf), "tweet_count")


def r21_activity_weighted(spark, sf):
    out = regional.activity_weighted(_shares(spark, sf))
    return out.select("state", r9("democratic_proportion"), r9("republican_proportion"))


def j1_attach_counts(spark, sf):
    """The frequency table with each region's shares."""
    scored = _scored(spark, sf)
    freq = regional.frequency_table(scored, "state", "tweet_count")
    props = regional.two_class_proportions(regional.class_pivot(scored))
    return regional.attach_counts(freq, props).select("state", "tweet_count", "total", r9("democratic_proportion"))


# ---------------------------------------------------------------- sources ---

def s1_quoted_csv(spark, sf):
    """Every document written as CSV with quoted line breaks, and read back split by split."""
    from opinion_spark.sources import readers
    from opinion_spark.tables import Scratch

    path = Scratch(spark, "csv").folder("documents")
    d = B.table(spark, sf, "documents").select("doc_id", "text", "source")
    (d.write.option("header", True).option("quoteAll", True).option("escape", '"').option("lineSep", "\n")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    text = F.coalesce("text", F.lit(""))
    return readers.read_quoted_csv(spark, path, "doc_id long, text string, source string").select(
        "doc_id", F.length(text).cast("long").alias("n_chars"), F.md5(text.cast("binary")).alias("text_md5"), "source")


def s9_ordinals(spark, sf):
    """Dense ordinals of the documents in the order of their ids."""
    from opinion_spark.sources import readers

    d = B.table(spark, sf, "documents").select("doc_id", "source").orderBy("doc_id")
    return readers.with_ordinal_id(d, "ordinal").select("doc_id", "source", "ordinal")


def s10_first_rows(spark, sf):
    """The first 100 of them."""
    from opinion_spark.sources import readers

    return readers.first_n(s9_ordinals(spark, sf), 100, "ordinal")


# ------------------------------------------------------------------ votes ---

def _actual(spark, sf):
    return actual.actual_lead(B.precinct_votes(spark, sf), B.CANDIDATE_A, B.CANDIDATE_B)


def _history(spark, sf):
    return votes.history_filter(B.vote_history(spark, sf, parties=("DEMOCRAT", "REPUBLICAN")), office=B.PRESIDENT_OFFICE,
                                held_out_year=B.HELD_OUT_YEAR)


def v4_state_votes(spark, sf):
    """V1-V4: per-region votes of two candidates, total, pct, proportion, lead."""
    return _actual(spark, sf).select("state_po", "votes_a", "votes_b", "total_votes", r9("biden_pct"),
                                     r9("democratic_proportion"), r9("lead_size"))


def v5_national_margin(spark, sf):
    return votes.national_margin(_actual(spark, sf)).select("votes_a", "votes_b", r9("national_margin"))


def c_lead_difference(spark, sf):
    """Entry C: J2 + V6, actual lead minus predicted lead per region."""
    pred = a_predicted_lead_full_text(spark, sf)
    out = actual.compare(B.precinct_votes(spark, sf), pred, B.CANDIDATE_A, B.CANDIDATE_B)
    return out.select("state_po", r9("actual_lead"), r9("predicted_lead"), r9("lead_size_diff"))


def v7_markers(spark, sf):
    """J4 + V7: marker table for regions with a centre."""
    pred = a_predicted_lead_full_text(spark, sf)
    diffs = actual.compare(B.precinct_votes(spark, sf), pred, B.CANDIDATE_A, B.CANDIDATE_B)
    m = votes.markers(diffs, B.state_centers(spark, sf))
    return m.select("state_po", "lat", "lon", r9("diff"), "color", "glyph", "label", r9("size"), r9("font"))


def v8_history_filter(spark, sf):
    return _history(spark, sf).select("year", "state_po", "party_detailed", "candidatevotes")


def v9_year_shares(spark, sf):
    return votes.year_shares(_history(spark, sf)).select("year", "state", "party_detailed", "votes", r9("share"))


def v10_prior(spark, sf):
    return votes.two_party_prior(_history(spark, sf)).select("state", "state_po", "party_detailed", r9("ratio"))


def v11_prior_weighted(spark, sf):
    """J3 + V11 on the un-rebalanced shares."""
    out = actual.prior_reweighted(_shares(spark, sf), B.vote_history(spark, sf, parties=("DEMOCRAT", "REPUBLICAN")), B.PRESIDENT_OFFICE,
                                  B.HELD_OUT_YEAR)
    return out.select("state", r9("democratic_proportion"), r9("republican_proportion"))


def v12_drill_down(spark, sf):
    """One region before and after the prior reweighting."""
    before = votes.drill_down(_shares(spark, sf), "NATION_3").select(
        "state", r9("democratic_proportion"), F.lit("before").alias("stage"))
    after = votes.drill_down(v11_prior_weighted(spark, sf), "NATION_3").select(
        "state", "democratic_proportion", F.lit("after").alias("stage"))
    return before.unionByName(after)


# ------------------------------------------------------------- similarity ---

# --- fixed values: the topic run's LSH parameters and the own-LSH run's ---
TOPIC_LSH = dict(k=120, q=4, bands=28, rows=2, lo=0.2, hi=0.4)
INDEX_BLOCK = 60
OWN_LSH = dict(k=120, q=5, bands=12, rows=10, lo=0.05, hi=0.5)


def _sigs(spark, sf):
    return similarity.minhash(B.short_docs(spark, sf), TOPIC_LSH["k"], TOPIC_LSH["q"])


def _edges(spark, sf):
    t = TOPIC_LSH
    return similarity.similar_pairs(_sigs(spark, sf), t["bands"], t["rows"], t["lo"], t["hi"])


def l1_shingles(spark, sf):
    """L1: distinct 4-character shingles per whole post."""
    sh = similarity.shingles(F.col("text"), TOPIC_LSH["q"])
    return B.short_docs(spark, sf).select("doc_id", F.size(sh).alias("n_shingles"),
                                    F.md5(F.array_join(F.array_sort(sh), "\u0001")).alias("shingles_md5"))


def l2_minhash(spark, sf):
    """L2: 120-permutation MinHash signature per document."""
    return _sigs(spark, sf)


def l3_char_xor_minhash(spark, sf):
    """L3: the hand-written variant's character-XOR shingle hash, q = 5."""
    return similarity.minhash(B.docs(spark, sf), OWN_LSH["k"], OWN_LSH["q"], shingle_hash="char_xor")


def l4_bands(spark, sf):
    """L4: 28 bands x 2 rows of each signature."""
    s = _sigs(spark, sf)
    b = s.select("doc_id", F.posexplode(similarity.band_keys(F.col("sig"), 28, 2)).alias("band", "bkey"))
    return b


def l7_similar_pairs(spark, sf):
    """Pairs sharing a band bucket with estimated Jaccard in [0.2, 0.4)."""
    return _edges(spark, sf).select("src", "dst", r9("similarity"))


def l6_blocked_pairs(spark, sf):
    """L6 with a fresh index per 60 posts in the order of ids (quirk Q7 parity)."""
    t = TOPIC_LSH
    out = similarity.similar_pairs(_sigs(spark, sf), t["bands"], t["rows"], t["lo"], t["hi"],
                                   index_block=INDEX_BLOCK)
    return out.select("src", "dst", r9("similarity"))


def l11_pairs_above(spark, sf):
    """Every bucket-sharing pair with estimated Jaccard >= 0.2 (no upper cut)."""
    t = TOPIC_LSH
    out = similarity.similar_pairs(_sigs(spark, sf), t["bands"], t["rows"], t["lo"], None)
    return out.select("src", "dst", r9("similarity"))


def l15_groups_by_lang(spark, sf):
    """Groups of a partition (here the language) with at least 5 members."""
    from opinion_spark.operators import graph

    part = B.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("community"))
    return graph.clusters_of(part, 5)


def l10_own_lsh(spark, sf):
    """L3 + L8 + L10: char-XOR MinHash, 12 x 10 bands, value-set Jaccard in [0.05, 0.5), per bucket."""
    o = OWN_LSH
    similarity.check_bands(o["k"], o["bands"], o["rows"])
    sig = similarity.minhash(B.docs(spark, sf), o["k"], o["q"], shingle_hash="char_xor")
    out = similarity.bucket_pairs(sig, o["bands"], o["rows"], o["lo"], o["hi"])
    return out.select("band", "src", "dst", r9("similarity"))


def l12_similarity_graph(spark, sf):
    """Every post is a vertex; degree and weight over the edges."""
    from opinion_spark.operators import graph

    v = B.short_docs(spark, sf).select(F.col("doc_id").alias("id"))
    return graph.vertex_degrees(v, _edges(spark, sf)).select(
        "id", "degree", F.round("strength", 6).alias("strength"))


def l14_modularity_by_lang(spark, sf):
    """Modularity of the language partition on the similarity graph."""
    from opinion_spark.operators import graph

    langs = B.table(spark, sf, "documents").select(F.col("doc_id").alias("conv"), F.col("lang").alias("community"))
    ids = B.short_docs(spark, sf).select(F.col("doc_id").alias("id"), F.floor(F.col("doc_id") / B.CONVERSATION_IDS).alias("conv"))
    part = ids.join(langs, "conv", "left").select("id", "community")
    return graph.modularity(part, _edges(spark, sf)).select(F.round("modularity", 6).alias("modularity"))


# ----------------------------------------------------------------- topics ---

# --- fixed values: vectorizer limits and the topic run's sizes ---
MIN_DF, MAX_DF, MAX_FEATURES = 7, 0.7, 3000
TOPIC_RUN = dict(min_cluster_size=40, n_terms=6, n_clusters=6)


def _stops():
    from opinion_spark.sources.dims import topic_stop_words

    return topic_stop_words()


def _tf(spark, sf, together=False):
    from opinion_spark.operators import topics

    return topics.term_counts(B.docs(spark, sf), _stops(), together=together)


def _cluster_counts(spark, sf, groups):
    """``(cluster, term, tf)`` of the clusters' texts: a cluster's documents are counted under its key, and only texts are joined."""
    from opinion_spark.operators import topics

    docs = B.docs(spark, sf).join(groups, "doc_id").select("cluster", "text")
    return topics.term_counts(docs, _stops(), key="cluster")


def _n_docs(spark, sf):
    return B.table(spark, sf, "documents").agg(F.count(F.lit(1))).scalar()


def _lang_groups(spark, sf):
    return B.table(spark, sf, "documents").select("doc_id", F.col("lang").alias("cluster"))


def t1_term_counts(spark, sf):
    """T1 + J7: per-document term counts, stop words removed."""
    return _tf(spark, sf)


def t2_vocabulary(spark, sf):
    from opinion_spark.operators import topics

    return topics.vocabulary(_tf(spark, sf), _n_docs(spark, sf), MIN_DF, MAX_DF, MAX_FEATURES)


def t3_tfidf(spark, sf):
    from opinion_spark.operators import topics

    n = _n_docs(spark, sf)
    v = topics.vocabulary(_tf(spark, sf), n, MIN_DF, MAX_DF, MAX_FEATURES)
    return topics.tfidf(_tf(spark, sf, together=True), v, n).select("doc_id", "term", r9("tfidf"))


def _lang_top(spark, sf, n_terms=5):
    from opinion_spark.operators import topics

    n = _n_docs(spark, sf)
    tf = _tf(spark, sf, together=True)
    v = topics.vocabulary(_tf(spark, sf), n, MIN_DF, MAX_DF, MAX_FEATURES)
    groups = _lang_groups(spark, sf)
    sizes = groups.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sc = topics.cluster_term_scores(topics.tfidf(tf, v, n), groups, sizes)
    return topics.top_terms(sc, n_terms)


def t5_top_terms_by_lang(spark, sf):
    """T4 + T5: mean TF-IDF per language group, top 5 terms."""
    return _lang_top(spark, sf).select("cluster", "rank", "term", r9("score"))


def t6_group_terms(spark, sf):
    """Each source's own vocabulary fit, top 5 terms."""
    from opinion_spark.operators import topics

    groups = B.table(spark, sf, "documents").select("doc_id", F.col("source").alias("cluster"))
    out = topics.top_terms_per_group(B.docs(spark, sf), groups, 5, _stops(), MIN_DF, MAX_DF, MAX_FEATURES)
    return out.select("cluster", "rank", "term", r9("score"))


def t7_cluster_cosine(spark, sf):
    """T7 + J6: cosine of language-level TF-IDF vectors."""
    from opinion_spark.operators import topics

    counts = _cluster_counts(spark, sf, _lang_groups(spark, sf))
    return topics.cluster_cosine(counts).select("c1", "c2", r9("cosine"))


def t8_merge_pair(spark, sf):
    """T8, one round: the most similar pair of source clusters."""
    from opinion_spark.operators import topics

    groups = B.table(spark, sf, "documents").select("doc_id", F.col("source").alias("cluster"))
    counts = _cluster_counts(spark, sf, groups)
    return topics.cluster_cosine(counts).orderBy(F.col("cosine").desc(), "c1", "c2").limit(1) \
        .select("c1", "c2", r9("cosine"))


def t8_merge_sources(spark, sf):
    """T8 loop: merge the 20 source clusters down to 5."""
    from opinion_spark.operators import topics

    groups = B.table(spark, sf, "documents").select("doc_id", (F.regexp_extract("source", r"(\d+)$", 1)
                                                               .cast("long")).alias("cluster"))
    final, _ = topics.merge_clusters(spark, groups, _tf(spark, sf), 5)
    return final


def t10_report(spark, sf):
    """First three documents of each language group, cut to 100 chars."""
    from opinion_spark.operators import topics

    return topics.cluster_report(_lang_groups(spark, sf), B.docs(spark, sf))


def t11_term_weights(spark, sf):
    from opinion_spark.operators import topics

    w = topics.term_weights(_lang_top(spark, sf, 6), 6)
    return w.select("cluster", "rank", "term", r9("size"), r9("opacity"))


def t12_cluster_labels(spark, sf):
    from opinion_spark.operators import topics

    sizes = _lang_groups(spark, sf).groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    return topics.cluster_labels(sizes)


def l13_louvain(spark, sf):
    """Communities of the similarity graph (rows-only check)."""
    from opinion_spark.operators import graph

    v = B.short_docs(spark, sf).select(F.col("doc_id").alias("id"))
    return graph.louvain(v, _edges(spark, sf))


def l13_louvain_quality(spark, sf):
    """L13, what any run must meet: every vertex once, modularity at least that of languages and of singletons."""
    from opinion_spark.operators import graph

    edges = graph._checkpoint(_edges(spark, sf))
    v = B.short_docs(spark, sf).select(F.col("doc_id").alias("id"))
    found = graph._checkpoint(graph.louvain(v, edges))
    langs = B.table(spark, sf, "documents").select(F.col("doc_id").alias("conv"), F.col("lang").alias("community"))
    by_lang = v.withColumn("conv", F.floor(F.col("id") / B.CONVERSATION_IDS)).join(langs, "conv", "left").select("id", "community")
    alone = v.withColumn("community", F.col("id"))
    q, q_lang, q_alone = (F.coalesce(graph.modularity(p, edges).scalar(), F.lit(0.0)) for p in (found, by_lang, alone))
    return (found.join(v, "id", "left_semi").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_vertices"))
            .withColumns({"beats_languages": q >= q_lang, "beats_singletons": q >= q_alone}))


def b_topic_clusters(spark, sf):
    """Entry B (T9): topics end to end with the topic run's parameters."""
    from opinion_spark.plans import topics as tplan

    t = TOPIC_LSH
    mem, top, _ = tplan.topic_clusters(B.short_docs(spark, sf), _stops(), threshold=t["lo"], num_perm=t["k"], q=t["q"],
                                       bands=t["bands"], rows=t["rows"], hi=t["hi"], costs=_word_costs(spark, sf), **TOPIC_RUN)
    sizes = mem.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    terms = top.groupBy("cluster").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                                                                lambda x: x["term"]), ", ").alias("top_terms"))
    return sizes.join(terms, "cluster", "left")


# --------------------------------------------------------------- hashtags ---

def _with_tag(text: F.Column) -> F.Column:
    """A text with a derived hashtag appended: '#' + its first three 3+-letter words,
    capitalised and run together (the driver's texts carry almost no hashtags)."""
    words = F.slice(F.regexp_extract_all(text, F.lit(r"\p{L}{3,}"), 0), 1, 3)
    return F.concat(text, F.lit(" #"), F.array_join(F.transform(words, lambda w: F.initcap(w)), ""))


def _tagged_docs(spark, sf):
    return B.docs(spark, sf).withColumn("text", _with_tag(F.col("text")))


def _word_costs(spark, sf):
    """C16's costs; the word counts are written once, as ranks, longest word and lookups all read them."""
    from opinion_spark.operators import graph, hashtags

    return hashtags.word_costs(graph._checkpoint(hashtags.corpus_word_counts(B.docs(spark, sf))))


def c16_word_costs(spark, sf):
    """Unigram costs from the corpus' word frequencies."""
    return _word_costs(spark, sf).select("word", r9("cost"))


def c17_segment_tags(spark, sf):
    """C17: minimum-cost segmentation of every distinct derived tag."""
    from opinion_spark.operators import hashtags

    d = _tagged_docs(spark, sf)
    tags = d.select(F.explode(F.regexp_extract_all("text", F.lit(hashtags.TAG), 0)).alias("t")) \
        .select(F.substring("t", 2, 1 << 20).alias("tag"))
    return hashtags.segment_tags(tags, _word_costs(spark, sf)).select(
        "tag", F.array_join("words", " ").alias("words"), "unknown", F.round("cost", 6).alias("cost"))


def c14_process_posts(spark, sf):
    """C13 + C14 + C18: URLs stripped, hashtags replaced by their words."""
    from opinion_spark.operators import hashtags

    d = _tagged_docs(spark, sf).withColumn("text", cleaning.strip_urls(F.col("text")))
    out = hashtags.replace_hashtags(d, _word_costs(spark, sf))
    return out.select("doc_id", F.length("text").alias("n_chars"), F.md5("text").alias("text_md5"))


REGISTRY = {
    "a_predicted_lead": a_predicted_lead,
    "a_predicted_lead_full_text": a_predicted_lead_full_text,
    "c3_distinct_rows": c3_distinct_rows,
    "c5_clean_posts": c5_clean_posts,
    "c7_normalize_text": c7_normalize_text,
    "c9_substring_mentions": c9_substring_mentions,
    "c12_mention_labels": c12_mention_labels,
    "c15_stage_counts": c15_stage_counts,
    "c19_score_columns": c19_score_columns,
    "n1_context_filter": n1_context_filter,
    "n2_lexicon_sentiment": n2_lexicon_sentiment,
    "n2_lexicon_sentiment_joined": n2_lexicon_sentiment_joined,
    "n3_party_label": n3_party_label,
    "n4_party_fallback": n4_party_fallback,
    "n5_class_summary": n5_class_summary,
    "n6_score_filters": n6_score_filters,
    "n7_random_sample": n7_random_sample,
    "n7_sample_summary": n7_sample_summary,
    "n8_seeded_sample": n8_seeded_sample,
    "n9_sample_listing": n9_sample_listing,
    "r1_frequency": r1_frequency,
    "r3_class_pivot": r3_class_pivot,
    "r7_class_totals": r7_class_totals,
    "r9_rebalance_plain": r9_rebalance_plain,
    "r11_range": r11_range,
    "r12_tick_edges": r12_tick_edges,
    "r13_lead_category": r13_lead_category,
    "r14_party_totals": r14_party_totals,
    "r15_melt": r15_melt,
    "r16_sentiment_difference": r16_sentiment_difference,
    "r17_first_per_group": r17_first_per_group,
    "r18_joint_frequency": r18_joint_frequency,
    "r19_relative_frequency": r19_relative_frequency,
    "r20_second_largest": r20_second_largest,
    "r21_activity_weighted": r21_activity_weighted,
    "j1_attach_counts": j1_attach_counts,
    "s1_quoted_csv": s1_quoted_csv,
    "s9_ordinals": s9_ordinals,
    "s10_first_rows": s10_first_rows,
    "v4_state_votes": v4_state_votes,
    "v5_national_margin": v5_national_margin,
    "c_lead_difference": c_lead_difference,
    "v7_markers": v7_markers,
    "v8_history_filter": v8_history_filter,
    "v9_year_shares": v9_year_shares,
    "v10_prior": v10_prior,
    "v11_prior_weighted": v11_prior_weighted,
    "v12_drill_down": v12_drill_down,
    "l1_shingles": l1_shingles,
    "l2_minhash": l2_minhash,
    "l3_char_xor_minhash": l3_char_xor_minhash,
    "l4_bands": l4_bands,
    "l6_blocked_pairs": l6_blocked_pairs,
    "l7_similar_pairs": l7_similar_pairs,
    "l10_own_lsh": l10_own_lsh,
    "l11_pairs_above": l11_pairs_above,
    "l15_groups_by_lang": l15_groups_by_lang,
    "l12_similarity_graph": l12_similarity_graph,
    "l14_modularity_by_lang": l14_modularity_by_lang,
    "l13_louvain": l13_louvain,
    "l13_louvain_quality": l13_louvain_quality,
    "t1_term_counts": t1_term_counts,
    "t2_vocabulary": t2_vocabulary,
    "t3_tfidf": t3_tfidf,
    "t5_top_terms_by_lang": t5_top_terms_by_lang,
    "t6_group_terms": t6_group_terms,
    "t7_cluster_cosine": t7_cluster_cosine,
    "t8_merge_pair": t8_merge_pair,
    "t8_merge_sources": t8_merge_sources,
    "t10_report": t10_report,
    "t11_term_weights": t11_term_weights,
    "t12_cluster_labels": t12_cluster_labels,
    "b_topic_clusters": b_topic_clusters,
    "c14_process_posts": c14_process_posts,
    "c16_word_costs": c16_word_costs,
    "c17_segment_tags": c17_segment_tags,
}
