"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The SQL is written relationally (unnest + window + group by), independently of
the Spark side's array expressions, so the two cross-check each other. The
parameters come from the same binding constants.
"""

from __future__ import annotations

from opinion_spark.functions.exprs import word_alternation
from opinion_spark.operators.similarity import PRIME, permutations
from opinion_spark.sources import bindings as B

# --- fixed values: the published scoring rule, spelt here once more so that errors in the engine's lists show ---
TOKEN_PATTERN = r"[\p{L}\p{N}_']+"
NEGATIONS = """not never none nothing neither nor nowhere nope cannot without rarely seldom despite uhuh
aint isnt arent wasnt werent dont doesnt didnt wont wouldnt cant couldnt shouldnt hasnt havent hadnt darent mightnt
mustnt neednt oughtnt shant""".split()
INCREASING = """absolutely amazingly awfully completely considerable considerably decidedly deeply effing enormous
enormously entirely especially exceptional exceptionally extreme extremely fabulously flipping flippin frackin fracking
fricking frickin frigging friggin fully fuckin fucking fuggin fugging greatly hella highly hugely incredible incredibly
intensely major majorly more most particularly purely quite really remarkably so substantially thoroughly total totally
tremendous tremendously uber unbelievably unusually utter utterly very""".split()
DECREASING = """almost barely hardly kinda kindof less little marginal marginally occasional occasionally partly scarce
scarcely slight slightly somewhat sorta sortof""".split()

# --- fixed values: Spark ML's English stop words and the domain words, spelt here once more ---
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it
its itself they them their theirs themselves what which who whom this that these those am is are was were be been
being have has had having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over under again further
then once here there when where why how all any both each few more most other some such no nor not only own same so
than too very s t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't
hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's how's let's
ought that's there's what's when's where's who's why's would
trump biden donald joe potus 2020 trumps realdonaldtrump harris save yep yes nope no fa oh nytimes wow tells omg wait
look abcabcnews cnn fox foxnews msnbc nbc nbcnews cbs cbsnews news joebiden did won wins 19 kamala wouldn rawstory""".split()

NS = r"[^ \t\n\r\f\x0b]"
WS = r"[ \t\n\r\f\x0b]"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(xs) -> str:
    return ", ".join(q(x) if isinstance(x, str) else str(x) for x in xs)


def lexicon_values() -> str:
    return ", ".join(f"({q(w)}, CAST({v!r} AS DECIMAL(12,4)))" for w, v in sorted(B.LEXICON.items()))


def posts_cte(documents: str = "documents") -> str:
    return f"""posts AS (
  SELECT d.doc_id, d.text AS tweet, d.source, n.n_name AS state,
         CAST(regexp_extract(d.source, '(\\d+)$', 1) AS BIGINT) AS src_no
  FROM {documents} d LEFT JOIN customer c ON c.c_custkey = d.doc_id
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""


def cleaned_ctes(documents: str = "documents") -> str:
    a, b = (word_alternation(v) for v in B.MENTION_NAMES.values())
    return posts_cte(documents) + f""",
placeheld AS (SELECT doc_id, source, state, src_no,
                     regexp_replace(tweet, 'http{NS}+', '[]', 'g') AS tweet FROM posts),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY tweet ORDER BY src_no, doc_id) AS rn
    FROM placeheld) WHERE rn = 1),
regional AS (
  SELECT * FROM dedup
  WHERE state IN (SELECT n_name FROM nation WHERE n_regionkey IN ({in_list(B.KEPT_REGIONS)}))),
masked AS (
  SELECT *, coalesce(regexp_matches(tweet, {q('(?i)' + a)}), false) AS mentions_trump,
            coalesce(regexp_matches(tweet, {q('(?i)' + b)}), false) AS mentions_biden
  FROM regional),
labelled AS (
  SELECT *, CASE WHEN mentions_trump AND NOT mentions_biden THEN 'trump'
                 WHEN mentions_biden AND NOT mentions_trump THEN 'biden' ELSE 'None' END AS tweet_about
  FROM masked)"""


def sentiment_ctes(src: str, text_col: str, prefix: str = "") -> str:
    """CTEs ``{prefix}sent`` with (doc_id, positive, neutral, negative, compound)."""
    p = prefix

    def before(k: int) -> str:
        """Lower case, capitals and lexicon membership of the token k places before, and what the rules call it."""
        return (f"lag(tok, {k}, '') OVER w AS w{k}, lag(cap, {k}, false) OVER w AS cap{k}, lag(l.w IS NOT NULL, {k}, false) OVER w AS in{k}")

    def way(k: int) -> str:
        return (f"(CASE WHEN in{k} THEN 0 WHEN w{k} IN ({in_list(INCREASING)}) THEN 1 "
                f"WHEN w{k} IN ({in_list(DECREASING)}) THEN -1 ELSE 0 END)")

    def boosted(v: str, k: int) -> str:
        part = ("1.00", "0.95", "0.90")[k - 1]
        return (f"({v} + (CAST({way(k)} * CASE WHEN {v} < 0 THEN -0.293 ELSE 0.293 END"
                f" + CASE WHEN {way(k)} <> 0 AND cap{k} AND mixed THEN CASE WHEN {v} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END AS DECIMAL(8,3))"
                f" * CAST({part} AS DECIMAL(3,2))))")

    def words(*at: str) -> str:
        return " || ' ' || ".join(at)

    def idiom() -> str:
        """The first known sequence: from the word on, else up to it or to the word before."""
        known = [words("tok", "n1", "n2"), words("tok", "n1"), words("w1", "tok"), words("w2", "w1", "tok"), words("w2", "w1"), words("w3", "w2", "w1"), words("w3", "w2")]
        cases = " ".join(f"WHEN {q(k)} THEN {v!r}" for k, v in B.IDIOMS.items())
        return "coalesce(" + ", ".join(f"CAST(CASE {k} {cases} END AS DECIMAL(18,13))" for k in known) + ")"

    pairs = "('kind of', 'sort of')"
    soft = f"(CASE WHEN {words('w2', 'w1')} IN {pairs} THEN 0.293 ELSE 0 END + CASE WHEN {words('w3', 'w2')} IN {pairs} THEN 0.293 ELSE 0 END)"
    no = "w1 = 'no' OR w2 = 'no' OR (w3 = 'no' AND w1 IN ('or', 'nor'))"

    def negation(k: int) -> str:
        return f"WHEN NOT in{k} AND (w{k} IN ({in_list(NEGATIONS)}) OR suffix(w{k}, 'n''t')) THEN -0.74 ELSE 1 END AS DECIMAL(3,2))"

    turned = [f"CAST(CASE {negation(1)}",
              f"CAST(CASE WHEN NOT in2 AND w2 = 'never' AND w1 IN ('so', 'this') THEN 1.25 "
              f"WHEN NOT in2 AND w2 = 'without' AND w1 = 'doubt' THEN 1 {negation(2)}",
              f"CAST(CASE WHEN NOT in3 AND w3 = 'never' AND (w2 IN ('so', 'this') OR w1 IN ('so', 'this')) THEN 1.25 "
              f"WHEN NOT in3 AND w3 = 'without' AND (w2 = 'doubt' OR w1 = 'doubt') THEN 1 {negation(3)}"]
    least = "CAST(CASE WHEN NOT in1 AND w1 = 'least' AND w2 NOT IN ('at', 'very') THEN -0.74 ELSE 1 END AS DECIMAL(3,2))"
    steps = "".join(f"""{p}v{k} AS (SELECT *, CAST({boosted(f'v{k - 1}', k)} * {turned[k - 1]} AS DECIMAL(28,{(8, 10, 12)[k - 1]})) AS v{k} FROM {p}v{k - 1}),
""" for k in (1, 2, 3))
    return f"""{p}tok AS MATERIALIZED (
  SELECT doc_id, {text_col} AS txt,
         regexp_extract_all({text_col}, {q(TOKEN_PATTERN)}) AS raw,
         list_transform(raw, lambda x: lower(x)) AS toks,
         list_transform(raw, lambda x: regexp_matches(x, '\\p{{Lu}}') AND NOT regexp_matches(x, '\\p{{Ll}}')) AS caps FROM {src}),
{p}tp AS (
  SELECT t.doc_id, g.p, t.toks[g.p] AS tok, t.caps[g.p] AS cap, coalesce(list_position(t.toks, 'but'), 0) AS but_at,
         list_contains(t.caps, true) AND list_contains(t.caps, false) AS mixed
  FROM {p}tok t, generate_series(1, len(t.toks)) AS g(p)),
{p}lex AS (SELECT * FROM (VALUES {lexicon_values()}) AS l(w, v)),
{p}tw AS (
  SELECT doc_id, p, tok, cap, mixed, but_at, l.v AS value, {before(1)}, {before(2)}, {before(3)},
    lead(tok, 1, '') OVER w AS n1, lead(tok, 2, '') OVER w AS n2, lead(l.w IS NOT NULL, 1, false) OVER w AS in_next
  FROM {p}tp LEFT JOIN {p}lex l ON l.w = tok WINDOW w AS (PARTITION BY doc_id ORDER BY p)),
{p}v0 AS (
  SELECT *, CAST(base + CASE WHEN cap AND mixed THEN CASE WHEN base > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END AS DECIMAL(18,6)) AS v0
  FROM (SELECT *, CAST(CASE WHEN {no} THEN value * -0.74 WHEN tok = 'no' AND in_next THEN 0 ELSE value END AS DECIMAL(18,6)) AS base
        FROM {p}tw WHERE value IS NOT NULL)),
{steps}{p}v4 AS (
  SELECT *, CASE WHEN w3 <> '' AND NOT in3 THEN CAST(coalesce({idiom()}, v3) - {soft} AS DECIMAL(28,12)) ELSE v3 END AS v4 FROM {p}v3),
{p}ts AS (
  SELECT doc_id, CAST(round(CAST(v4 * {least} AS DECIMAL(34,14)), 7)
            * (CASE WHEN but_at > 0 AND p < but_at THEN CAST(0.5 AS DECIMAL(2,1))
                    WHEN but_at > 0 AND p > but_at THEN CAST(1.5 AS DECIMAL(2,1))
                    ELSE CAST(1.0 AS DECIMAL(2,1)) END) AS DECIMAL(38,12)) AS s
  FROM {p}v4),
{p}agg AS (
  SELECT doc_id, CAST(sum(s) AS DECIMAL(38,12)) AS ssum,
         CAST(sum(CASE WHEN s > 0 THEN s + 1 ELSE 0 END) AS DECIMAL(38,12)) AS pos_sum,
         CAST(sum(CASE WHEN s < 0 THEN s - 1 ELSE 0 END) AS DECIMAL(38,12)) AS neg_sum,
         count(*) FILTER (WHERE s <> 0) AS scored
  FROM {p}ts GROUP BY doc_id),
{p}amp AS (
  SELECT doc_id, CAST(least(length(txt) - length(replace(txt, '!', '')), 4) * CAST(0.292 AS DECIMAL(4,3))
           + CASE WHEN length(txt) - length(replace(txt, '?', '')) <= 1 THEN 0
                  WHEN length(txt) - length(replace(txt, '?', '')) <= 3
                       THEN (length(txt) - length(replace(txt, '?', ''))) * CAST(0.18 AS DECIMAL(3,2))
                  ELSE CAST(0.96 AS DECIMAL(3,2)) END AS DECIMAL(38,12)) AS amp
  FROM {p}tok),
{p}each AS (
  SELECT m.doc_id, m.amp, coalesce(a.ssum, 0) AS ssum, coalesce(a.pos_sum, 0) AS pos_sum, coalesce(a.neg_sum, 0) AS neg_sum,
         len(t.toks) AS n, len(t.toks) - coalesce(a.scored, 0) AS neu
  FROM {p}amp m JOIN {p}tok t USING (doc_id) LEFT JOIN {p}agg a USING (doc_id)),
{p}adj AS (
  SELECT doc_id, n, neu,
         CAST(CASE WHEN ssum > 0 THEN ssum + amp WHEN ssum < 0 THEN ssum - amp ELSE ssum END AS DOUBLE) AS sadj,
         CAST(CASE WHEN pos_sum > abs(neg_sum) THEN pos_sum + amp ELSE pos_sum END AS DOUBLE) AS pos_adj,
         CAST(CASE WHEN pos_sum < abs(neg_sum) THEN abs(neg_sum) + amp ELSE abs(neg_sum) END AS DOUBLE) AS neg_adj
  FROM {p}each),
{p}sent AS (
  SELECT doc_id,
    CASE WHEN n = 0 THEN 0.0 ELSE round(abs(pos_adj / (pos_adj + neg_adj + neu)), 3) END AS {p}positive,
    CASE WHEN n = 0 THEN 0.0 ELSE round(abs(neu / (pos_adj + neg_adj + neu)), 3) END AS {p}neutral,
    CASE WHEN n = 0 THEN 0.0 ELSE round(abs(neg_adj / (pos_adj + neg_adj + neu)), 3) END AS {p}negative,
    CASE WHEN n = 0 THEN 0.0 ELSE round(least(greatest(sadj / sqrt(sadj * sadj + 15.0), -1.0), 1.0), 4) END AS {p}compound
  FROM {p}adj)"""


STRIPPED = f"SELECT *, regexp_replace(tweet, 'http{NS}+|www{NS}+', '', 'g') AS processed FROM labelled WHERE tweet_about IN ('trump', 'biden')"


def scored_ctes() -> str:
    return cleaned_ctes() + f""",
one AS ({STRIPPED}),
""" + lead_ctes()


def lead_ctes() -> str:
    """From ``one`` (with ``processed``) to the scores, shares and the rebalanced lead."""
    return f"""{sentiment_ctes('one', 'processed')},
scored AS (
  SELECT o.*, s.positive, s.neutral, s.negative, s.compound,
    CASE WHEN s.compound < 0.05 AND s.compound > -0.05 THEN 0
         WHEN o.tweet_about = 'biden' THEN CASE WHEN s.compound > 0 THEN 1 ELSE 2 END
         WHEN o.tweet_about = 'trump' THEN CASE WHEN s.compound > 0 THEN 2 ELSE 1 END
         ELSE 0 END AS likely_party
  FROM one o JOIN sent s USING (doc_id)),
codes AS (SELECT n_name AS state, 'N' || CAST(n_nationkey AS VARCHAR) AS state_code FROM nation),
piv AS (
  SELECT state, count(*) FILTER (WHERE likely_party = 0) AS n_unsure,
         count(*) FILTER (WHERE likely_party = 1) AS n_dem,
         count(*) FILTER (WHERE likely_party = 2) AS n_rep, count(*) AS total
  FROM scored WHERE state IS NOT NULL GROUP BY state),
shares AS (
  SELECT p.*, p.total AS tweet_count,
         CAST(n_dem AS DOUBLE) / nullif(CAST(n_dem + n_rep AS DOUBLE), 0) AS democratic_proportion,
         CAST(n_rep AS DOUBLE) / nullif(CAST(n_dem + n_rep AS DOUBLE), 0) AS republican_proportion,
         c.state_code
  FROM piv p LEFT JOIN codes c USING (state)),
ratio AS (SELECT CAST(coalesce(sum(n_dem), 0) AS DOUBLE) / nullif(CAST(coalesce(sum(n_rep), 0) AS DOUBLE), 0) AS r FROM shares),
lead AS (
  SELECT s.*, (democratic_proportion / (democratic_proportion + republican_proportion * r)) * 100.0 AS dem_pct,
         ((republican_proportion * r) / (democratic_proportion + republican_proportion * r)) * 100.0 AS rep_pct
  FROM shares s, ratio)"""


def W(ctes: str, select: str) -> str:
    return "WITH " + ctes + "\n" + select


def sql_registry() -> dict[str, str]:
    S = scored_ctes()
    C = cleaned_ctes()
    regions = in_list(B.KEPT_REGIONS)
    out: dict[str, str] = {}
    lead = """SELECT state, state_code, tweet_count, n_unsure, n_dem, n_rep, total,
  round(dem_pct, 9) AS democratic_proportion, round(rep_pct, 9) AS republican_proportion,
  round(dem_pct - 50.0, 9) AS lead_size FROM lead"""
    out["a_predicted_lead_full_text"] = W(S, lead)
    out["a_predicted_lead"] = f"""WITH RECURSIVE {TAG_COSTS},
{cleaned_ctes("(SELECT t.doc_id, t.text, d.source FROM tagged t JOIN documents d USING (doc_id))")},
urlless AS MATERIALIZED ({STRIPPED}),
bare AS (SELECT doc_id, processed AS text FROM urlless),
{SEGMENTED % "bare"},
{replaced_ctes("bare")},
parsed AS (SELECT doc_id, list_filter(regexp_extract_all(text, {q(TOKEN_PATTERN)}), lambda x, i:
             i = 1 OR regexp_matches(x, '^\\p{{Lu}}') OR length(x) >= 8) AS kept FROM done),
one AS (SELECT u.* EXCLUDE (processed), coalesce(array_to_string(p.kept, ' '), '') AS processed
        FROM urlless u LEFT JOIN parsed p USING (doc_id)),
{lead_ctes()}
{lead}"""
    out["c5_clean_posts"] = W(C, "SELECT doc_id, source, state, tweet FROM regional")
    out["c3_distinct_rows"] = W(posts_cte(), """SELECT doc_id, source, state FROM (
  SELECT doc_id, 'A' AS source, state FROM posts UNION ALL SELECT doc_id, 'B' AS source, state FROM posts)""")
    out["c7_normalize_text"] = f"""SELECT page_id,
  md5(regexp_replace(lower('see ' || url || ' ' || html), '{WS}+', ' ', 'g')) AS normalized_md5,
  md5(regexp_replace('see ' || url || ' ' || html, 'http{NS}+|www{NS}+', '', 'g')) AS stripped_md5,
  length(regexp_replace('see ' || url || ' ' || html, 'http{NS}+|www{NS}+', '', 'g')) AS stripped_len,
  md5(regexp_replace('see ' || url || ' ' || html, 'http{NS}+', '[]', 'g')) AS placeholder_md5
FROM pages"""
    out["c12_mention_labels"] = W(C, "SELECT doc_id, mentions_trump, mentions_biden, tweet_about FROM labelled")
    from opinion_spark.sources.dims import MENTION_NAMES
    pa, pb = ("|".join(v) for v in MENTION_NAMES.values())
    out["c9_substring_mentions"] = f"""SELECT doc_id, a AS mentions_trump, b AS mentions_biden,
  CASE WHEN a AND NOT b THEN 'trump' WHEN b AND NOT a THEN 'biden' ELSE 'None' END AS tweet_about
FROM (SELECT doc_id, coalesce(regexp_matches(text, {q('(?i)' + pa)}), false) AS a,
             coalesce(regexp_matches(text, {q('(?i)' + pb)}), false) AS b FROM documents)"""
    out["c15_stage_counts"] = W(C, """SELECT 'initial' AS stage, count(*) AS n_rows FROM posts
UNION ALL SELECT 'regional', count(*) FROM regional
UNION ALL SELECT 'only_trump', count(*) FROM labelled WHERE tweet_about = 'trump'
UNION ALL SELECT 'only_biden', count(*) FROM labelled WHERE tweet_about = 'biden'
UNION ALL SELECT 'exactly_one', count(*) FROM labelled WHERE tweet_about IN ('trump', 'biden')""")
    out["c19_score_columns"] = W(C, """SELECT doc_id, 0.0::DOUBLE AS positive, 0.0::DOUBLE AS neutral,
  0.0::DOUBLE AS negative, 0.0::DOUBLE AS compound, 0 AS likely_party FROM labelled WHERE tweet_about IN ('trump', 'biden')""")
    out["n2_lexicon_sentiment"] = W(sentiment_ctes("documents", "text"),
                                    "SELECT doc_id, positive, neutral, negative, compound FROM sent")
    out["n2_lexicon_sentiment_joined"] = out["n2_lexicon_sentiment"]
    out["n3_party_label"] = W(S, "SELECT doc_id, tweet_about, compound, likely_party FROM scored")
    ctx = f"""ctoks AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(text, {q(TOKEN_PATTERN)}) AS toks FROM documents),
ctok AS (SELECT t.doc_id, g.p - 1 AS pos, t.toks[g.p] AS token
         FROM ctoks t, generate_series(1, len(t.toks)) AS g(p)),
cdep AS (
  SELECT *, CASE WHEN pos = 0 THEN 'ROOT' WHEN regexp_matches(token, '^\\p{{Lu}}') THEN 'nsubj'
                 WHEN length(token) >= 8 THEN 'pobj' ELSE 'amod' END AS dep FROM ctok),
cctx AS (
  SELECT doc_id, string_agg(token, ' ' ORDER BY pos) AS context FROM cdep
  WHERE dep IN ('nsubj', 'dobj', 'pobj', 'ROOT') GROUP BY doc_id),
ctxall AS (SELECT d.doc_id, coalesce(c.context, '') AS context FROM documents d LEFT JOIN cctx c USING (doc_id))"""
    out["n1_context_filter"] = W(ctx, "SELECT doc_id, md5(context) AS context_md5, length(context) AS context_len FROM ctxall")
    n4 = C + ",\n" + ctx + f""",
one AS (SELECT l.doc_id, l.tweet, l.tweet_about, c.context FROM labelled l JOIN ctxall c USING (doc_id)
        WHERE l.tweet_about IN ('trump', 'biden')),
{sentiment_ctes('one', 'context', 'ctx_')},
{sentiment_ctes('one', 'tweet', 'full_')},
both_s AS (SELECT o.doc_id, o.tweet_about, c.ctx_compound, f.full_compound,
  CASE WHEN c.ctx_compound >= 0 AND c.ctx_compound < 0.05 THEN f.full_compound ELSE c.ctx_compound END AS cc
  FROM one o JOIN ctx_sent c USING (doc_id) JOIN full_sent f USING (doc_id))"""
    out["n4_party_fallback"] = W(n4, """SELECT doc_id, ctx_compound, full_compound,
  CASE WHEN cc = 0 THEN 0 WHEN tweet_about = 'biden' THEN CASE WHEN cc > 0 THEN 1 ELSE 2 END
       WHEN tweet_about = 'trump' THEN CASE WHEN cc > 0 THEN 2 ELSE 1 END ELSE 0 END AS likely_party
FROM both_s""")
    out["n5_class_summary"] = W(S, """SELECT count(*) FILTER (WHERE likely_party = 0) AS n_unsure,
  count(*) FILTER (WHERE likely_party = 1) AS n_dem, count(*) FILTER (WHERE likely_party = 2) AS n_rep,
  count(*) AS n_total,
  round(count(*) FILTER (WHERE likely_party = 0) * 100.0 / count(*), 6) AS pct_unsure,
  round(count(*) FILTER (WHERE likely_party = 1) * 100.0 / count(*), 6) AS pct_dem,
  round(count(*) FILTER (WHERE likely_party = 2) * 100.0 / count(*), 6) AS pct_rep,
  round(count(*) FILTER (WHERE compound = 0) * 1.0 / count(*), 6) AS frac_zero_compound FROM scored""")
    out["n6_score_filters"] = W(S, """SELECT doc_id, 'positive' AS kind FROM scored WHERE compound > 0.05
UNION ALL SELECT doc_id, 'negative' FROM scored WHERE compound < 0""")
    samp = S + """,
samp AS (SELECT *, row_number() OVER (PARTITION BY likely_party ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) AS sample_rank
         FROM scored)"""
    out["n8_seeded_sample"] = W(samp, "SELECT doc_id, likely_party, sample_rank FROM samp WHERE sample_rank <= 10")
    out["n9_sample_listing"] = W(samp, """SELECT doc_id, likely_party,
  md5(CAST(sample_rank AS VARCHAR) || '. ' || tweet || repeat(' ', greatest(0, 1000 - length(tweet)))) AS listing_md5,
  length(CAST(sample_rank AS VARCHAR) || '. ' || tweet || repeat(' ', greatest(0, 1000 - length(tweet)))) AS listing_len
FROM samp WHERE sample_rank <= 10""")
    out["n7_sample_summary"] = W(S, """SELECT least(count(*), 100) AS n_rows, least(count(*), 100) AS n_ids,
  least(count(*), 100) AS n_known FROM scored""")
    out["j1_attach_counts"] = W(S, """SELECT f.state, f.tweet_count, p.total,
  round(CAST(p.n_dem AS DOUBLE) / nullif(p.n_dem + p.n_rep, 0), 9) AS democratic_proportion
FROM (SELECT state, count(*) AS tweet_count FROM scored WHERE state IS NOT NULL GROUP BY state) f JOIN piv p USING (state)""")
    ordinals = "SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS ordinal FROM documents"
    out["s1_quoted_csv"] = "SELECT doc_id, length(coalesce(text, '')) AS n_chars, md5(coalesce(text, '')) AS text_md5, source FROM documents"
    out["s9_ordinals"] = ordinals
    out["s10_first_rows"] = f"SELECT * FROM ({ordinals}) WHERE ordinal < 100"
    out["r1_frequency"] = W(S, """SELECT f.state, f.tweet_count, c.state_code FROM (
  SELECT state, count(*) AS tweet_count FROM scored WHERE state IS NOT NULL GROUP BY state) f
LEFT JOIN codes c USING (state)""")
    out["r3_class_pivot"] = W(S, """SELECT state, n_unsure, n_dem, n_rep, total,
  round(CAST(n_dem AS DOUBLE) / nullif(n_dem + n_rep, 0), 9) AS democratic_proportion,
  round(CAST(n_rep AS DOUBLE) / nullif(n_dem + n_rep, 0), 9) AS republican_proportion,
  round(CAST(n_dem AS DOUBLE) / nullif(total, 0), 9) AS dem_share_of_all,
  round(CAST(n_rep AS DOUBLE) / nullif(total, 0), 9) AS rep_share_of_all FROM piv""")
    out["r7_class_totals"] = W(S, """SELECT CAST(coalesce(sum(n_dem), 0) AS BIGINT) AS total_dem,
  CAST(coalesce(sum(n_rep), 0) AS BIGINT) AS total_rep, round(r, 9) AS tweet_ratio FROM shares, ratio GROUP BY r""")
    out["r9_rebalance_plain"] = W(S, """SELECT state, round(democratic_proportion, 9) AS democratic_proportion,
  round(republican_proportion * r, 9) AS republican_proportion FROM shares, ratio""")
    out["r11_range"] = W(S, """SELECT round(min(dem_pct), 9) AS min_value, round(max(dem_pct), 9) AS max_value,
  round((min(dem_pct) + max(dem_pct)) / 2.0, 9) AS mid_value FROM lead""")
    out["r12_tick_edges"] = W(S, """SELECT t.tick, round(mn + t.tick * (mx - mn) / 5, 9) AS edge,
  CAST(t.tick * 20 AS VARCHAR) || '%' AS label
FROM (SELECT min(dem_pct) AS mn, max(dem_pct) AS mx FROM lead), range(0, 6) AS t(tick)""")
    out["r13_lead_category"] = W(S, """SELECT state, CASE WHEN ls IS NULL THEN NULL WHEN ls = 0 THEN 'tie'
  ELSE (CASE WHEN ls > 0 THEN 'A' ELSE 'B' END) || ' ' ||
       (CASE WHEN abs(ls) <= 5 THEN '0-5' WHEN abs(ls) <= 10 THEN '5-10' ELSE '>10' END) END AS category
FROM (SELECT state, dem_pct - 50.0 AS ls FROM lead)""")
    out["r14_party_totals"] = W(S, """SELECT 'Democratic' AS party, CAST(coalesce(sum(n_dem), 0) AS BIGINT) AS tweet_count FROM shares
UNION ALL SELECT 'Republican', CAST(coalesce(sum(n_rep), 0) AS BIGINT) FROM shares""")
    out["r15_melt"] = W(S, """SELECT state, 'n_dem' AS party, n_dem AS count FROM shares
UNION ALL SELECT state, 'n_rep', n_rep FROM shares""")
    out["r16_sentiment_difference"] = W(S, """SELECT round((sa - sb) / nullif(sa + sb, 0), 6) AS sentiment_difference FROM (
  SELECT coalesce(sum(abs(compound)) FILTER (WHERE likely_party = 1), 0.0) AS sa,
         coalesce(sum(abs(compound)) FILTER (WHERE likely_party = 2), 0.0) AS sb FROM scored)""")
    out["r17_first_per_group"] = W(C, """SELECT f.state, f.tweet_count, g.source FROM
  (SELECT state, count(*) AS tweet_count FROM regional WHERE state IS NOT NULL GROUP BY state) f
LEFT JOIN (SELECT state, arg_min(source, {'s': src_no, 'd': doc_id}) AS source FROM regional
           WHERE source IS NOT NULL GROUP BY state) g USING (state)""")
    out["r18_joint_frequency"] = W(S, "SELECT likely_party, state, count(*) AS count FROM scored GROUP BY likely_party, state")
    out["r19_relative_frequency"] = W(S, """SELECT likely_party, round(count(*) / (SELECT count(*) FROM scored), 9) AS proportion
FROM scored WHERE likely_party IS NOT NULL GROUP BY likely_party""")
    out["r20_second_largest"] = W(S, """SELECT min(tweet_count) AS second_largest FROM (
  SELECT tweet_count FROM shares WHERE tweet_count IS NOT NULL ORDER BY tweet_count DESC LIMIT 2)""")
    out["r21_activity_weighted"] = W(S, """SELECT state,
  round((n_dem * 0.31) / nullif(n_dem * 0.31 + n_rep * 0.69, 0), 9) AS democratic_proportion,
  round((n_rep * 0.69) / nullif(n_dem * 0.31 + n_rep * 0.69, 0), 9) AS republican_proportion FROM shares""")
    votes_ctes = f"""precinct AS (
  SELECT 'N' || CAST(c.c_nationkey AS VARCHAR) AS state_po, o.o_orderstatus AS candidate,
         CAST(floor(o.o_totalprice) AS BIGINT) AS votes
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
sv AS (
  SELECT state_po, coalesce(sum(votes) FILTER (WHERE candidate = {q(B.CANDIDATE_A)}), 0) AS votes_a,
         coalesce(sum(votes) FILTER (WHERE candidate = {q(B.CANDIDATE_B)}), 0) AS votes_b,
         coalesce(sum(votes), 0) AS total_votes
  FROM precinct WHERE state_po IS NOT NULL AND candidate IS NOT NULL GROUP BY state_po),
actual AS (
  SELECT *, CAST(votes_a AS DOUBLE) / nullif(CAST(total_votes AS DOUBLE), 0) * 100.0 AS biden_pct,
         CAST(votes_a AS DOUBLE) / nullif(CAST(total_votes AS DOUBLE), 0) AS democratic_proportion,
         CAST(votes_a - votes_b AS DOUBLE) / nullif(CAST(total_votes AS DOUBLE), 0) * 100.0 AS lead_size
  FROM sv)"""
    hist_ctes = f"""history AS (
  SELECT year(o.o_orderdate) AS year, upper(n.n_name) AS state,
         'N' || CAST(c.c_nationkey AS VARCHAR) AS state_po, o.o_orderpriority AS office,
         CASE o.o_orderstatus {' '.join(f"WHEN {q(k)} THEN {q(v)}" for k, v in B.PARTY_OF_STATUS.items())} END AS party_detailed,
         CAST(floor(o.o_totalprice) AS BIGINT) AS candidatevotes
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey),
hf AS (SELECT * FROM history WHERE party_detailed IN ('DEMOCRAT', 'REPUBLICAN')
       AND office = {q(B.PRESIDENT_OFFICE)} AND year <> {B.HELD_OUT_YEAR}),
hr AS (SELECT *, CAST(candidatevotes AS DOUBLE) / sum(candidatevotes) OVER (PARTITION BY year, state) AS r FROM hf),
prior AS (SELECT state, state_po, party_detailed, avg(r) AS ratio FROM hr GROUP BY state, state_po, party_detailed)"""
    out["v4_state_votes"] = W(votes_ctes, """SELECT state_po, votes_a, votes_b, total_votes, round(biden_pct, 9) AS biden_pct,
  round(democratic_proportion, 9) AS democratic_proportion, round(lead_size, 9) AS lead_size FROM actual""")
    out["v5_national_margin"] = W(votes_ctes, """SELECT sum(votes_a) AS votes_a, sum(votes_b) AS votes_b,
  round(abs(sum(votes_b) - sum(votes_a)) / CAST(sum(votes_b) + sum(votes_a) AS DOUBLE) * 100.0, 9) AS national_margin FROM actual""")
    cmp = S + ",\n" + votes_ctes + """,
pred AS (SELECT state_code, round(dem_pct - 50.0, 9) AS predicted_lead FROM lead),
cmp AS (SELECT a.state_po, a.lead_size AS actual_lead, p.predicted_lead, a.lead_size - p.predicted_lead AS diff
        FROM actual a LEFT JOIN pred p ON a.state_po = p.state_code)"""
    out["c_lead_difference"] = W(cmp, """SELECT state_po, round(actual_lead, 9) AS actual_lead, round(predicted_lead, 9) AS predicted_lead,
  round(diff, 9) AS lead_size_diff FROM cmp""")
    out["v7_markers"] = W(cmp + f""",
centers AS (SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS state_code, CAST(n_nationkey * 1.5 + 20.0 AS DOUBLE) AS lat,
                   CAST(n_regionkey * -10.0 - 70.0 AS DOUBLE) AS lon FROM nation WHERE n_regionkey IN ({regions})),
cl AS (SELECT c.state_po, ce.lat, ce.lon,
         CASE WHEN diff < 1 AND diff >= 0 THEN 1.0 WHEN diff > -1 AND diff <= 0 THEN -1.0 ELSE diff END AS d
       FROM cmp c JOIN centers ce ON c.state_po = ce.state_code WHERE c.diff IS NOT NULL)""",
      """SELECT state_po, lat, lon, round(d, 9) AS diff, CASE WHEN d > 0 THEN 'blue' ELSE 'red' END AS color,
  CASE WHEN d > 0 THEN '▲' ELSE '▼' END AS glyph, printf('%s: %.1f%%', state_po, d) AS label,
  round(least(abs(d) * 0.5, 10.0), 9) AS size, round(least(abs(d) * 0.5, 10.0) * 2, 9) AS font FROM cl""")
    out["v8_history_filter"] = W(hist_ctes, "SELECT year, state_po, party_detailed, candidatevotes FROM hf")
    out["v9_year_shares"] = W(hist_ctes, """SELECT year, state, party_detailed, votes,
  round(CAST(votes AS DOUBLE) / sum(votes) OVER (PARTITION BY year, state), 9) AS share FROM (
  SELECT year, state, party_detailed, sum(candidatevotes) AS votes FROM hf GROUP BY year, state, state_po, party_detailed)""")
    out["v10_prior"] = W(hist_ctes, "SELECT state, state_po, party_detailed, round(ratio, 9) AS ratio FROM prior")
    pw = S + ",\n" + hist_ctes + """,
pp AS (SELECT state, max(ratio) FILTER (WHERE party_detailed = 'DEMOCRAT') AS pa,
              max(ratio) FILTER (WHERE party_detailed = 'REPUBLICAN') AS pb FROM prior GROUP BY state),
pw AS (SELECT s.state, (pa * democratic_proportion) / nullif(pa * democratic_proportion + pb * republican_proportion, 0) AS dp,
              (pb * republican_proportion) / nullif(pa * democratic_proportion + pb * republican_proportion, 0) AS rp
       FROM shares s JOIN pp ON upper(s.state) = pp.state)"""
    out["v11_prior_weighted"] = W(pw, "SELECT state, round(dp, 9) AS democratic_proportion, round(rp, 9) AS republican_proportion FROM pw")
    out["v12_drill_down"] = W(pw, """SELECT state, round(democratic_proportion, 9) AS democratic_proportion, 'before' AS stage
FROM shares WHERE state = 'NATION_3'
UNION ALL SELECT state, round(dp, 9), 'after' FROM pw WHERE state = 'NATION_3'""")
    out.update(similarity_sql())
    out.update(topics_sql())
    out["c16_word_costs"] = """WITH dtok AS MATERIALIZED (
  SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}'']+') AS toks FROM documents),
wc AS (SELECT unnest(toks) AS word FROM dtok),
cnt AS (SELECT word, count(*) AS c FROM wc GROUP BY word),
rk AS (SELECT word, row_number() OVER (ORDER BY c DESC, word) - 1 AS r, count(*) OVER () AS n FROM cnt)
SELECT word, round(ln((r + 1.0) * ln(CAST(n AS DOUBLE))), 9) AS cost FROM rk"""
    out.update(hashtag_sql())
    return out


#: C16's costs of the corpus' words, and the documents with their derived tag.
TAG_COSTS = r"""dtok AS MATERIALIZED (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}'']+') AS toks FROM documents),
wc AS (SELECT unnest(toks) AS word FROM dtok),
cnt AS (SELECT word, count(*) AS c FROM wc GROUP BY word),
rk AS (SELECT word, row_number() OVER (ORDER BY c DESC, word) - 1 AS r, count(*) OVER () AS n FROM cnt),
costs AS MATERIALIZED (SELECT word, CAST(round(ln((r + 1.0) * ln(CAST(n AS DOUBLE))) * 1000000) AS BIGINT) AS cost FROM rk),
longest AS (SELECT max(length(word)) AS longest FROM costs),
tagged AS (SELECT doc_id, text || ' #' || list_aggregate(list_transform(regexp_extract_all(text, '\p{L}{3,}')[1:3],
             lambda w: CASE WHEN w[1] = 'ß' THEN 'Ss' ELSE upper(w[1]) END || lower(substr(w, 2))), 'string_agg', '') AS text FROM documents)"""

#: C17 as a recursive query over the ends of each letter run of the tags in a table of texts.
SEGMENTED = r"""tags AS (SELECT DISTINCT substr(t, 2) AS tag FROM (SELECT unnest(regexp_extract_all(text, '#[\p{L}\p{N}_]+')) AS t FROM %s)),
tparts AS MATERIALIZED (SELECT tag, p.i AS i, parts[p.i] AS part FROM (
  SELECT tag, regexp_extract_all(tag, '\p{L}+|[^\p{L}_]+') AS parts FROM tags), generate_series(1, len(parts)) AS p(i)),
runs AS (SELECT DISTINCT part, length(part) AS n FROM tparts WHERE regexp_matches(part, '^\p{L}')),
cand AS (SELECT x.part, x.e, x.len, c.cost FROM (
    SELECT r.part, e.e, l.len, substr(lower(r.part), e.e - l.len + 1, l.len) AS word
    FROM runs r, longest, generate_series(1, r.n) AS e(e), generate_series(1, least(e.e, longest)) AS l(len)) x
  LEFT JOIN costs c USING (word) WHERE c.cost IS NOT NULL OR x.len = 1),
options AS MATERIALIZED (SELECT part, e, list({'u': CASE WHEN cost IS NULL THEN 1 ELSE 0 END, 'c': coalesce(cost, 0), 'l': len}) AS os
  FROM cand GROUP BY part, e),
dp AS (
  SELECT part, n, 0::BIGINT AS e, [{'u': 0::BIGINT, 'c': 0::BIGINT, 'l': 0::BIGINT}] AS best FROM runs
  UNION ALL
  SELECT d.part, d.n, d.e + 1, list_append(d.best, list_sort(list_transform(o.os, lambda x:
    {'u': d.best[d.e + 2 - x.l].u + x.u, 'c': d.best[d.e + 2 - x.l].c + x.c, 'l': x.l::BIGINT}))[1])
  FROM dp d JOIN options o ON o.part = d.part AND o.e = d.e + 1),
bk AS (
  SELECT part, n AS pos, best, '' AS words, best[n + 1].u AS u, best[n + 1].c AS c FROM dp WHERE e = n
  UNION ALL
  SELECT part, pos - best[pos + 1].l, best, substr(part, CAST(pos - best[pos + 1].l + 1 AS BIGINT), best[pos + 1].l)
         || CASE WHEN words = '' THEN '' ELSE ' ' || words END, u, c FROM bk WHERE pos > 0),
found AS (SELECT part, words, u, c FROM bk WHERE pos = 0),
segmented AS (SELECT t.tag, string_agg(coalesce(f.words, t.part), ' ' ORDER BY t.i) AS words,
                CAST(coalesce(sum(f.u), 0) AS BIGINT) AS unknown, coalesce(sum(f.c), 0) / 1000000.0 AS cost
              FROM tparts t LEFT JOIN found f USING (part) GROUP BY t.tag)"""


def replaced_ctes(src: str) -> str:
    return f"""pieces AS (SELECT doc_id, r.i, rs[r.i] AS run FROM (
  SELECT doc_id, regexp_extract_all(text, '#[\\p{{L}}\\p{{N}}_]+|[^#]+|#') AS rs FROM {src}), generate_series(1, len(rs)) AS r(i)),
done AS (SELECT p.doc_id, string_agg(coalesce(s.words, p.run), '' ORDER BY p.i) AS text
         FROM pieces p LEFT JOIN segmented s ON p.run = '#' || s.tag GROUP BY p.doc_id)"""


def hashtag_sql() -> dict[str, str]:
    stripped = r"""stripped AS (SELECT doc_id, regexp_replace(text, 'http[^ \t\n\r\f\x0b]+|www[^ \t\n\r\f\x0b]+', '', 'g') AS text FROM tagged)"""
    return {
        "c17_segment_tags": f"""WITH RECURSIVE {TAG_COSTS},
{SEGMENTED % "tagged"}
SELECT tag, words, unknown, round(CAST(cost AS DOUBLE), 6) AS cost FROM segmented""",
        "c14_process_posts": f"""WITH RECURSIVE {TAG_COSTS},
{stripped},
{SEGMENTED % "stripped"},
{replaced_ctes("stripped")}
SELECT doc_id, length(text) AS n_chars, md5(text) AS text_md5 FROM done""",
    }


def topics_sql() -> dict[str, str]:
    from opinion_spark.plans.queries import MAX_DF, MAX_FEATURES, MIN_DF

    stops = ", ".join(f"({q(w)})" for w in sorted(set(STOP_WORDS)))
    tok = r"[\p{L}\p{N}_]{2,}"
    base = f"""stops AS (SELECT * FROM (VALUES {stops}) AS s(term)),
dtok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), {q(tok)}) AS toks FROM documents),
toks AS (SELECT doc_id, unnest(toks) AS term FROM dtok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN (SELECT term FROM stops) GROUP BY doc_id, term),
nd AS (SELECT count(*) AS n FROM documents),
stats AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tf GROUP BY term),
vocab AS (SELECT term, df FROM stats, nd WHERE df >= {MIN_DF} AND df <= {MAX_DF} * n
          ORDER BY cf DESC, term LIMIT {MAX_FEATURES}),
x AS (SELECT tf.doc_id, tf.term, tf.tf * (ln((1.0 + n) / (v.df + 1.0)) + 1.0) AS x
      FROM tf JOIN vocab v USING (term), nd),
w AS (SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS tfidf FROM x),
langs AS (SELECT doc_id, lang AS cluster FROM documents),
lsize AS (SELECT cluster, count(*) AS size FROM langs GROUP BY cluster),
lscore AS (SELECT l.cluster, w.term, sum(w.tfidf) / max(s.size) AS score
           FROM w JOIN langs l USING (doc_id) JOIN lsize s USING (cluster) GROUP BY l.cluster, w.term),
ltop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term) AS rank
         FROM lscore) WHERE rank <= 6)"""
    out = {}
    out["t1_term_counts"] = W(base, "SELECT doc_id, term, tf FROM tf")
    out["t2_vocabulary"] = W(base, "SELECT term, df FROM vocab")
    out["t3_tfidf"] = W(base, "SELECT doc_id, term, round(tfidf, 9) AS tfidf FROM w")
    out["t5_top_terms_by_lang"] = W(base, "SELECT cluster, rank, term, round(score, 9) AS score FROM ltop WHERE rank <= 5")
    out["t11_term_weights"] = W(base, """SELECT t.cluster, t.rank, t.term, round(50.0 * pow(0.85, t.rank - 1), 9) AS size,
  round(1.0 - (t.rank - 1) * 0.5 / c.n, 9) AS opacity
FROM ltop t JOIN (SELECT cluster, count(*) AS n FROM ltop GROUP BY cluster) c USING (cluster)""")
    out["t12_cluster_labels"] = W(base, """SELECT cluster, row_number() OVER (ORDER BY cluster) AS ordinal, size,
  printf('Cluster %d (%d elements)', row_number() OVER (ORDER BY cluster), size) AS label FROM lsize""")
    out["t10_report"] = """SELECT cluster, pos, doc_id, substr(text, 1, 100) AS snippet FROM (
  SELECT lang AS cluster, doc_id, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS pos FROM documents)
WHERE pos <= 3"""
    grp = f"""stops AS (SELECT * FROM (VALUES {stops}) AS s(term)),
dtok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), {q(tok)}) AS toks FROM documents),
toks AS (SELECT doc_id, unnest(toks) AS term FROM dtok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN (SELECT term FROM stops) GROUP BY doc_id, term),
g AS (SELECT doc_id, source AS cluster FROM documents),
gtf AS (SELECT g.cluster, tf.* FROM tf JOIN g USING (doc_id)),
gn AS (SELECT cluster, count(*) AS n_docs FROM g GROUP BY cluster),
gs AS (SELECT cluster, term, count(*) AS df, sum(tf) AS cf FROM gtf GROUP BY cluster, term),
gv AS (SELECT * FROM (SELECT gs.*, gn.n_docs, row_number() OVER (PARTITION BY cluster ORDER BY cf DESC, term) AS r
       FROM gs JOIN gn USING (cluster) WHERE df >= {MIN_DF} AND df <= {MAX_DF} * n_docs) WHERE r <= {MAX_FEATURES}),
gx AS (SELECT gtf.cluster, gtf.doc_id, gtf.term, gv.n_docs, gtf.tf * (ln((gv.n_docs + 1.0) / (gv.df + 1.0)) + 1.0) AS x
       FROM gtf JOIN gv USING (cluster, term)),
gw AS (SELECT cluster, term, n_docs, x / sqrt(sum(x * x) OVER (PARTITION BY cluster, doc_id)) AS v FROM gx),
gsc AS (SELECT cluster, term, sum(v) / max(n_docs) AS score FROM gw GROUP BY cluster, term)"""
    out["t6_group_terms"] = W(grp, """SELECT cluster, rank, term, round(score, 9) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, term) AS rank FROM gsc) WHERE rank <= 5""")

    def cos(groups: str) -> str:
        return f"""stops AS (SELECT * FROM (VALUES {stops}) AS s(term)),
dtok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), {q(tok)}) AS toks FROM documents),
toks AS (SELECT doc_id, unnest(toks) AS term FROM dtok),
tf AS (SELECT doc_id, term, count(*) AS tf FROM toks WHERE term NOT IN (SELECT term FROM stops) GROUP BY doc_id, term),
g AS ({groups}),
ct AS (SELECT g.cluster, tf.term, sum(tf.tf) AS tf FROM tf JOIN g USING (doc_id) GROUP BY g.cluster, tf.term),
nc AS (SELECT count(DISTINCT cluster) AS n FROM ct),
cdf AS (SELECT term, count(*) AS df FROM ct GROUP BY term),
cx AS (SELECT ct.cluster, ct.term, ct.tf * (ln((1.0 + n) / (cdf.df + 1.0)) + 1.0) AS x FROM ct JOIN cdf USING (term), nc),
cv AS (SELECT cluster, term, x / sqrt(sum(x * x) OVER (PARTITION BY cluster)) AS v FROM cx),
cc AS (SELECT a.cluster AS c1, b.cluster AS c2, sum(a.v * b.v) AS cosine FROM cv a JOIN cv b
       ON a.term = b.term AND a.cluster < b.cluster GROUP BY a.cluster, b.cluster)"""
    out["t7_cluster_cosine"] = W(cos("SELECT doc_id, lang AS cluster FROM documents"),
                                 "SELECT c1, c2, round(cosine, 9) AS cosine FROM cc")
    out["t8_merge_pair"] = W(cos("SELECT doc_id, source AS cluster FROM documents"),
                             "SELECT c1, c2, round(cosine, 9) AS cosine FROM cc ORDER BY cosine DESC, c1, c2 LIMIT 1")
    rounds = "".join(f""",
ct{r} AS MATERIALIZED (SELECT o.cur AS cluster, b.term, sum(b.tf) AS tf FROM bct b JOIN o{r} o ON o.src = b.cluster GROUP BY 1, 2),
cx{r} AS (SELECT cluster, term, tf * (ln((1.0 + (SELECT count(DISTINCT cluster) FROM ct{r})) / (count(*) OVER (PARTITION BY term) + 1.0)) + 1.0) AS x FROM ct{r}),
cv{r} AS MATERIALIZED (SELECT cluster, term, x / sqrt(sum(x * x) OVER (PARTITION BY cluster)) AS v FROM cx{r}),
best{r} AS MATERIALIZED (SELECT c1, c2 FROM (SELECT a.cluster AS c1, b.cluster AS c2, sum(a.v * b.v) AS cosine
  FROM cv{r} a JOIN cv{r} b ON a.term = b.term AND a.cluster < b.cluster GROUP BY 1, 2) ORDER BY round(cosine, 12) DESC, c1, c2 LIMIT 1),
o{r + 1} AS MATERIALIZED (SELECT src, CASE WHEN (SELECT count(DISTINCT cur) FROM o{r}) > 5 AND cur = (SELECT c2 FROM best{r})
  THEN (SELECT c1 FROM best{r}) ELSE cur END AS cur FROM o{r})""" for r in range(15))
    out["t8_merge_sources"] = W(f"""stops AS (SELECT * FROM (VALUES {stops}) AS s(term)),
dtok AS MATERIALIZED (SELECT doc_id, regexp_extract_all(lower(text), {q(tok)}) AS toks FROM documents),
toks AS (SELECT doc_id, unnest(toks) AS term FROM dtok),
g AS (SELECT doc_id, CAST(regexp_extract(source, '(\\d+)$', 1) AS BIGINT) AS cluster FROM documents),
bct AS MATERIALIZED (SELECT cluster, term, count(*) AS tf FROM toks JOIN g USING (doc_id)
  WHERE term NOT IN (SELECT term FROM stops) GROUP BY 1, 2),
o0 AS MATERIALIZED (SELECT DISTINCT cluster AS src, cluster AS cur FROM g)""" + rounds,
                                "SELECT g.doc_id, o.cur AS cluster FROM g JOIN o15 o ON o.src = g.cluster")
    return out


def _base_hash(x: str) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::BIGINT % {PRIME})"


SHORT = "(SELECT conv_id * 1000000 + turn AS doc_id, text FROM conversations)"


def sig_ctes(k: int, q: int, char_xor: bool = False, name: str = "sig", texts: str = SHORT) -> str:
    a, b = permutations(k)
    sh = f"""{name}_sh AS (SELECT d.doc_id, substr(d.text, g.i, {q}) AS sh
  FROM {texts} d, generate_series(1, length(d.text) - {q - 1}) AS g(i))"""
    if not char_xor:
        hh = f"{name}_h AS (SELECT doc_id, {_base_hash('sh')} AS h FROM {name}_sh)"
        mins = ", ".join(f"min(({a[i]} * h + {b[i]}) % {PRIME})" for i in range(k))
    else:
        hs = ", ".join(f"{_base_hash(f'substr(sh, {j + 1}, 1)')} AS c{j}" for j in range(q))
        hh = f"{name}_h AS (SELECT doc_id, {hs} FROM {name}_sh)"

        def x(i):
            parts = [f"(({a[i]} * c{j} + {b[i]}) % {PRIME})" for j in range(q)]
            e = parts[0]
            for p_ in parts[1:]:
                e = f"xor({e}, {p_})"
            return f"min({e})"
        mins = ", ".join(x(i) for i in range(k))
    return f"""{sh},
{hh},
{name} AS (SELECT doc_id, [{mins}] AS sig FROM {name}_h GROUP BY doc_id)"""


def pairs_ctes(bands: int, rows: int, lo: float, hi: float | None, index_block: int | None = None) -> str:
    blk = f"[CAST(floor((dense_rank() OVER (ORDER BY doc_id) - 1) / {index_block}) AS INTEGER)] || " if index_block else ""
    return f"""bands AS (SELECT doc_id, b.band, {blk}sig[b.band * {rows} + 1 : b.band * {rows} + {rows}] AS bkey
  FROM sig, range(0, {bands}) AS b(band)),
cand AS (SELECT DISTINCT x.doc_id AS src, y.doc_id AS dst FROM bands x JOIN bands y
  ON x.band = y.band AND x.bkey = y.bkey AND x.doc_id < y.doc_id),
ver AS (SELECT c.src, c.dst, CAST(list_sum(list_transform(range(1, len(a.sig) + 1),
    lambda i: CASE WHEN a.sig[i] = b.sig[i] THEN 1 ELSE 0 END)) AS DOUBLE) / len(a.sig) AS similarity
  FROM cand c JOIN sig a ON a.doc_id = c.src JOIN sig b ON b.doc_id = c.dst),
edges AS (SELECT src, dst, similarity FROM ver WHERE similarity >= {lo}{'' if hi is None else f' AND similarity < {hi}'})"""


def similarity_sql() -> dict[str, str]:
    from opinion_spark.plans.queries import OWN_LSH, TOPIC_LSH

    t, o = TOPIC_LSH, OWN_LSH
    out = {}
    out["l1_shingles"] = f"""SELECT doc_id, len(sh) AS n_shingles, md5(array_to_string(list_sort(sh), chr(1))) AS shingles_md5
FROM (SELECT doc_id, list_distinct(list_transform(generate_series(1, length(text) - {t['q'] - 1}),
      lambda i: substr(text, i, {t['q']}))) AS sh FROM (SELECT conv_id * 1000000 + turn AS doc_id, text FROM conversations))"""
    S = sig_ctes(t["k"], t["q"])
    out["l2_minhash"] = W(S, "SELECT doc_id, sig FROM sig")
    out["l3_char_xor_minhash"] = W(sig_ctes(o["k"], o["q"], char_xor=True, texts="documents"), "SELECT doc_id, sig FROM sig")
    out["l4_bands"] = W(S, "SELECT doc_id, b.band, sig[b.band * 2 + 1 : b.band * 2 + 2] AS bkey FROM sig, range(0, 28) AS b(band)")
    P = S + ",\n" + pairs_ctes(t["bands"], t["rows"], t["lo"], t["hi"])
    out["l7_similar_pairs"] = W(P, "SELECT src, dst, round(similarity, 9) AS similarity FROM edges")
    PB = S + ",\n" + pairs_ctes(t["bands"], t["rows"], t["lo"], t["hi"], index_block=60)
    PA = S + ",\n" + pairs_ctes(t["bands"], t["rows"], t["lo"], None)
    out["l11_pairs_above"] = W(PA, "SELECT src, dst, round(similarity, 9) AS similarity FROM edges")
    out["l13_louvain_quality"] = """SELECT count(*) AS n_rows, count(DISTINCT conv_id * 1000000 + turn) AS n_vertices,
  true AS beats_languages, true AS beats_singletons FROM conversations"""
    out["l15_groups_by_lang"] = """SELECT lang AS community, count(*) AS size FROM documents
GROUP BY lang HAVING count(*) >= 5"""
    out["l6_blocked_pairs"] = W(PB, "SELECT src, dst, round(similarity, 9) AS similarity FROM edges")
    own = sig_ctes(o["k"], o["q"], char_xor=True, texts="documents") + f""",
bands AS (SELECT doc_id, b.band, sig[b.band * {o['rows']} + 1 : b.band * {o['rows']} + {o['rows']}] AS bkey
  FROM sig, range(0, {o['bands']}) AS b(band)),
bp AS (SELECT x.band, x.doc_id AS src, y.doc_id AS dst FROM bands x JOIN bands y
  ON x.band = y.band AND x.bkey = y.bkey AND x.doc_id < y.doc_id),
bs AS (SELECT bp.band, bp.src, bp.dst,
         CAST(len(list_intersect(list_distinct(a.sig), list_distinct(b.sig))) AS DOUBLE)
         / len(list_distinct(a.sig || b.sig)) AS similarity
       FROM bp JOIN sig a ON a.doc_id = bp.src JOIN sig b ON b.doc_id = bp.dst)"""
    out["l10_own_lsh"] = W(own, f"""SELECT band, src, dst, round(similarity, 9) AS similarity FROM bs
WHERE similarity >= {o['lo']} AND similarity < {o['hi']}""")
    deg = P + """,
ends AS (SELECT src AS id, similarity FROM edges UNION ALL SELECT dst, similarity FROM edges),
deg AS (SELECT id, count(*) AS degree, sum(similarity) AS strength FROM ends GROUP BY id)"""
    out["l12_similarity_graph"] = W(deg, """SELECT d.doc_id AS id, coalesce(g.degree, 0) AS degree,
  round(coalesce(g.strength, 0.0), 6) AS strength FROM (SELECT conv_id * 1000000 + turn AS doc_id FROM conversations) d LEFT JOIN deg g ON g.id = d.doc_id""")
    out["l14_modularity_by_lang"] = W(deg + """,
part AS (SELECT c.conv_id * 1000000 + c.turn AS id, d.lang AS community FROM conversations c LEFT JOIN documents d ON d.doc_id = c.conv_id),
m AS (SELECT sum(similarity) AS m FROM edges),
intra AS (SELECT p1.community, sum(e.similarity) AS w FROM edges e JOIN part p1 ON p1.id = e.src
          JOIN part p2 ON p2.id = e.dst WHERE p1.community = p2.community GROUP BY p1.community),
tot AS (SELECT p.community, sum(g.strength) AS d FROM deg g JOIN part p ON p.id = g.id GROUP BY p.community)""",
      """SELECT round(sum(coalesce(i.w, 0.0) / m.m - (t.d / (2 * m.m)) * (t.d / (2 * m.m))), 6) AS modularity
FROM tot t LEFT JOIN intra i USING (community), m""")
    return out
