"""Lexicon sentiment and stance labels.

``lexicon_sentiment`` follows the published rule-based scoring of Hutto &
Gilbert (2014): per-token valence from a lexicon, emphasis by capitals, booster
words, negation ("never so", "without doubt", "no" and "least" included) in the three
tokens before, idioms and two-word boosters around a word, the contrastive "but" rule,
exclamation / question emphasis, and the normalisation ``s / sqrt(s^2 + alpha)``. The
lexicon is the caller's, as are further idioms; emoticons are no word tokens and do not count.

Scoring is a pure per-row expression over the token array (higher-order
functions), so it needs no explode, no join and no shuffle: the lexicon is a
map literal whose size is checked on the driver before it is inlined. Sums are
taken in whole units so they do not depend on evaluation order.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# --- fixed values: constants of the published scoring rule ---
EXCLAMATION_MAX = 4
ALPHA = 15.0
NEGATIONS = [
    "not", "never", "none", "nothing", "neither", "nor", "nowhere", "nope", "cannot",
    "without", "rarely", "seldom", "despite", "uhuh", "aint", "isnt", "arent", "wasnt", "werent", "dont",
    "doesnt", "didnt", "wont", "wouldnt", "cant", "couldnt", "shouldnt", "hasnt", "havent", "hadnt",
    "darent", "mightnt", "mustnt", "neednt", "oughtnt", "shant",
]
INCREASING = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "effing", "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking", "fricking", "frickin", "frigging",
    "friggin", "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely",
    "quite", "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous",
    "tremendously", "uber", "unbelievably", "unusually", "utter", "utterly", "very",
]
DECREASING = [
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof",
]

#: Word sequences with a valence of their own, and those that soften what follows.
IDIOMS = {"the shit": 3.0, "the bomb": 3.0, "bad ass": 1.5, "badass": 1.5, "bus stop": 0.0, "yeah right": -2.0, "kiss of death": -1.5, "to die for": 3.0,
          "beating heart": 3.1, "broken heart": -2.9}
SOFTENING = ["kind of", "sort of", "just enough"]

TOKEN_PATTERN = r"[\p{L}\p{N}_']+"
MAX_INLINE_LEXICON = 64  # entries inlined as a map literal; larger lexicons are joined

# Exact whole-unit arithmetic. Lexicon valences (four decimals, times -0.74 after
# "no"), boosters and capitals are whole 1e-6 units; each of the four factors (1, -0.74, 1.25) is in
# hundredths, so a token's valence is a whole number of 1e-14 units. It is
# rounded to 1e-7, half away from zero, and the "but" factors (5, 10 or 15
# tenths) bring sums to 1e-8 units. They stay far below 2^53, so the final
# division gives the same double in any order of summation.
_VAL_SCALE = 10_000
_BOOST, _CAPS = (293_000, 278_350, 263_700), (733_000, 696_350, 659_700)  # 0.293 and 0.733, by distance 100, 95, 90 %
_SAME, _NEGATED, _NEVER_SO = 100, -74, 125
_ROUND = 10_000_000
_UNIT = 100_000_000  # 1e8
_EXCL_UNITS = 29_200_000  # 0.292
_Q_UNITS = 18_000_000  # 0.18
_QMAX_UNITS = 96_000_000  # 0.96


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once (lambdas know no common subexpressions)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Word tokens, apostrophes kept (``don't``), as ``(w, cap)``: lower-cased, and whether written in capitals."""
    return F.transform(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0), lambda t: F.struct(
        F.lower(t).alias("w"), ((t != F.lower(t)) & (t == F.upper(t))).alias("cap")))


def _mixed_case(toks: Column) -> Column:
    """Whether some, but not all, tokens are capitals: only then do capitals stress."""
    return F.exists(toks, lambda t: t["cap"]) & F.exists(toks, lambda t: ~t["cap"])


def _idiom(word: Column, before: list[Column], after: list[Column], idioms: dict[str, float]) -> tuple[Column, Column]:
    """The valence (1e-4 units) of the idiom at a word or NULL, and how many softening pairs stand before it.

    Of the sequences that end at the word or just before it the first known one counts; one that starts at
    the word goes before those.
    """
    w1, w2, w3 = before
    n1, n2 = after

    def value(*places: Column) -> Column:
        """Words are compared one by one: most places fail at the first, and no text is put together."""
        out = F.lit(None).cast("long")
        for k, v in idioms.items():
            words = k.split()
            if len(words) == len(places):
                same = reduce(and_, [p == w for p, w in zip(places, words)])
                out = F.when(same, F.lit(int(round(v * _VAL_SCALE))).cast("long")).otherwise(out)
        return out

    found = F.coalesce(value(word, n1, n2), value(word, n1), value(w1, word), value(w2, w1, word), value(w2, w1), value(w3, w2, w1), value(w3, w2))
    pairs = [w.split() for w in SOFTENING if len(w.split()) == 2]
    soft = lambda x, y: reduce(or_, [(x == p) & (y == q) for p, q in pairs]).cast("int")
    return found, soft(w2, w1) + soft(w3, w2)


def _valence(units: Column, token: Column, before: list[Column], mixed: Column, taken: list[str],
             after: list[Column], known3: Column, next_known: Column, idioms: dict[str, float]) -> Column:
    """A lexicon word's valence in 1e-7 units from its lexicon value (1e-4 units).

    ``before`` are the three tokens before it, nearest first, ``w`` empty
    before the start; ``after`` the two words after it. A word of the lexicon itself (``taken``: those that the rules
    name) neither boosts nor negates. ``known3``: whether the third token before is one; then, and without
    three tokens before, there is no idiom. ``next_known``: whether the next word is one, so that "no" counts there.
    """
    word, cap = token["w"], token["cap"]
    rule = lambda words: [w for w in words if w not in taken]
    w1, w2, w3 = (t["w"] for t in before)
    so1, so2 = w1.isin("so", "this"), w2.isin("so", "this")

    def free(w: Column) -> Column:
        return ~w.isin(taken) if taken else F.lit(True)

    def negated(w: Column) -> Column:
        return F.when((w.isin(rule(NEGATIONS)) | w.endswith("n't")) & free(w), F.lit(_NEGATED)).otherwise(F.lit(_SAME))

    factor = [
        negated(w1),
        F.when((w2 == "never") & free(w2) & so1, F.lit(_NEVER_SO))
        .when((w2 == "without") & free(w2) & (w1 == "doubt"), F.lit(_SAME)).otherwise(negated(w2)),
        F.when((w3 == "never") & free(w3) & (so2 | so1), F.lit(_NEVER_SO))
        .when((w3 == "without") & free(w3) & ((w2 == "doubt") | (w1 == "doubt")), F.lit(_SAME)).otherwise(negated(w3)),
    ]
    least = F.when((w1 == "least") & free(w1) & ~w2.isin("at", "very"), F.lit(_NEGATED)).otherwise(F.lit(_SAME))

    def at(k: int, v: Column) -> Column:
        """The valence after the token ``k`` places before, 100 times finer than ``v``."""
        t, fine = before[k], 100 ** k
        way = F.when(t["w"].isin(rule(INCREASING)), F.lit(1)).when(t["w"].isin(rule(DECREASING)), F.lit(-1))
        step = way * F.when(v < 0, F.lit(-_BOOST[k] * fine)).otherwise(F.lit(_BOOST[k] * fine)).cast("long")
        loud = F.when(way.isNotNull() & t["cap"] & mixed,
                      F.when(v > 0, F.lit(_CAPS[k] * fine)).otherwise(F.lit(-_CAPS[k] * fine)))
        zero = F.lit(0).cast("long")
        return (v + F.coalesce(step, zero) + F.coalesce(loud.cast("long"), zero)) * factor[k]

    no = (w1 == "no") | (w2 == "no") | (w3 == "no") & w1.isin("or", "nor")
    base = F.when((word == "no") & next_known, F.lit(0).cast("long")).otherwise(units)
    base = F.when(no, units * _NEGATED).otherwise(base * 100)
    own = lambda v: F.when(cap & mixed, F.when(v > 0, F.lit(_CAPS[0])).otherwise(F.lit(-_CAPS[0]))).otherwise(F.lit(0))
    idiom, soft = _idiom(word, [w1, w2, w3], after, idioms)
    fine = 100 ** 3  # of the valence after three tokens, in 1e-4 hundredths
    open_ = (w3 != "") & ~known3

    def phrased(v: Column) -> Column:
        """The idiom's valence, if there is one, less the softening pairs."""
        return F.when(open_, F.coalesce(idiom * 100 * fine, v) - soft * (_BOOST[0] * fine)).otherwise(v)

    last = _let(base, lambda v: _let(v + own(v), lambda a: _let(at(0, a), lambda b: _let(at(1, b), lambda c: _let(at(2, c), lambda d: phrased(d) * least)))))
    return _let(last, lambda v: F.call_function("div", v + F.signum(v).cast("long") * (_ROUND // 2), F.lit(_ROUND)))


def _named_by_rules(words) -> list[str]:
    """The words that a rule would read as boosters or negations."""
    named = {*NEGATIONS, *INCREASING, *DECREASING, "least"}
    return sorted(w for w in words if w in named or w.endswith("n't"))


def _emphasis(text: Column) -> Column:
    """Punctuation emphasis of the whole text in sum units."""
    n_excl = F.least(F.length(text) - F.length(F.regexp_replace(text, "!", "")), F.lit(EXCLAMATION_MAX))
    n_q = F.length(text) - F.length(F.regexp_replace(text, r"\?", ""))
    q_amp = (F.when(n_q <= 1, F.lit(0).cast("long")).when(n_q <= 3, n_q.cast("long") * _Q_UNITS)
             .otherwise(F.lit(_QMAX_UNITS)))
    return n_excl.cast("long") * _EXCL_UNITS + q_amp


def _scores(n: Column, s_sum: Column, ps: Column, pcount: Column, ncount: Column, amp: Column) -> Column:
    """The four scores from a text's token count, sum, sum of positives, their counts and the emphasis."""
    pos = ps + pcount.cast("long") * _UNIT
    negabs = -((s_sum - ps) - ncount.cast("long") * _UNIT)
    neu = (n - pcount - ncount).cast("double")
    adj = (F.when(s_sum > 0, s_sum + amp).when(s_sum < 0, s_sum - amp).otherwise(s_sum).cast("double") / float(_UNIT))
    compound = F.least(F.greatest(adj / F.sqrt(adj * adj + F.lit(ALPHA)), F.lit(-1.0)), F.lit(1.0))
    pos_adj = F.when(pos > negabs, pos + amp).otherwise(pos).cast("double") / float(_UNIT)
    neg_adj = F.when(pos < negabs, negabs + amp).otherwise(negabs).cast("double") / float(_UNIT)
    total = pos_adj + neg_adj + neu
    empty = n == 0
    share = lambda x: F.when(empty, 0.0).otherwise(F.round(F.abs(x / total), 3))
    return F.struct(share(pos_adj).alias("positive"), share(neu).alias("neutral"), share(neg_adj).alias("negative"),
                    F.when(empty, 0.0).otherwise(F.round(compound, 4)).alias("compound"))


_KINDS = ("positive", "neutral", "negative", "compound")


def lexicon_map(lexicon: dict[str, float]) -> Column:
    """Lexicon as a map literal of valences in 1e-4 units (lookups scan it, so it stays small)."""
    words = sorted(lexicon)
    units = [int(round(lexicon[w] * _VAL_SCALE)) for w in words]
    return F.map_from_arrays(F.lit(words), F.lit(units).cast("array<long>"))


def _scored(text: str, units, taken: list[str], idioms: dict[str, float]) -> Column:
    """The four scores of a text, NULL for a NULL text; ``units(word)`` is an array of the word's lexicon values (NULL: none).

    Only lexicon words are valued: their places are kept with their values, each meets its neighbours by place, and
    the sums run over them alone, in tenths by the side of the first "but" (before x0.5, after x1.5). Arrays that several
    branches read are bound once, so however Catalyst inlines or pushes the expression (it may push a filter on the score
    below a dedup window), the tokenizer runs once.
    """
    none = F.struct(F.lit("").alias("w"), F.lit(False).alias("cap"))
    zl = F.lit(0).cast("long")

    def scored(toks):
        def near(i, k):
            return F.coalesce(F.get(toks, i + k), none)

        places = F.filter(F.transform(toks, lambda t, i: F.struct(i.alias("i"), units(t["w"]).alias("us"))), lambda h: h["us"].isNotNull())
        hits = F.flatten(F.transform(places, lambda h: F.transform(h["us"], lambda u: F.struct(h["i"].alias("i"), u.alias("u")))))
        spots = F.transform(hits, lambda h: F.struct(
            h["i"].alias("i"), h["u"].alias("u"), near(h["i"], 0).alias("tok"), *[near(h["i"], -k).alias(f"q{k}") for k in (1, 2, 3)],
            *[near(h["i"], k)["w"].alias(f"n{k}") for k in (1, 2)]))
        but = F.array_position(F.transform(toks, lambda t: t["w"]), "but")  # 0: none

        def valued(mixed_but):
            def value(h):
                v = _valence(h["u"], h["tok"], [h["q1"], h["q2"], h["q3"]], mixed_but["mixed"], taken, [h["n1"], h["n2"]],
                             units(h["q3"]["w"]).isNotNull(), units(h["n1"]).isNotNull(), idioms)
                at, place = mixed_but["but"], h["i"] + 1
                tenths = F.when((at > 0) & (place < at), F.lit(5)).when((at > 0) & (place > at), F.lit(15)).otherwise(F.lit(10))
                return v * tenths.cast("long")

            def added(acc, v):
                return F.struct((acc["s"] + v).alias("s"), (acc["ps"] + F.greatest(v, zl)).alias("ps"),
                                (acc["pc"] + (v > 0).cast("int")).alias("pc"), (acc["nc"] + (v < 0).cast("int")).alias("nc"))

            zero = F.struct(zl.alias("s"), zl.alias("ps"), F.lit(0).alias("pc"), F.lit(0).alias("nc"))
            # runs once per row on the final sums; every output is built here, so downstream references never repeat the scoring
            finish = lambda f: _scores(F.size(toks), f["s"], f["ps"], f["pc"], f["nc"], _emphasis(F.col(text)))
            return F.aggregate(F.transform(spots, value), zero, added, finish)

        return _let(F.struct(_mixed_case(toks).alias("mixed"), but.alias("but")), valued)

    return F.when(F.col(text).isNotNull(), _let(tokens(F.col(text)), scored))


def _lexicon_sentiment_fold(df: DataFrame, lexicon: dict[str, float], text: str, prefix: str, idioms: dict[str, float]) -> DataFrame:
    """N2 for small lexicons: ``positive, neutral, negative, compound`` for every row, without a shuffle."""
    words, lex = sorted(lexicon), lexicon_map(lexicon)
    units = lambda w: F.when(w.isin(words), F.array(F.try_element_at(lex, w)))
    out = df.withColumn("_score", _scored(text, units, _named_by_rules(lexicon), idioms))
    return out.withColumns({prefix + k: F.col("_score")[k] for k in _KINDS}).drop("_score")


def lexicon_sentiment(df: DataFrame, lexicon: dict[str, float] | DataFrame, text: str = "text",
                      prefix: str = "", method: str = "auto", idioms: dict[str, float] = IDIOMS) -> DataFrame:
    """``positive, neutral, negative, compound`` for every row; a NULL text has NULL scores.

    ``method='fold'`` scores each row with one array fold and a map-literal
    lexicon (no shuffle; for small lexicons, since map-literal lookups scan
    linearly). ``'join'`` explodes the distinct words of each text, joins the lexicon as a table
    (any size; AQE broadcasts it when its measured size allows) and folds each row with the
    entries that its text uses. ``'auto'`` picks by lexicon size. Both give identical results.
    """
    if method == "auto":
        n = len(lexicon) if isinstance(lexicon, dict) else lexicon.count()
        method = "fold" if n <= MAX_INLINE_LEXICON else "join"
    if method == "fold":
        if not isinstance(lexicon, dict):
            rows = lexicon.limit(MAX_INLINE_LEXICON + 1).collect()
            if len(rows) > MAX_INLINE_LEXICON:
                raise ValueError(f"lexicon has over {MAX_INLINE_LEXICON} entries, the most that can be inlined")
            lexicon = {r[0]: float(r[1]) for r in rows}
        return _lexicon_sentiment_fold(df, lexicon, text, prefix, idioms)
    return _lexicon_sentiment_join(df, lexicon, text, prefix, idioms)


def _lexicon_sentiment_join(df: DataFrame, lexicon: dict[str, float] | DataFrame, text: str, prefix: str, idioms: dict[str, float]) -> DataFrame:
    spark = df.sparkSession
    if isinstance(lexicon, dict):
        lex = spark.createDataFrame([(w, float(v)) for w, v in lexicon.items()], "word string, valence double")
    else:
        lex = lexicon.toDF("word", "valence")
    lex = lex.select("word", F.round(F.col("valence") * _VAL_SCALE).cast("long").alias("vu"))
    # as many rows as the rules name words
    named = lex.where(F.col("word").isin(NEGATIONS + INCREASING + DECREASING + ["least"]) | F.col("word").endswith("n't"))
    taken = _named_by_rules(r[0] for r in named.select("word").distinct().collect())

    # a text's own part of the lexicon goes back to every row with that text, by a 256-bit digest
    df = df.withColumn("_k", F.unhex(F.sha2(F.col(text), 256)))
    words = df.select("_k", F.explode(F.array_distinct(F.transform(tokens(F.col(text)), lambda t: t["w"]))).alias("word"))
    lex = lex.groupBy("word").agg(F.collect_list("vu").alias("us"))
    mine = words.join(lex, "word").groupBy("_k").agg(F.map_from_entries(F.collect_set(F.struct("word", "us"))).alias("_lex"))
    per = df.join(mine, "_k", "left")
    out = per.withColumn("_score", _scored(text, lambda w: F.try_element_at("_lex", w), taken, idioms))
    out = out.withColumns({prefix + k: F.col("_score")[k] for k in _KINDS})
    return out.drop("_k", "_lex", "_score")


def context_of(parsed: Column, keep: tuple[str, ...] = ("nsubj", "dobj", "pobj", "ROOT")) -> Column:
    """N1 for posts that carry their parse as an array of ``(token, dep)``: no shuffle; NULL gives NULL."""
    return F.array_join(F.transform(F.filter(parsed, lambda t: t["dep"].isin(list(keep))), lambda t: t["token"]), " ")


def context_filter(tokens_df: DataFrame, keep: tuple[str, ...] = ("nsubj", "dobj", "pobj", "ROOT"),
                   docs: DataFrame | None = None, doc_col: str = "doc_id") -> DataFrame:
    """Keep tokens whose dependency label is in ``keep``, rejoined in order.

    ``tokens_df`` is ``(doc_id, pos, token, dep)`` from any parser. The group
    is a per-document token list, bounded by the document's own length. Docs
    of ``docs`` with no kept token get ``''``.
    """
    ctx = (tokens_df.where(F.col("dep").isin(list(keep)))
           .groupBy(doc_col)
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))),
                                         lambda s: s["token"]), " ").alias("context")))
    if docs is None:
        return ctx
    return (docs.select(doc_col).join(ctx, doc_col, "left")
            .withColumn("context", F.coalesce("context", F.lit(""))))


def party_label(df: DataFrame, compound: str = "compound", about: str = "tweet_about",
                neutral_band: float = 0.05, side_a: str = "biden", side_b: str = "trump",
                out: str = "likely_party") -> DataFrame:
    """0 unsure, 1 side-A camp, 2 side-B camp.

    |compound| < band -> 0; about side A: positive -> 1 else 2; about side B:
    positive -> 2 else 1; anything else stays 0. Bounds are strict.
    """
    c = F.col(compound)
    label = (F.when((c < neutral_band) & (c > -neutral_band), F.lit(0))
             .when(F.col(about) == side_a, F.when(c > 0, F.lit(1)).otherwise(F.lit(2)))
             .when(F.col(about) == side_b, F.when(c > 0, F.lit(2)).otherwise(F.lit(1)))
             .otherwise(F.lit(0)))
    return df.withColumn(out, label)


def party_label_fallback(df: DataFrame, context_compound: str, full_compound: str,
                         about: str = "tweet_about", neutral_band: float = 0.05,
                         side_a: str = "biden", side_b: str = "trump",
                         out: str = "likely_party") -> DataFrame:
    """When 0 <= context score < band, use the full-text score instead;
    then 0 -> unsure, otherwise the sign decides (-band..0 counts negative)."""
    c = F.when((F.col(context_compound) >= 0) & (F.col(context_compound) < neutral_band),
               F.col(full_compound)).otherwise(F.col(context_compound))
    label = (F.when(c == 0, F.lit(0))
             .when(F.col(about) == side_a, F.when(c > 0, F.lit(1)).otherwise(F.lit(2)))
             .when(F.col(about) == side_b, F.when(c > 0, F.lit(2)).otherwise(F.lit(1)))
             .otherwise(F.lit(0)))
    return df.withColumn(out, label)


def class_summary(df: DataFrame, label: str = "likely_party", compound: str = "compound") -> DataFrame:
    """Class counts, their percentages, and the share with compound = 0."""
    n = F.count(F.lit(1))
    return df.agg(
        F.count_if(F.col(label) == 0).alias("n_unsure"),
        F.count_if(F.col(label) == 1).alias("n_dem"),
        F.count_if(F.col(label) == 2).alias("n_rep"),
        n.alias("n_total"),
        F.round(F.try_divide(F.count_if(F.col(label) == 0) * 100.0, n), 6).alias("pct_unsure"),
        F.round(F.try_divide(F.count_if(F.col(label) == 1) * 100.0, n), 6).alias("pct_dem"),
        F.round(F.try_divide(F.count_if(F.col(label) == 2) * 100.0, n), 6).alias("pct_rep"),
        F.round(F.try_divide(F.count_if(F.col(compound) == 0) * 1.0, n), 6).alias("frac_zero_compound"),
    )


def positive_posts(df: DataFrame, compound: str = "compound", threshold: float = 0.05) -> DataFrame:
    """Compound above the threshold."""
    return df.where(F.col(compound) > threshold)


def negative_posts(df: DataFrame, compound: str = "compound") -> DataFrame:
    """Compound below zero."""
    return df.where(F.col(compound) < 0)


def score_kinds(df: DataFrame, compound: str = "compound", threshold: float = 0.05, out: str = "kind") -> DataFrame:
    """N6, both filters in one pass: rows that meet one, marked ``positive`` or ``negative``."""
    c = F.col(compound)
    return df.withColumn(out, F.when(c > threshold, "positive").when(c < 0, "negative")).where(F.col(out).isNotNull())


def random_sample(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """Exactly ``n`` random rows (top-k on a random key; no full sort)."""
    return df.orderBy(F.rand(seed)).limit(n)


def seeded_sample_per_class(df: DataFrame, n: int, seed: int = 42, label: str = "likely_party",
                            key: str = "doc_id") -> DataFrame:
    """Deterministic ``n`` rows per class, ranked by md5(seed || key).

    ``row_number() <= n`` is planned with a map-side group limit, so a huge
    class never reaches one task whole.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    w = Window.partitionBy(label).orderBy(h, F.col(key))
    return df.withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)


def sample_listing(df: DataFrame, text: str = "tweet", rank: str = "sample_rank",
                   width: int = 1000) -> DataFrame:
    """``"{i}. {text}"`` right-padded to ``width`` without truncating."""
    padded = F.concat(F.col(text), F.repeat(F.lit(" "), F.greatest(F.lit(0), F.lit(width) - F.length(text))))
    return df.withColumn("listing", F.concat(F.col(rank).cast("string"), F.lit(". "), padded))
