"""Hashtag segmentation.

``#TrumpIsOrange`` -> ``Trump Is Orange``: each distinct tag body is split
into the sequence of words with the least total cost under a unigram model
where the word of frequency rank i (0-based) of N costs ln((i+1) ln N).

Distinct letter runs of tags are segmented once each. A table of word beginnings tells, for
each place of a run, how long a word that starts there can be; only the substrings up to that
length are joined with the cost table. The dynamic programme runs as an
``aggregate()`` fold over the run's positions (the candidates of each end
beside it). Texts are rebuilt inside their rows, from a map of the text's own tags that is
attached by a digest of the text, so ids play no part and copies of a text are
split once. A tag without letters or digits stays as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.tables import Scratch, attach, ranked

WORD = r"[\p{L}\p{N}']+"
TAG = r"#[\p{L}\p{N}_]+"
RUNS = r"#[\p{L}\p{N}_]+|[^#]+|#"
PART = r"\p{L}+|[^\p{L}_]+"  # letter and digit runs of a tag body
UNITS = 1_000_000  # costs are summed as whole millionths
STEPS = (4, 6, 8, 11, 15, 20, 30, 50, 100)  # lengths at which beginnings of words are looked up


def word_costs(words: DataFrame, word: str = "word", count: str = "count") -> DataFrame:
    """``(word, cost)`` from a frequency table (most frequent first, then by word)."""
    s = Scratch(words.sparkSession, "costs")
    places = ranked(words.select(F.col(word), F.col(count).alias("_c")), [F.col("_c").desc(), F.col(word).asc()], "_rank", s)
    total = places.count()
    return places.select(word, F.log((F.col("_rank") + 1.0) * F.log(F.lit(float(total)))).alias("cost"))


def corpus_word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Word frequencies of a corpus (lower-cased), for ``word_costs``."""
    return (docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0)).alias("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def ranked_word_list(lines: DataFrame) -> DataFrame:
    """S7 -> C16 input: a one-word-per-line list, most frequent first."""
    w = lines.select(F.trim("value").alias("word"), F.monotonically_increasing_id().alias("_o"))
    w = w.where(F.length("word") > 0)
    return w.select("word", (-F.col("_o")).alias("count"))


def beginnings(costs: DataFrame) -> DataFrame:
    """``(start, n)``: the beginnings of all words at the lengths of ``STEPS`` (a word's own ones only)."""
    at = F.filter(F.array(*[F.lit(n) for n in STEPS]), lambda n: n <= F.length("word"))
    each = costs.select("word", F.explode(at).alias("n"))
    return each.select(F.expr("substring(word, 1, n)").alias("start"), "n").distinct()


def candidates(runs: DataFrame, costs: DataFrame, max_word: int) -> DataFrame:
    """``(part, end, len, word)`` of the substrings of ``part, low, n`` that may be words, and of all single characters.

    A place whose first STEPS[i] characters begin a word, but whose first STEPS[i + 1] do not, starts no word
    of STEPS[i + 1] characters or more. Beginnings of beginnings are beginnings, so the longest match tells all.
    """
    places = runs.select("part", "low", F.col("n").alias("size"), F.explode(F.sequence(F.lit(1), "n")).alias("from"))
    left = F.col("size") - F.col("from") + 1
    tried = places.select("*", F.explode_outer(F.filter(F.array(*[F.lit(n) for n in STEPS]), lambda n: n <= left)).alias("n"))
    # places too near the end look up nothing; they keep their run as key, so they do not all meet in one task
    tried = tried.withColumn("start", F.coalesce(F.expr("substring(low, from, n)"), F.col("part"))).fillna(0, ["n"])
    known = tried.join(beginnings(costs).withColumn("known", F.lit(True)), ["start", "n"], "left")
    longest = known.groupBy("part", "low", "size", "from").agg(F.max(F.when(F.col("known"), F.col("n"))).alias("found"))
    upper = [*STEPS[1:], 1 << 30]
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in zip(STEPS, upper) for x in pair]), F.col("found")) - 1
    reach = F.greatest(F.lit(1), F.least(left, F.coalesce(limit, F.lit(STEPS[0] - 1)), F.lit(max_word)))
    each = longest.select("part", "low", "from", F.explode(F.sequence(F.lit(1), reach)).alias("len"))
    return each.select("part", (F.col("from") + F.col("len") - 1).alias("end"), "len", F.expr("substring(low, from, len)").alias("word"))


def segment_tags(tags: DataFrame, costs: DataFrame, max_word: int | None = None, tag: str = "tag") -> DataFrame:
    """C17: ``(tag, words, unknown, cost)`` for every distinct tag body.

    A tag is cut at ``_`` and between letters and digits; a digit run is one
    word and costs nothing. Each distinct letter run gets the words with the
    fewest ``unknown`` characters, then the least cost (in millionths, so sums
    are exact), then the shorter last word; an unknown character is a word of
    its own. Only known words and single characters become candidates.
    """
    if max_word is None:
        max_word = costs.agg(F.max(F.length("word"))).first()[0] or 1  # one number
    parts = (tags.select(F.col(tag).alias("tag")).where(F.length("tag") > 0).distinct()
             .select("tag", F.posexplode(F.regexp_extract_all("tag", F.lit(PART), 0)).alias("i", "part"))
             .withColumn("letters", F.col("part").rlike(r"^\p{L}")))
    runs = parts.where("letters").select("part").distinct().withColumn("n", F.length("part"))
    low = F.lower("part")  # of equal length but for a few characters, which then stay as they are
    runs = runs.withColumn("low", F.when(F.length(low) == F.col("n"), low).otherwise(F.col("part")))
    cand = candidates(runs, costs, max_word)
    known = costs.select("word", F.round(F.col("cost") * UNITS).cast("long").alias("cost"))
    cand = cand.join(known, "word", "left").where(F.col("cost").isNotNull() | (F.col("len") == 1))
    option = F.struct(F.col("cost").isNull().cast("int").alias("unknown"), F.coalesce("cost", F.lit(0)).alias("cost"), "len")
    steps = cand.groupBy("part", "end").agg(F.collect_list(option).alias("options"))
    per = steps.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("end", "options"))).alias("steps"))

    def step(best, now):
        def total(o):
            before = F.element_at(best, now["end"] - o["len"] + 1)
            return F.struct((before["unknown"] + o["unknown"]).alias("unknown"),
                            (before["cost"] + o["cost"]).alias("cost"), o["len"].alias("len"))
        return F.concat(best, F.array(F.array_min(F.transform(now["options"], total))))

    def back(acc, _):
        size = F.element_at("best", acc["pos"] + 1)["len"]
        word = F.substring("part", acc["pos"] - size + 1, size)
        return F.when(acc["pos"] > 0, F.struct((acc["pos"] - size).alias("pos"),
                                               F.concat(F.array(word), acc["words"]).alias("words"))).otherwise(acc)

    zero = F.array(F.struct(F.lit(0).alias("unknown"), F.lit(0).cast("long").alias("cost"), F.lit(0).alias("len")))
    per = per.withColumn("best", F.aggregate("steps", zero, step))
    start = F.struct(F.size("steps").alias("pos"), F.array().cast("array<string>").alias("words"))
    last = F.element_at("best", -1)
    found = per.select("part", F.aggregate("steps", start, back)["words"].alias("found"),
                       last["unknown"].alias("unknown"), last["cost"].alias("cost"))
    each = parts.join(found, "part", "left").select(
        "tag", "unknown", "cost", F.struct("i", F.coalesce("found", F.array("part")).alias("words")).alias("p"))
    words = F.flatten(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["words"]))
    return each.groupBy("tag").agg(words.alias("words"), F.coalesce(F.sum("unknown"), F.lit(0)).alias("unknown"),
                                   (F.coalesce(F.sum("cost"), F.lit(0)) / UNITS).alias("cost"))


def replace_hashtags(docs: DataFrame, costs: DataFrame, text: str = "text", max_word: int | None = None) -> DataFrame:
    """C14 + C18: every ``#tag`` replaced by its words joined by spaces.

    A text's result depends on the text alone: the segmentations of its tags go back to every
    row with that text as a map, by a 256-bit digest of the text, and the row puts its own runs together again.
    Rows with repeated or null ids and repeated texts are rows like all others. Texts without ``#`` skip all of it.
    """
    s = Scratch(docs.sparkSession, "hashtags")
    digest = F.unhex(F.sha2(F.col(text).cast("binary"), 256))
    has = docs.where(F.col(text).contains("#")).withColumn("_digest", digest)
    rest = docs.where(~F.col(text).contains("#") | F.col(text).isNull())
    tags = has.select("_digest", F.explode(F.array_distinct(F.regexp_extract_all(text, F.lit(TAG), 0))).alias("run"))
    tags = s.written(tags.groupBy("_digest", "run").agg(F.count(F.lit(1)).alias("rows")).withColumn("tag", F.expr("substring(run, 2)")), "tags")
    seg = segment_tags(tags, costs, max_word).select("tag", F.array_join("words", " ").alias("seg"))
    seg = s.written(seg.join(tags.groupBy("tag").agg(F.count(F.lit(1)).alias("texts")), "tag"), "segments")
    entry = F.struct("run", "seg")
    maps = attach(tags, seg, ["tag"], "texts").groupBy("_digest").agg(F.map_from_entries(F.collect_list(entry)).alias("_map"), F.max("rows").alias("_rows"))
    out = attach(has, s.written(maps, "maps"), ["_digest"], "_rows", "left")
    runs = F.regexp_extract_all(text, F.lit(RUNS), 0)
    new = F.array_join(F.transform(runs, lambda run: F.coalesce(F.try_element_at("_map", run), run)), "")
    out = out.withColumn(text, new).select(*docs.columns)
    return out.unionByName(rest)
