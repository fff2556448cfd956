"""Toxicity by maximum-scoring segments.

* Each word (and, for words too rare to judge, its first letters) has a log-odds
  of toxic against clean with an informative Dirichlet prior, the pooled
  frequencies; it counts only as far as it exceeds its standard error. A word
  counts once a document, and texts that share their smallest shingle hash
  (copies) count once.
* A text is the sequence of these scores less a small drift, so clean text
  falls. A linear-time scan finds all maximal-scoring segments.
* Karlin-Altschul extreme-value statistics of clean text turn a segment's score
  S in a text of n words into an expected count E = K n exp(-lambda S). The
  significant segments' -ln E are added up, and a logistic curve fitted to the
  learning rows turns the sum (its logarithm) into a probability. Without a significant segment the
  probability stays under one half and falls with the best segment's E.

Learning uses at most about ``sample`` labelled documents of each class, chosen
by a 62-bit hash of the id, read whole; what is broadcast is bounded by that sample.

Defined results: null or wordless text has no segment and gets score 0; without learning rows of both classes every score is 0; several labels
for one id count as their maximum; repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import Scratch, crc_mod, map_text, sample_cut, sample_hash, table
from opinion_spark.llm.near import shingle_set

SAMPLE = 3000
#: Prior strength as a share of all counts; standard errors taken off; loss for each word; least log-odds that count as toxic;
#: least root of the likelihood ratio at which a word's odds count at all.
PRIOR, ERRORS, DRIFT, DOUBLED, LEAST_Z = 0.1, 1.0, 0.1, math.log(2), 4.0
#: A beginning counts if no single word makes up this share of it.
ONE_WORD = 0.8
#: Highest score of a text without a significant segment: it is never predicted toxic.
NO_EVIDENCE = 0.49
#: Lengths of the word beginnings that stand in for rare words; least documents to judge a word or beginning.
BEGINNINGS, LEAST = (6, 5, 4), 5
WORDS = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    """scores: word, or beginning + '*', to score; lam, log_k: extreme-value fit; a, b: logistic curve."""

    scores: dict
    lam: float = 1.0
    log_k: float = 0.0
    a: float = 0.0
    b: float = 0.0


def keys_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in BEGINNINGS if len(word) > k)]


def word_score(word: str, scores: dict) -> float:
    """The most specific score known: the word's own, else its longest judged beginning's."""
    return next((scores[k] for k in keys_of(word) if k in scores), 0.0)


def maximal_segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, end, score) in linear time.

    A stack of disjoint candidates with the running sums before and after
    them; each knows the nearest candidate to its left that begins lower, so
    looking back skips what cannot be joined.
    """
    start, end, left, right, lower = [], [], [], [], []
    total = 0.0
    for i, x in enumerate(scores):
        before, total = total, total + x
        if x <= 0:
            continue
        s, lo, e, hi = i, before, i + 1, total
        while True:
            j = len(start) - 1
            while j >= 0 and left[j] >= lo:
                j = lower[j]
            if j < 0 or right[j] >= hi:
                break
            s, lo = start[j], left[j]
            for stack in (start, end, left, right, lower):
                del stack[j:]
        for stack, v in zip((start, end, left, right, lower), (s, e, lo, hi, j)):
            stack.append(v)
    return [(a, b, r - x) for a, b, x, r in zip(start, end, left, right)]


def _scored_words(text: str | None, scores: dict, memo: dict) -> list[float]:
    out = []
    for w in WORDS.findall((text or "").lower()):
        if (s := memo.get(w)) is None:
            if len(memo) > 200_000:
                memo.clear()
            s = memo[w] = word_score(w, scores) - DRIFT
        out.append(s)
    return out


def evidence(n: int, segments: list, m: Model) -> tuple[float, list]:
    """Sum of -ln E over the significant segments (E below one half), and these segments."""
    total, kept = 0.0, []
    for a, b, s in segments:
        surprise = m.lam * s - m.log_k - math.log(max(n, 1))
        if surprise > math.log(2):
            total += surprise
            kept.append((a, b, surprise))
    return total, kept


def doubt(n: int, segments: list, m: Model) -> float:
    """1 / (2 E) of the best segment, none of them significant: from 0 (no segment at all) to 1."""
    best = max((x for _, _, x in segments), default=None)
    return 0.0 if best is None else min(1.0, math.exp(min(0.0, m.lam * best - m.log_k - math.log(max(n, 1)) - math.log(2))))


def _smallest(batches: Iterator) -> Iterator:
    for b in batches:
        sets = [shingle_set(x) for x in b.text]
        b["least"] = [int(x[0] >> 1) if len(x) else -1 for x in sets]
        yield b


def _count(batches: Iterator) -> Iterator:
    from collections import Counter

    import pandas as pd

    seen = {0: Counter(), 1: Counter()}
    for b in batches:
        for toxic, text in zip(b.toxic, b.text):
            seen[int(toxic)].update({k for w in set(WORDS.findall((text or "").lower())) for k in keys_of(w)})
    for toxic, c in seen.items():
        if c:
            yield pd.DataFrame({"toxic": toxic, "word": list(c), "n": list(c.values())})


def _evidence_of(shared):
    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        m, memo = Model(**shared.value), {}
        for b in batches:
            rows = []
            for toxic, text in zip(b.toxic, b.text):
                s = _scored_words(text, m.scores, memo)
                seg = maximal_segments(s)
                rows.append((int(toxic), len(s), max([x[2] for x in seg], default=0.0), [x[2] for x in seg]))
            yield pd.DataFrame(rows, columns=["toxic", "n", "top", "segments"])

    return run


def _logistic(x, y, w) -> tuple[float, float]:
    """Weighted logistic curve with softened targets (so separable data have a finite fit)."""
    import numpy as np

    pos, neg = w[y == 1].sum(), w[y == 0].sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    scale = max(x.max(), 1e-9)
    z, a, b = x / scale, 0.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a + b * z, -30, 30)))
        h = w * np.maximum(p * (1 - p), 1e-9)
        g = w * (t - p)
        m = np.array([[h.sum(), (h * z).sum()], [(h * z).sum(), (h * z * z).sum() + 1e-3]])
        da, db = np.linalg.solve(m, [g.sum(), (g * z).sum() - 1e-3 * b])
        step = min(1.0, 5 / max(abs(da), abs(db), 1e-9))
        a, b = a + step * da, b + step * db
        if max(abs(da), abs(db)) < 1e-6:
            break
    return float(a), float(b / scale)


def learn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on the rows of ``docs`` that ``labels`` marks 0 or 1."""
    import numpy as np

    spark = docs.sparkSession
    marks = (labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("toxic")).where("toxic in (0, 1) and key is not null")
             .groupBy("key").agg(F.max("toxic").alias("toxic")))
    sizes = {r[0]: r[1] for r in marks.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model({}, a=-math.inf)
    rate = {c: min(1.0, sample / n) for c, n in sizes.items()}
    cut = F.when(F.col("toxic") == 1, sample_cut(sample, sizes[1])).otherwise(sample_cut(sample, sizes[0]))
    few = marks.where(sample_hash("key") < cut)  # about 2 * sample rows: broadcast
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(few), "key").select("toxic", "text")
    rows = rows.mapInPandas(_smallest, "toxic int, text string, least long").dropDuplicates(["toxic", "least"]).select("toxic", "text")
    s = Scratch(spark, "toxicity")
    rows = s.written(rows, "sample")  # the sample's texts, read twice more
    found = (rows.mapInPandas(_count, "toxic int, word string, n long").groupBy("word")
             .agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("y1"),
                  F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("y0"))
             .withColumn("all", F.col("y1") + F.col("y0")))
    whole = ~F.col("word").endswith("*")
    n1, n0 = found.where(whole).agg(F.sum("y1"), F.sum("y0")).first()
    if not n1 or not n0:
        return Model({}, a=-math.inf)
    t = found.where(F.col("all") >= LEAST).toPandas()
    strength = PRIOR * (n1 + n0)
    prior = strength * t["all"].to_numpy() / (n1 + n0)
    y1, y0 = t.y1.to_numpy() + prior, t.y0.to_numpy() + prior
    odds = np.log(y1 / (n1 + strength - y1)) - np.log(y0 / (n0 + strength - y0))
    scores = np.sign(odds) * np.maximum(0.0, np.abs(odds) - ERRORS * np.sqrt(1 / y1 + 1 / y0))
    seen1, seen0 = t.y1.to_numpy(dtype=float), t.y0.to_numpy(dtype=float)
    rest = seen1 + seen0
    ratio = 2 * (seen1 * np.log(np.maximum(seen1, 1e-9) * (n1 + n0) / (rest * n1)) + seen0 * np.log(np.maximum(seen0, 1e-9) * (n1 + n0) / (rest * n0)))
    # a beginning that is nearly always one and the same word says nothing of other words
    main: dict = {}
    for w, y in zip(t.word, seen1):
        if not w.endswith("*"):
            for k in keys_of(w)[1:]:
                main[k] = max(main.get(k, 0.0), y)
    alone = np.array([main.get(w, 0.0) > ONE_WORD * y for w, y in zip(t.word, seen1)], dtype=bool)
    scores = np.where((ratio >= LEAST_Z ** 2) & ~alone, scores, 0.0)
    scores = np.where((scores > 0) & (scores < DOUBLED), 0.0, scores)
    m = Model({w: float(x) for w, x in zip(t.word, scores)})

    seen = rows.mapInPandas(_evidence_of(spark.sparkContext.broadcast(vars(m))), "toxic int, n int, top double, segments array<double>").toPandas()
    s.drop("sample", collect=False)
    clean = seen[seen.toxic == 0]
    # lambda: a clean word's score has E[exp(lambda s)] = 1; one more word of the top score keeps it finite
    s0 = {w: x - DRIFT for w, x in m.scores.items() if x > 0 and not w.endswith("*")}
    y = dict(zip(t.word, t.y0))
    values = np.array([*s0.values(), max(s0.values(), default=1.0), -DRIFT])
    mass = np.array([*(y[w] for w in s0), 1.0, 0.0], dtype=float)
    mass[-1] = max(n0 - mass.sum(), 1.0)
    mass /= mass.sum()
    lo, hi = 1e-6, 50.0
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if (mass * np.exp(mid * values)).sum() > 1 else (mid, hi)
    m.lam = lo
    if len(clean):
        m.log_k = float((m.lam * clean.top - np.log(np.maximum(clean.n, 1))).mean() - 0.5772156649)
    x = np.array([math.log1p(evidence(n, [(0, 0, x) for x in seg], m)[0]) for n, seg in zip(seen.n, seen.segments)])
    label_of = seen.toxic.to_numpy()
    m.a, m.b = _logistic(x, label_of, np.where(label_of == 1, 1 / rate[1], 1 / rate[0]))
    return m


def _scorer(shared):
    def make():
        m, memo = Model(**shared.value), {}

        def of(text):
            s = _scored_words(text, m.scores, memo)
            segments = maximal_segments(s)
            total, kept = evidence(len(s), segments, m)
            spans = []
            if kept:
                at = [x.span() for x in WORDS.finditer(text.lower())]
                spans = [{"start": at[i][0], "end": at[j - 1][1], "surprise": v} for i, j, v in kept]
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, m.a + m.b * math.log1p(total))))) if math.isfinite(m.a) else 0.0
            if not total:  # lower the more such segments clean texts of that length have by chance
                p = min(p, NO_EVIDENCE) * doubt(len(s), segments, m)
            return p, int(p >= 0.5), spans

        return of

    return make


def score(docs: DataFrame, model: Model, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with ``score, predicted`` and the toxic ``passages`` (character spans of the lower-cased text)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    return map_text(docs, keep, F.col(text), _scorer(shared), "score double, predicted int, passages array<struct<start: int, end: int, surprise: double>>")


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 5) == 0


def learn_from(docs: DataFrame, labels: DataFrame) -> Model:
    """The model that may only see labels outside the held-out fold."""
    return learn(docs, labels.where(~held_out()))


def query(spark, sf_dir):
    """op3: the toxicity of every document."""
    docs = table(spark, sf_dir, "documents")
    model = learn_from(docs, table(spark, sf_dir, "labels"))
    return score(docs.withColumn("held_out", held_out()), model, ["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted", "passages")
