"""Language ID by multilingual mixture inference.

A text is a mixture of languages: every letter trigram is drawn from one of
them. Expectation-maximisation estimates the proportions from the trigram
likelihoods. The language set grows one language at a time, by the largest
likelihood gradient, while twice the gain in log-likelihood exceeds the
penalty of one more proportion (BIC, on the number of independent trigrams).

Trigram counts are learned from a sample of labelled rows of at most about
``sample`` documents for each language, chosen by a 62-bit hash of id and text
(so ``sample`` of any number of rows; equal rows count once); trigrams
are hashed to ``BUCKETS`` so the broadcast model has BUCKETS floats a language.
Labels are a closed set: the model is as large as that set.

Defined results: null text and text without a letter get ``und``, score 0 and
no proportions; with nothing to learn from, every text does; a null language
label teaches nothing; repeated rows get equal results. Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import crc_mod, map_text, sample_cut, sample_hash, table

BUCKETS, SAMPLE = 1 << 16, 1000
UNKNOWN = "und"
NOT_LETTERS = re.compile(r"[\W\d_]+")


def trigrams(text: str | None):
    """Bucket numbers of a text's letter trigrams, or None without a letter."""
    import numpy as np

    letters = NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    if not letters or not any(c.isalpha() for c in set(letters)):
        return None
    x = np.frombuffer(f" {letters} ".encode("utf-32-le", "surrogatepass"), "<u4")
    return ((x[:-2] * np.uint32(0x9E3779B1)) ^ (x[1:-1] * np.uint32(0x85EBCA77)) ^ (x[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(16)


def proportions(counts, prob, penalty: float = 1.0, rounds: int = 40):
    """Languages (columns of ``prob``) and their shares for n-gram ``counts`` (rows of ``prob``)."""
    import numpy as np

    n = counts.sum()
    alone = counts @ np.log(prob)
    chosen, share = [int(alone.argmax())], np.ones(1)
    best, density = alone.max(), prob[:, chosen[0]]
    while len(chosen) < prob.shape[1]:
        gain = counts @ (prob / density[:, None])
        gain[chosen] = -1
        new = int(gain.argmax())
        if gain[new] <= n:
            break
        p, w = prob[:, [*chosen, new]], np.append(share * 0.9, 0.1)
        for _ in range(rounds):
            m = p @ w
            step = w * (p.T @ (counts / m)) / n
            done, w = np.abs(step - w).max() < 1e-3, step
            if done:
                break
        m = p @ w
        now = counts @ np.log(m)
        # neighbouring trigrams overlap, so a third of them and of the gain is independent
        if 2 * (now - best) / 3 <= penalty * np.log(max(n / 3, 2)):
            break
        chosen, share, best, density = [*chosen, new], w, now, m
    return chosen, share


def _count(batches: Iterator) -> Iterator:
    import numpy as np
    import pandas as pd

    total: dict = {}
    for b in batches:
        for lang, text in zip(b.lang, b.text):
            if (g := trigrams(text)) is not None:
                total[lang] = total.get(lang, 0) + np.bincount(g, minlength=BUCKETS)
    for lang, c in total.items():
        at = c.nonzero()[0]
        yield pd.DataFrame({"lang": lang, "bucket": at.astype("int32"), "n": c[at].astype("int64")})


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE):
    """Languages and their smoothed trigram probabilities (buckets by languages)."""
    import numpy as np

    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where("lang is not null")
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return [], np.zeros((BUCKETS, 0), "float32")
    cut = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(sample_cut(sample, sizes[k])))])
    # rows equal in id and text have one hash and count once, so copies cannot swell the sample
    picked = (rows.withColumn("hash", sample_hash("key", "text")).where(F.col("hash") < F.element_at(cut, F.col("lang")))
              .dropDuplicates(["lang", "hash"]))
    found = (picked.select("lang", "text").mapInPandas(_count, "lang string, bucket int, n long")
             .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros((BUCKETS, len(langs)))
    for j, k in enumerate(langs):
        own = found[found.lang == k]
        counts[own.bucket.to_numpy(), j] = own.n.to_numpy()
    prob = (counts + 0.1) / (counts.sum(axis=0) + 0.1 * BUCKETS)
    return langs, prob.astype("float32")


def _predictor(shared):
    def make():
        import numpy as np

        langs, prob = shared.value

        def of(text):
            g = trigrams(text) if langs else None
            if g is None:
                return UNKNOWN, 0.0, [], []
            at, c = np.unique(g, return_counts=True)
            chosen, share = proportions(c.astype("float64"), prob[at].astype("float64"))
            order = np.argsort(-share, kind="stable")
            return langs[chosen[order[0]]], float(min(1.0, share[order[0]])), [langs[chosen[i]] for i in order], share[order].tolist()

        return of

    return make


def identify(docs: DataFrame, model: tuple, keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row with ``lang_pred, score, langs, shares`` (by falling share)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_text(docs, keep, F.col(text), _predictor(shared), "lang_pred string, score double, langs array<string>, shares array<double>")


def held_out(key: str = "doc_id") -> Column:
    return crc_mod(key, 3) == 1


def learn_from(docs: DataFrame):
    """The model that may only see rows outside the held-out fold."""
    return learn(docs.where(~held_out()))


def query(spark, sf_dir):
    """op1: the language of every document."""
    docs = table(spark, sf_dir, "documents")
    out = identify(docs.withColumn("held_out", held_out()), learn_from(docs), ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score", "langs", "shares")
