"""Plain Python versions of the operators, and a fixture table with awkward rows."""

import hashlib
import re
from collections import defaultdict

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BIG = (1 << 60) + 1
LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(20000))

#: nulls, empty and long texts, ties, repeated rows, an id beyond 2**53
DOCS = [
    (BIG, "the cat sat on the mat today", "en", "a", 1),
    (2, None, None, None, None),
    (3, "", None, "b", 0),
    (None, "the cat sat on the mat today", "en", "a", 1),
    (4, "the cat sat on the mat today", "en", "a", 1),
    (4, "the cat sat on the mat today", "en", "a", 1),
    (5, LONG, "en", "c", 9),
    (6, LONG + " x", "en", "c", 9),
    (7, "123 !!! \t\n", "de", "b", 3),
    (8, "uno dos tres <|endoftext|> cu\u00e1tro", "es", "z", 3),
    (9, "x" * 30000, "en", "c", 1),
]


def docs(spark, rows=None):
    """The fixture with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F

    out = spark.createDataFrame(DOCS if rows is None else rows, DOC_SCHEMA)
    for name in ("score", "size", "_key", "target", "predicted", "kept", "rank", "comp", "shard", "id", "key"):
        out = out.withColumn(name, F.lit("clash"))
    return out


def rows(df):
    return [tuple(r) for r in df.collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, lower=True):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "") if lower else text or ""
    w = words(low)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(texts, percent=85):
    """Smallest reachable id by comparing all pairs; texts: {id: text}."""
    sets = {i: shingles(t) for i, t in texts.items()}
    comp = {i: i for i in texts}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(texts)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {i: root(i) for i in ids}


def sainte_lague(votes, seats, most=None):
    got = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i in range(len(votes)) if votes[i] > 0 and (most is None or got[i] < most[i])]
        if not open_:
            break
        got[max(open_, key=lambda i: (votes[i] / (2 * got[i] + 1), -i))] += 1
    return got


def targets(sizes, weights=(3, 1, 2), share=1.5, ceiling=2):
    """sizes: {source: words}; the rounds of the rule as they are worded."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    got = dict.fromkeys(names, 0.0)
    full, left = set(), share * sum(sizes.values())
    while left > 1e-9 and len(full) < len(names):
        total = sum(weight[s] for s in names if s not in full)
        for s in names:
            if s not in full:
                got[s] += left * weight[s] / total
        left = 0.0
        for s in names:
            if s not in full and got[s] >= ceiling * sizes[s]:
                left += got[s] - ceiling * sizes[s]
                got[s] = float(ceiling * sizes[s])
                full.add(s)
    return got


def edited(text, after):
    n = len(text)
    return text[:n - n // 4] + after[:n // 4]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def by_source(rows_):
    out = defaultdict(int)
    for source, taken in rows_:
        out[source] += taken
    return dict(out)
