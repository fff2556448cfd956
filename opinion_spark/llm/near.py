"""Near-duplicate classes by HyperMinHash: links of Jaccard similarity ``percent`` or more (op5: 85 %).

1. A document's set of 5-word shingles gives a sketch in one pass: the hash space
   is cut into buckets, and each keeps the leading-zero count and ``MANTISSA`` further
   bits of its smallest hash, 16 bits in all, ``REGISTERS`` in all. So that hardly a register is
   empty (empty ones agree in texts that share a single line), a small set is hashed 2, 4, ... 64 times
   into so many fewer buckets, ``FILL`` shingles or more each; a set that may link with one of
   another such level has both levels' registers. Documents with equal sets (a 128-bit digest of
   the set) become one node.
2. Neighbouring registers form a band, as many (8 at most) as let a pair at the threshold
   miss all bands with a probability of ``MISS`` or less (``band_rows``: 8 in 40 bands at 85 %,
   6 in 54 at 80 %); equal bands make a candidate group.
3. A group is compared with one leader, not pair by pair: what the leader links
   is one component already. A second round with more central leaders follows.
4. Documents of groups that still hold several components meet exactly: texts
   of similarity t share one of the 1 + (1 - t) n rarest shingles of each (n: the set's
   size), so a document whose own wording fills that prefix has no partner
   and is done, and the others meet on the rest of their prefixes, once a
   pair, if they are of different components and of fitting sizes, and if
   two-bit digests of their registers do not already prove them apart.
5. Each candidate pair is first estimated from its registers, corrected for
   accidental register matches, and dropped only far below the threshold (an estimate
   ``ERRORS`` standard errors under it, ``least_estimate``); the rest is verified on the
   full sets of the texts.
6. Connected components by repeated smallest labels with pointer jumping.

Nothing is capped: a group of copies costs its size for each leader. Lineage is
cut by tables in the shared folder, each deleted after its last reader. Groups that may hold more than a
10000th of all rows are joined by broadcast (there are fewer than 10000 of them).

Defined results: null, empty or wordless texts have an empty set and are linked
with nothing; a null doc_id is linked with nothing and has no component, and is
kept; rows that repeat an id count as one document; an empty table gives an
empty table. Texts are read whole; a text under five words is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.llm.common import Scratch, attach, table

REGISTERS, MANTISSA = 320, 10
MISS, ERRORS = 3e-6, 6.0
EMPTY = 0xFFFF
FILL, LEVELS = 4, 6


def band_rows(percent: int) -> int:
    """The longest band, up to 8 registers, with which a pair at the threshold misses all bands with a probability of MISS or less."""
    t = percent / 100
    return next((k for k in range(8, 0, -1) if (1 - t ** k) ** (REGISTERS // k) <= MISS), 1)


def least_estimate(percent: int) -> float:
    """The estimate ERRORS standard errors (of all registers full) under the threshold."""
    t = percent / 100
    return t - ERRORS * (t * (1 - t) / REGISTERS) ** 0.5


def shingle_set(text: str | None, words: int = 5):
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    import numpy as np
    import xxhash

    digest = xxhash.xxh3_64_digest
    # bytes.lower and bytes.split know ASCII only: A-Z, and \x20 and \x09-\x0D
    each = b"".join([digest(w) for w in (text or "").encode("utf-8", "surrogatepass").lower().split()])
    x = np.frombuffer(each, "<u8")
    if not len(x):
        return x.astype("uint64")
    k = min(words, len(x))
    odd = np.uint64(0x9E3779B97F4A7C15)
    total, factor = np.zeros(len(x) - k + 1, "uint64"), np.uint64(1 + 2 * k)
    with np.errstate(over="ignore"):
        for j in range(k):
            factor = factor * odd
            total += x[j:len(x) - k + 1 + j] * factor
    return np.unique(mixed(total))


def mixed(x):
    """A 64-bit finaliser, so that linear structure in the sums leaves no trace."""
    import numpy as np

    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def level_of(n: int) -> int:
    """How often a set of n shingles is hashed anew: 2**level times into REGISTERS >> level buckets, ``FILL`` shingles or more each."""
    return min(LEVELS, max(0, (-(-FILL * REGISTERS // max(n, 1)) - 1).bit_length()))


def levels(n: int, percent: int) -> list[int]:
    """The levels of a set of n shingles: its own, and that of the largest set that can link with it."""
    return sorted({level_of(n), level_of(100 * n // percent)}, reverse=True)


def registers(hashes, level: int = 0):
    """HyperMinHash registers of a sorted hash set: zeros << MANTISSA | mantissa, or EMPTY; 2**level hashes' buckets in turn."""
    import numpy as np

    buckets, times = REGISTERS >> level, 1 << level
    out = np.full(REGISTERS, EMPTY, "uint16")
    if not len(hashes):
        return out
    with np.errstate(over="ignore"):
        x = hashes[None, :]
        if times > 1:  # the first hash is the set's own
            seeds = np.arange(times, dtype="uint64") * np.uint64(0xD1B54A32D192ED03)
            x = np.where(seeds[:, None] == 0, x, mixed(x ^ mixed(seeds)[:, None]))
            x.sort(axis=1)
        x = x.ravel()
        # bucket: whole part of x * buckets / 2**64; place inside it: the fraction, of 64 bits
        low, half = x & np.uint64(0xFFFFFFFF), np.uint64(32)
        bucket = ((x >> half) * np.uint64(buckets) + ((low * np.uint64(buckets)) >> half)) >> half
        at = bucket.astype("int64") + np.repeat(np.arange(times), len(hashes)) * buckets
        first = np.r_[True, at[1:] != at[:-1]]
        at, rest = at[first], x[first] * np.uint64(buckets)
    zeros = np.zeros(len(rest), "uint64")
    for step in (32, 16, 8, 4, 2, 1):
        low = rest < np.uint64(1 << (64 - step))
        rest = np.where(low, rest << np.uint64(step), rest)
        zeros += low.astype("uint64") * np.uint64(step)
    mantissa = (rest << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    out[at] = np.minimum((zeros << np.uint64(MANTISSA)) | mantissa, np.uint64(EMPTY - 1))
    return out


def digest(regs) -> list[int]:
    """Two bits a register, 32 registers a long: 0 for empty, else 1 to 3."""
    import numpy as np

    two = np.where(regs == EMPTY, 0, 1 + regs.astype("uint64") % 3).astype("uint64")
    shifted = two.reshape(-1, 32) << np.arange(0, 64, 2, dtype="uint64")
    return np.bitwise_or.reduce(shifted, axis=1).astype("int64").tolist()


def digests_agree(x: Column, y: Column, n: Column, percent: int) -> Column:
    """Whether the digests leave the similarity possible; ``n``: the sum of both set sizes.

    No link is lost: registers that differ need a shingle each that only one set has, and
    of those a pair of similarity t has at most n (1 - t) / (1 + t).
    """
    pairs = F.lit(0x5555555555555555)
    count = lambda v: F.bit_count(v.bitwiseOR(F.shiftrightunsigned(v, 1)).bitwiseAND(pairs))
    differ = reduce(add, [count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(REGISTERS // 32)])
    return differ * (100 + percent) <= n * (100 - percent)


def estimate(a, b) -> float:
    """Jaccard estimate of two register arrays, less the matches that occur by accident."""
    import numpy as np

    used = (a != EMPTY) | (b != EMPTY)
    n = int(used.sum())
    if not n:
        return 0.0
    by_chance = 2.0 ** -MANTISSA / 3  # equal mantissas, and equal zero counts (sum of 4 ** -k)
    return max(0.0, (int(((a == b) & used).sum()) / n - by_chance) / (1 - by_chance))


def _sketch(percent: int):
    rows_each = band_rows(percent)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        starts = np.array([min(k, REGISTERS - rows_each) for k in range(0, REGISTERS, rows_each)])
        places = starts[:, None] + np.arange(rows_each)
        odd = mixed(np.arange(1, rows_each + 1, dtype="uint64")) | np.uint64(1)
        signed = lambda x: int(np.uint64(x).astype("int64"))
        for b in batches:
            rows = []
            for key, text in zip(b.key, b.text):
                h = shingle_set(text)
                kept, bands = [], []
                for level in levels(len(h), percent):
                    regs = registers(h, level)
                    kept.append(regs.astype("<u2").tobytes())
                    parts = regs[places]
                    with np.errstate(over="ignore"):
                        hashed = mixed((parts.astype("uint64") * odd).sum(axis=1, dtype="uint64") + mixed(starts.astype("uint64") + np.uint64((level + 1) << 32)))
                    bands += hashed[(parts != EMPTY).any(axis=1)].astype("int64").tolist()
                with np.errstate(over="ignore"):
                    set0, set1 = (signed(mixed(h ^ np.uint64(s)).sum(dtype="uint64")) for s in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
                rows.append((None if key is None else int(key), len(h), set0, set1, b"".join(kept), bands))
            out = pd.DataFrame(rows, columns=["id", "n", "set0", "set1", "regs", "bands"], dtype=object)
            out["id"] = pd.array(out["id"].tolist(), dtype="Int64")
            yield out.astype({"n": "int64", "set0": "int64", "set1": "int64"})

    return run


def _likely(percent: int):
    least = least_estimate(percent)

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        def at(regs, n, level):
            place = levels(n, percent).index(level)
            return np.frombuffer(regs, "<u2")[place * REGISTERS:(place + 1) * REGISTERS]

        for b in batches:
            ok = []
            for x, y, n, m in zip(b.regs_a, b.regs_b, b.n_a, b.n_b):
                fits = 100 * min(n, m) >= percent * max(n, m)
                level = level_of(max(n, m))  # the smaller set has this level too
                ok.append(fits and estimate(at(x, n, level), at(y, m, level)) >= least)
            yield b.loc[ok, ["a", "b"]]

    return run


def _verify(percent: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        recent: dict = {}  # sets of the last few left-hand texts: a leader's pairs come together

        for batch in batches:
            ok = []
            for a, left, right in zip(batch.a, batch.text_a, batch.text_b):
                if (x := recent.get((a, left))) is None:
                    if len(recent) >= 8:
                        recent.clear()
                    x = recent[a, left] = shingle_set(left)
                y = shingle_set(right)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both) and both > 0)
            yield batch.loc[ok, ["a", "b"]]

    return run


def _shingles(batches: Iterator) -> Iterator:
    import pandas as pd

    for b in batches:
        sets = [shingle_set(x) for x in b.text]
        codes = [digest(registers(x)) for x in sets]
        yield pd.DataFrame({"id": b.id, "comp": b.comp, "n": [len(x) for x in sets], "set": [x.astype("int64") for x in sets], "code": codes})


def meeting(docs: DataFrame, percent: int, s: Scratch) -> DataFrame:
    """Pairs ``a < b`` of different components that may reach the similarity, from ``id, comp, text``.

    Exact: the order of the shingles is the same for all, those of one component first, then by frequency and hash.
    """
    sets = s.written(docs.mapInPandas(_shingles, "id long, comp long, n int, set array<long>, code array<long>"), "sets")
    each = sets.select("id", "comp", F.explode("set").alias("s"))
    seen = each.groupBy("s").agg(F.count(F.lit(1)).alias("df"), F.min("comp").alias("lo"), F.max("comp").alias("hi"))
    across = s.written(seen.where("lo < hi").select("s", "df"), "across", slim=True)
    # shingles of one component come first in the order; no pair meets there, so they are counted, not carried
    size = F.floor(F.col("n") * (100 - percent) / 100).cast("int") + 1
    found = attach(each.select("id", "s"), across, ["s"], "df").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("c"))
    own = F.col("n") - F.size("c")
    prefix = (sets.select("id", "comp", "n", "code").join(found, "id").where(size > own)
              .select("id", "comp", "n", "code", own.alias("own"), F.posexplode(F.slice("c.s", F.lit(1), size - own)).alias("at", "s"))
              .select("id", "comp", "n", "code", (F.col("own") + F.col("at")).alias("at"), "s"))
    prefix = s.written(prefix, "prefix")
    s.drop("sets", "across")
    x, y = prefix.alias("x"), prefix.alias("y")
    n, rest = F.col("x.n") + F.col("y.n"), F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    fits = (F.col("x.comp") != F.col("y.comp")) & (F.col("x.id") < F.col("y.id"))
    fits &= (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
    # where a pair meets first, all its common shingles are still to come
    fits &= rest * (100 + percent) >= n * percent
    fits &= digests_agree(F.col("x.code"), F.col("y.code"), n, percent)
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & fits).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    pairs = s.written(pairs, "met", slim=True)
    s.drop("prefix")
    return pairs


def connected(edges: DataFrame, s: Scratch) -> DataFrame:
    """``id, comp`` (smallest id reachable) of every id in ``edges`` (``a, b``)."""
    s.drop("labels")
    both = s.written(edges.select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                                    F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
                     .select("e.u", "e.v").distinct(), "edges", slim=True)
    labels = s.written(both.groupBy(F.col("u").alias("id")).agg(F.least(F.min("v"), F.first("u")).alias("comp")), "labels", slim=True)
    while True:
        near = both.join(labels.select(F.col("id").alias("v"), "comp"), "v").groupBy(F.col("u").alias("id")).agg(F.min("comp").alias("m"))
        low = labels.join(near, "id").select("id", "comp", F.least("comp", "m").alias("low"))
        up = labels.select(F.col("id").alias("low"), F.col("comp").alias("jump"))
        # a label is itself an id, so its own label is a shortcut
        new = s.written(low.join(up, "low").select("id", F.least("low", "jump").alias("comp"), (F.least("low", "jump") < F.col("comp")).alias("moved")), "labels", slim=True)
        s.drop("labels", but_last=True)
        labels = new.select("id", "comp")
        if new.where("moved").isEmpty():
            s.drop("edges")
            return labels


def components(docs: DataFrame, percent: int = 85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row."""
    s = Scratch(docs.sparkSession, "near")
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    sketch = s.written(rows.withColumn("key", F.col("key").cast("string")).mapInPandas(_sketch(percent), "id long, n long, set0 long, set1 long, regs binary, bands array<long>"), "sketch")
    base = s.written(sketch.select("id", "n", "set0", "set1"), "base")
    known = base.where("id is not null and n > 0")
    a_set = ["set0", "set1", "n"]
    classes = s.written(known.groupBy(*a_set).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes", slim=True)
    member = s.written(attach(known, classes, a_set, "size").distinct(), "member", slim=True)
    own = classes.select(F.col("rep").alias("id"), *a_set)
    reps = s.written(sketch.join(own, ["id", *a_set], "left_semi").dropDuplicates(["id", *a_set]).select("id", "n", "regs", "bands"), "reps")
    s.drop("sketch", "classes")
    bands = reps.select("id", F.explode("bands").alias("band"))
    groups = bands.groupBy("band").agg(F.min("id").alias("lead"), F.max("id").alias("other"), F.count(F.lit(1)).alias("size")).where("lead < other")
    hits = s.written(attach(bands, s.written(groups.select("band", "lead", "size"), "groups", slim=True), ["band"], "size").select("band", "id", "lead"), "hits", slim=True)
    needed = hits.select(F.col("id").alias("key")).distinct()
    texts = s.written(rows.join(needed, "key", "left_semi").select(F.col("key").alias("id"), "text"), "texts")
    regs = reps.select("id", "n", "regs")
    s.drop("groups")

    def links(pairs: DataFrame) -> DataFrame:
        """The verified ones of the pairs ``a < b``."""
        x, y = (regs.select(F.col("id").alias(k), F.col("n").alias(f"n_{k}"), F.col("regs").alias(f"regs_{k}")) for k in "ab")
        likely = pairs.join(y, "b").join(x, "a").select("a", "b", "regs_a", "regs_b", "n_a", "n_b").mapInPandas(_likely(percent), "a long, b long")
        likely = s.written(likely, "likely")
        p, q = (texts.select(F.col("id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
        # the leader's side, which may be hot, comes last: its rows are split, not moved again
        return likely.join(q, "b").join(p, "a").select("a", "b", "text_a", "text_b").mapInPandas(_verify(percent), "a long, b long").distinct()

    def ordered(pairs: DataFrame, a: str, b: str) -> DataFrame:
        return pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()

    def added(pairs: DataFrame, edges: DataFrame | None) -> DataFrame:
        new = links(pairs)
        out = s.written(new if edges is None else edges.unionByName(new), "links", slim=True)
        s.drop("likely", "met", "open")
        s.drop("links", but_last=True)
        return out

    edges = added(ordered(hits, "lead", "id"), None)
    comp = connected(edges, s)
    for last in (False, True):
        at = s.written(hits.select("band", "id").join(comp, "id", "left").select("band", "id", F.coalesce("comp", "id").alias("comp")), "at", slim=True)
        open_bands = at.groupBy("band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("size")).where("lo < hi").select("band", "size")
        left = s.written(attach(at, s.written(open_bands, "bands", slim=True), ["band"], "size"), "open", slim=True)
        s.drop("at", "bands")
        if left.isEmpty():
            break
        if not last:  # another leader for each group: the member that shares most with other members
            shared = left.groupBy("id").agg(F.sum("size").alias("shared"))
            lead = left.join(shared, "id").groupBy("band").agg(F.max(F.struct("shared", "id", "comp")).alias("l"), F.count(F.lit(1)).alias("size"))
            pairs = attach(left.drop("size"), s.written(lead, "lead", slim=True), ["band"], "size").where("comp <> l.comp").select("id", F.col("l.id").alias("lead"))
            pairs = s.written(ordered(pairs, "lead", "id"), "met", slim=True)
            s.drop("lead")
        else:
            pairs = meeting(left.select("id", "comp").distinct().join(texts, "id"), percent, s)
        edges = added(pairs, edges)
        comp = connected(edges, s)
    s.drop("reps", "hits", "texts", "open", "links")

    per_class = member.select("id", *a_set, "rep").distinct().join(comp.select(F.col("id").alias("rep"), "comp"), "rep", "left")
    owner = per_class.select("id", *a_set, F.coalesce("comp", "rep").alias("comp"))
    out = base.join(owner, ["id", *a_set], "left")
    component = F.coalesce("comp", "id")
    return out.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def query(spark, sf_dir):
    """op5: the component of every document."""
    return components(table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') END AS words FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END) AS sh FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(id, to_id) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.id, e2.b FROM r JOIN e2 ON e2.a = r.to_id),
m AS (SELECT id, min(to_id) AS component_id FROM r GROUP BY 1)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.id = w.doc_id
"""
