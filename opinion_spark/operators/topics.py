"""TF-IDF topic terms and topic merging.

Term statistics are long tables ``(doc, term, count)`` built by explode +
grouped count; the vocabulary filters, idf, L2 norms, per-cluster means and
top-n are grouped aggregations and windows with group limits. TF-IDF follows
the smoothed form idf = ln((1+n)/(1+df)) + 1 with L2-normalised rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.tables import Scratch, attach, ranked

TOKEN = r"[\p{L}\p{N}_]{2,}"


def _row_counts(docs: DataFrame, stops: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, term, tf)`` of each row alone: its sorted tokens are cut into runs, so nothing is shuffled."""
    def runs(toks):
        starts = F.filter(F.sequence(F.lit(1), F.size(toks)), lambda i: (i == 1) | (F.get(toks, i - 1) != F.get(toks, i - 2)))
        return F.when(F.size(toks) > 0, _bound(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(toks, i - 1).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(toks) + 1) - i).cast("long").alias("tf")))))

    toks = F.array_sort(F.regexp_extract_all(F.lower(F.col(text)), F.lit(TOKEN), 0))
    each = docs.select(key, F.explode(_bound(toks, runs)).alias("_t")).select(key, "_t.term", "_t.tf")
    return each.join(stops, "term", "left_anti").select(key, "term", "tf")


def _bound(value, body):
    """``body(value)`` with the value computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_counts(docs: DataFrame, stop_words: list[str], key: str = "doc_id", text: str = "text", together: bool = False) -> DataFrame:
    """T1 + J7: ``(doc_id, term, tf)``: lower-cased word tokens of 2+ chars,
    stop words removed by a left-anti join on the (bounded) stop list.

    Terms are counted inside their rows; only rows whose key another row has too (a null key is a key) are then added up by a
    shuffle. ``together``: the texts are dealt out by key first, so that what goes by key afterwards shuffles no term again.
    """
    spark = docs.sparkSession
    stops = F.broadcast(spark.createDataFrame([(w,) for w in sorted(set(stop_words))], "term string"))
    many = docs.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_k")
    many = Scratch(spark, "terms").written(many, "repeated", slim=True)
    if many.isEmpty():
        return _row_counts(docs.repartition(F.col(key)) if together else docs, stops, key, text)
    same = docs[key].eqNullSafe(many["_k"])
    alone = docs.join(many, same, "left_anti")
    rest = _row_counts(docs.join(many, same, "left_semi"), stops, key, text).groupBy(key, "term").agg(F.sum("tf").alias("tf"))
    return _row_counts(alone.repartition(F.col(key)) if together else alone, stops, key, text).unionByName(rest)


def vocabulary(tf: DataFrame, n_docs, min_df: int = 7, max_df: float = 0.7,
               max_features: int | None = 3000, key: str = "doc_id") -> DataFrame:
    """``(term, df)`` kept by min_df (docs), max_df (share of docs) and the
    top ``max_features`` by corpus frequency (ties by term)."""
    stats = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
    stats = stats.where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs))
    if max_features is not None:
        # top-k over a vocabulary-sized table (a limit that is the feature)
        stats = stats.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features)
    return stats.select("term", "df")


def tfidf(tf: DataFrame, vocab: DataFrame, n_docs, key: str = "doc_id") -> DataFrame:
    """``(doc_id, term, tfidf)`` with smooth idf and L2-normalised rows."""
    idf = vocab.select("term", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    x = tf.join(idf, "term").select(key, "term", (F.col("tf") * F.col("idf")).alias("x"))
    # a document's rows are its distinct terms; as a window, x is built once
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy(key)))
    return x.select(key, "term", (F.col("x") / norm).alias("tfidf"))


def cluster_term_scores(weights: DataFrame, membership: DataFrame, sizes: DataFrame,
                        key: str = "doc_id") -> DataFrame:
    """T4: mean TF-IDF per cluster over all its docs (absent terms count 0)."""
    j = weights.join(membership, key)
    s = j.groupBy("cluster", "term").agg(F.sum("tfidf").alias("tot"))
    return s.join(sizes, "cluster").select("cluster", "term", (F.col("tot") / F.col("size")).alias("score"))


def top_terms(scores: DataFrame, n: int) -> DataFrame:
    """T5: ``(cluster, rank, term, score)`` for the n best terms per cluster."""
    w = Window.partitionBy("cluster").orderBy(F.col("score").desc(), F.col("term"))
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def most_frequent(stats: DataFrame, most: int, shards: int = 64) -> DataFrame:
    """The ``most`` rows of each cluster with the highest ``cf``, ties by term, without sorting a cluster's rows.

    A histogram of counts per cluster gives the count at the cut: what lies above it is kept whole, and of the terms at
    the cut itself the first remaining ones are taken, first inside each of ``shards`` hash shards, then of those.
    """
    s = Scratch(stats.sparkSession, "features")
    stats = s.written(stats, "stats")
    bins = stats.groupBy("cluster", "cf").agg(F.count(F.lit(1)).alias("_n"))  # a row for each different count
    upto = F.sum("_n").over(Window.partitionBy("cluster").orderBy(F.col("cf").desc()))
    cut = (bins.withColumn("_upto", upto).where(F.col("_upto") - F.col("_n") < most)
           .groupBy("cluster").agg(F.min("cf").alias("_cut"), F.max_by(F.col("_upto") - F.col("_n"), -F.col("cf")).alias("_above"), F.max("_upto").alias("_size")))
    both = attach(stats, s.written(cut, "cuts"), ["cluster"], "_size")
    above = both.where(F.col("cf") > F.col("_cut"))
    shard = F.pmod(F.xxhash64("term"), F.lit(shards))
    room = F.lit(most) - F.col("_above")
    ties = both.where(F.col("cf") == F.col("_cut")).withColumn("_shard", shard)
    ties = ties.withColumn("_r", F.row_number().over(Window.partitionBy("cluster", "_shard").orderBy("term"))).where(F.col("_r") <= room)
    ties = ties.withColumn("_r", F.row_number().over(Window.partitionBy("cluster").orderBy("term"))).where(F.col("_r") <= room)
    return above.select(*stats.columns).unionByName(ties.select(*stats.columns))


def top_terms_per_group(docs: DataFrame, groups: DataFrame, n: int, stop_words: list[str],
                        min_df: int = 7, max_df: float = 0.7, max_features: int | None = 3000,
                        key: str = "doc_id") -> DataFrame:
    """T6 for many groups at once: each group's vocabulary, idf and means are
    fitted on that group's docs alone. ``groups`` is ``(doc_id, cluster)``.
    Groups whose vocabulary is empty get no rows."""
    s = Scratch(docs.sparkSession, "groups")
    tf = term_counts(docs, stop_words, key, together=True).join(groups, key)
    nd = groups.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_docs"))
    stats = (tf.groupBy("cluster", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
             .join(nd, "cluster")
             .where((F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * F.col("n_docs"))))
    if max_features is not None:
        stats = most_frequent(stats, max_features)
    idf = stats.select("cluster", "term", "n_docs",
                       (F.log((F.col("n_docs") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))
    idf = s.written(idf, "idf", slim=True)  # of known size, so Spark broadcasts it where it is small
    x = tf.join(idf, ["cluster", "term"]).select("cluster", key, "term", "n_docs",
                                                  (F.col("tf") * F.col("idf")).alias("x"))
    norm = F.sqrt(F.sum(F.col("x") * F.col("x")).over(Window.partitionBy("cluster", key)))
    sc = (x.withColumn("nrm", norm).groupBy("cluster", "term")
          .agg((F.sum(F.col("x") / F.col("nrm")) / F.first("n_docs")).alias("score")))
    return top_terms(sc, n)


def cluster_cosine(counts: DataFrame, block: int = 512) -> DataFrame:
    """T7 + J6: cosine of cluster-level TF-IDF vectors for cluster pairs.

    ``counts`` is ``(cluster, term, tf)`` of the concatenated texts. Idf is
    fitted over the clusters (no df limits), rows are L2-normalised, and the
    dot products come from a self-join on term. A term shared by many
    clusters is split into blocks of clusters, joined block pair by block
    pair, so no task builds more than block^2 products. Pairs without a common
    term have similarity 0 and no row.
    """
    counts = Scratch(counts.sparkSession, "cosine").written(counts, "counts")  # read for n, df, norms and both sides of the products
    n = counts.select(F.count_distinct("cluster")).scalar()
    df = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    x = counts.join(df, "term").select(
        "cluster", "term", "df",
        (F.col("tf") * (F.log(F.lit(1.0 + n) / (F.col("df") + 1.0)) + 1.0)).alias("x"))
    norm = x.groupBy("cluster").agg(F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("nrm"))
    v = x.join(norm, "cluster").select("cluster", "term", "df", (F.col("x") / F.col("nrm")).alias("v"))
    nb = F.greatest(F.lit(1), F.ceil(F.col("df") / F.lit(block)).cast("int"))
    v = v.withColumn("_nb", nb).withColumn("_blk", F.pmod(F.xxhash64("cluster"), F.col("_nb")).cast("int"))
    cells = v.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_nb") - 1))).select(
        "cluster", "term", "v", "_blk", F.least("_blk", "_j").alias("_lo"), F.greatest("_blk", "_j").alias("_hi"))
    l, r = cells.alias("l"), cells.alias("r")
    cond = ((F.col("l.term") == F.col("r.term")) & (F.col("l._lo") == F.col("r._lo"))
            & (F.col("l._hi") == F.col("r._hi")) & (F.col("l.cluster") < F.col("r.cluster"))
            & ((F.col("l._blk") != F.col("r._blk")) | (F.col("l._lo") == F.col("l._hi"))))
    prod = l.join(r, cond).select(F.col("l.cluster").alias("c1"), F.col("r.cluster").alias("c2"),
                                  (F.col("l.v") * F.col("r.v")).alias("p"))
    return prod.groupBy("c1", "c2").agg(F.sum("p").alias("cosine"))


class PairState:
    """T8's state: the holders of every term, and each pair of clusters' count products by document frequency.

    ``postings`` has a row for each term: ``h``, an array of ``(c, tf)`` by cluster number, so df is its size and a merge
    changes rows in place, without a join. ``sums`` is ``(c1, c2, df, s)``, c1 <= c2: the sum of tf1 * tf2 over the
    common terms of that df. All are whole numbers, so an updated state equals one computed anew. With n clusters
    idf = c - l, c = ln(1 + n) + 1 and l = ln(1 + df), so a pair's product of TF-IDF vectors is the sum of s * (c - l)**2 over
    df, its own row gives the squared norm, and a change of n touches no row.
    """

    def __init__(self, counts: DataFrame, s: Scratch):
        """``counts``: ``(c, term, tf)``."""
        self.s = s
        holders = F.array_sort(F.collect_list(F.struct("c", "tf"))).alias("h")  # at most one entry a cluster
        self.postings = s.written(counts.groupBy("term").agg(holders).select("h"), "postings")
        self.sums = s.written(products(self.postings.withColumn("sign", F.lit(1))), "sums", slim=True)

    def best(self, n: int):
        """``(c1, c2, cosine)`` of the most similar pair (ties to the smallest), or None where no two clusters share a term."""
        idf = F.lit(math.log(1 + n) + 1) - F.log(F.col("df") + 1.0)
        dots = self.sums.groupBy("c1", "c2").agg(F.sum(F.col("s") * idf * idf).alias("dot"))
        norms = dots.where("c1 = c2")
        pairs = (dots.where("c1 < c2").join(norms.select("c1", F.col("dot").alias("d1")), "c1")
                 .join(norms.select("c2", F.col("dot").alias("d2")), "c2"))
        cosine = F.col("dot") / F.sqrt(F.col("d1") * F.col("d2"))
        # rounded, so that the order of summation cannot decide a tie
        return pairs.select("c1", "c2", cosine.alias("cosine")).orderBy(F.round("cosine", 12).desc(), "c1", "c2").limit(1).first()

    def merge(self, a: int, b: int) -> None:
        """Fold cluster b into a: only terms of b are read apart, and only their pairs change."""
        s, ours = self.s, lambda x: x["c"].isin(a, b)
        has = F.exists("h", lambda x: x["c"] == b)
        mine = F.aggregate(F.filter("h", ours), F.lit(0).cast("long"), lambda total, x: total + x["tf"])
        one = F.struct(F.lit(a).alias("c"), mine.alias("tf"))
        new = F.array_sort(F.concat(F.filter("h", lambda x: ~ours(x)), F.array(one)))
        both = F.array(F.struct("h", F.lit(-1).alias("sign")), F.struct(new.alias("h"), F.lit(1).alias("sign")))
        change = products(self.postings.where(has).select(F.explode(both).alias("x")).select("x.*"))
        every = self.sums.unionByName(change).groupBy("c1", "c2", "df").agg(F.sum("s").alias("s"))
        self.sums = s.written(every.where("s <> 0"), "sums", slim=True)
        self.postings = s.written(self.postings.select(F.when(has, new).otherwise(F.col("h")).alias("h")), "postings")
        s.drop("sums", "postings", but_last=True, collect=False)


def products(postings: DataFrame) -> DataFrame:
    """``(c1, c2, df, s)``, c1 <= c2: signed sums of tf1 * tf2 over terms, from ``(h, sign)``."""
    left = postings.select("sign", "h", F.size("h").alias("df"), F.posexplode("h").alias("i", "x"))
    pairs = left.select("sign", "df", "x", F.explode(F.expr("slice(h, i + 1, df - i)")).alias("y"))
    return pairs.groupBy(F.col("x.c").alias("c1"), F.col("y.c").alias("c2"), "df").agg(F.sum(F.col("sign") * F.col("x.tf") * F.col("y.tf")).alias("s"))


def merge_clusters(spark, membership: DataFrame, tf: DataFrame, target: int, key: str = "doc_id",
                   max_rounds: int | None = None):
    """Greedy merges of the most similar cluster pair until ``target`` remain.

    ``membership`` is ``(doc_id, cluster)``; ``tf`` is ``(doc_id, term, tf)`` over stop-word-filtered tokens. Idf is that
    of the current clusters in every round (``PairState``), yet a round only reads what the merged pair touches. The pair
    with the highest cosine wins, ties to the smallest (c1, c2); c2 is folded into c1. Without a common term the
    first two clusters merge. One row (the winning pair) reaches the driver per round, and the log, a row a merge, is
    joined back as a table. Returns the final ``(doc_id, cluster)`` membership and the merge log.
    """
    s = Scratch(spark, "merge")
    known = membership.where("cluster is not null")
    names = ranked(known.select("cluster").distinct(), [F.col("cluster").asc()], "c", s)
    names = s.written(names.select("cluster", F.col("c").cast("int").alias("c")), "names", slim=True)
    left = names.count()
    merges: list = []
    gone: set = set()
    state = None
    while left > target and (max_rounds is None or len(merges) < max_rounds):
        if state is None:
            counts = tf.join(known.join(names, "cluster").select(key, "c"), key).groupBy("c", "term").agg(F.sum("tf").alias("tf"))
            state = PairState(counts, s)
        best = state.best(left)
        if best is not None:
            c1, c2, cos = best
        else:  # no two clusters share a term: all similarities are 0, the first pair wins
            c1, c2 = (c for c, _ in zip((c for c in itertools.count() if c not in gone), range(2)))
            cos = 0.0
        state.merge(c1, c2)
        merges.append((c1, c2, float(cos)))
        gone.add(c2)
        left -= 1
    final: dict = {}
    for c1, c2, _ in reversed(merges):
        final[c2] = final.get(c1, c1)
    touched = sorted({c for m in merges for c in m[:2]})
    name = {r["c"]: r["cluster"] for r in names.where(F.col("c").isin(touched)).collect()}  # two a merge at most
    kind = dict(membership.dtypes)["cluster"]
    moved = spark.createDataFrame([(name[c], name[to]) for c, to in final.items()], f"cluster {kind}, _to {kind}")
    s.drop("postings", "sums", "names", "ranked")
    out = known.join(F.broadcast(moved), "cluster", "left")  # as large as the log, which the driver holds
    return out.select(key, F.coalesce("_to", "cluster").alias("cluster")), [(k, name[c1], name[c2], cos) for k, (c1, c2, cos) in enumerate(merges)]


def term_weights(top: DataFrame, max_terms: int) -> DataFrame:
    """Display size 50*0.85^i and opacity 1 - 0.5*i/n per top term."""
    t = top.where(F.col("rank") <= max_terms)
    n = t.groupBy("cluster").agg(F.count(F.lit(1)).alias("_n"))
    i = F.col("rank") - 1
    return t.join(n, "cluster").select("cluster", "rank", "term",
                                       (F.lit(50.0) * F.pow(F.lit(0.85), i)).alias("size"),
                                       (F.lit(1.0) - i * 0.5 / F.col("_n")).alias("opacity"))


def cluster_labels(sizes: DataFrame) -> DataFrame:
    """Ordinal title and element count per cluster."""
    places = ranked(sizes.select("cluster", "size"), [F.col("cluster").asc()], "_place", Scratch(sizes.sparkSession, "labels"))
    return places.withColumn("ordinal", (F.col("_place") + 1).cast("int")).select(
        "cluster", "ordinal", "size",
        F.format_string("Cluster %d (%d elements)", F.col("ordinal"), F.col("size")).alias("label"))


def cluster_report(membership: DataFrame, docs: DataFrame, n_docs: int = 3, chars: int = 100,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """The first ``n_docs`` documents of each cluster cut to ``chars``."""
    w = Window.partitionBy("cluster").orderBy(key)
    first = membership.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n_docs)
    return first.join(docs, key).select("cluster", "pos", key, F.substring(text, 1, chars).alias("snippet"))
