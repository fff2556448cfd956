"""Entry B: documents -> similarity graph -> communities -> named topics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opinion_spark.operators import cleaning, graph, hashtags, similarity, topics
from opinion_spark.tables import Scratch


def topic_clusters(docs: DataFrame, stop_words: list[str], threshold: float = 0.05, num_perm: int = 120,
                   q: int = 4, min_cluster_size: int = 5, n_terms: int = 5, n_clusters: int = 10,
                   bands: int | None = None, rows: int | None = None, hi: float = 0.40,
                   key: str = "doc_id", text: str = "text", costs: DataFrame | None = None):
    """Returns ``(membership, top, merge_log)``.

    ``membership`` = ``(doc_id, cluster)`` of the kept clusters after merging;
    ``top`` = ``(cluster, rank, term, score)``. Clusters that were never merged
    keep the terms of the joint fit; merged ones are refitted on their own
    documents (quirk Q15). With ``costs`` (C16) URLs are stripped and hashtags become their words before
    anything is signed or counted (C13, C14).
    """
    spark = docs.sparkSession
    if bands is None or rows is None:
        bands, rows = similarity.optimal_bands(threshold, num_perm)
    d = docs.select(key, text)
    if costs is not None:
        d = hashtags.replace_hashtags(d.withColumn(text, cleaning.strip_urls(F.col(text))), costs, text)
        d = Scratch(spark, "topics").written(d, "posts")
    sigs = similarity.minhash(d, num_perm, q, text=text, key=key)
    edges = similarity.similar_pairs(sigs, bands, rows, threshold, hi, key=key)
    part = graph.louvain(d.select(F.col(key).alias("id")), edges)
    sizes = graph.clusters_of(part, min_cluster_size).withColumnRenamed("community", "cluster")
    membership = (part.join(sizes, part.community == sizes.cluster, "inner")
                  .select(F.col("id").alias(key), "cluster"))
    membership = graph._checkpoint(membership)
    tf = topics.term_counts(d.join(membership, key, "left_semi"), stop_words, key, text)
    n_docs = membership.agg(F.count(F.lit(1))).scalar()
    vocab = topics.vocabulary(tf, n_docs)
    scores = topics.cluster_term_scores(topics.tfidf(tf, vocab, n_docs, key), membership, sizes, key)
    top = topics.top_terms(scores, n_terms)
    n_found = sizes.count()
    log: list = []
    if n_found > n_clusters:
        membership, log = topics.merge_clusters(spark, membership, tf, n_clusters, key)
        kind = dict(membership.dtypes)["cluster"]
        ids = lambda col: spark.createDataFrame(sorted({(x[k],) for x in log for k in col}), f"cluster {kind}")
        refit = topics.top_terms_per_group(d, membership.join(F.broadcast(ids([1])), "cluster", "left_semi").select(membership.columns), n_terms, stop_words, key=key)
        top = top.join(F.broadcast(ids([1, 2])), "cluster", "left_anti").select(top.columns).unionByName(refit.select(top.columns))
    return membership, top, log
