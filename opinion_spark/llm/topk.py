"""Exact top-k inner products by Fagin's threshold algorithm.

Candidates and queries are dealt into blocks of bounded size, and every query
block meets every candidate block. A block keeps, for each dimension, its
candidates in sorted order. A query walks all lists in step, from the end that
its own component favours; each candidate seen for the first time is scored in
full by random access. The values at the current depth bound the score of
whatever is unseen; once the k-th best score reaches that bound, the block is done.
The blocks' lists are merged to k for each query.

The walk goes in steps of growing depth, so a step's random accesses are one
matrix product. Integer arithmetic is exact: float products are used only
where every sum stays below 2**53, else 64-bit integers or, beyond them, Python's.

Defined results: vectors that are null, or hold a null or non-finite component,
take no part; nor do rows without an id; vectors meet only vectors of their own length;
rows equal in id and vector count once; a
row never is a candidate of a query with its own id; with fewer candidates than
k all are returned; an empty table gives an empty table. Scores beyond 64 bits
raise an error.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import written

CANDIDATES, QUERIES = 8192, 1024


def _largest(x) -> int:
    """Largest absolute value, 1 at least (as Python's integer: -2**63 has no 64-bit opposite)."""
    return max(1, int(x.max(initial=0)), -int(x.min(initial=0)))


def _product(a, b):
    """Exact integer matrix product."""
    most = _largest(a) * _largest(b) * a.shape[1]
    if most < 1 << 53:
        return (a.astype("float64") @ b.astype("float64")).astype("int64")
    if most < 1 << 63:
        return a @ b
    exact = a.astype(object) @ b.astype(object)
    if max(map(abs, exact.ravel()), default=0) >= 1 << 63:
        raise OverflowError("a score exceeds 64 bits")
    return exact.astype("int64")


def search_block(cand_ids, cand, query_ids, queries, k: int):
    """(query row, candidate row, score) arrays: each query's k best of this block, by the threshold algorithm."""
    import numpy as np

    n, d = cand.shape
    order = np.argsort(cand.T, axis=1, kind="stable")  # a sorted list for each dimension
    listed = np.take_along_axis(cand.T, order, axis=1)
    # scores that fit a double exactly are products of floats, turned into them once a block
    small = _largest(cand) * _largest(queries) * d < 1 << 53
    floats = cand.astype("float64") if small else None
    out_q, out_c, out_s = [], [], []
    for row, (qid, q) in enumerate(zip(query_ids, queries)):
        dims = np.nonzero(q)[0]
        if not len(dims):  # all scores are 0: any order is a sorted list
            ids = np.nonzero(cand_ids != qid)[0]
            best = ids[np.argsort(cand_ids[ids], kind="stable")[:k]]
            score = np.zeros(len(best), "int64")
        else:
            down = q[dims] > 0
            weight, as_float = q[dims], q.astype("float64")
            seen = np.zeros(n, bool)
            seen[cand_ids == qid] = True  # not a candidate of its own
            best, score = np.empty(0, "int64"), np.empty(0, "int64")
            depth, step = 0, max(2 * k, 64)
            while depth < n:
                to = min(n, depth + step)
                # sorted access
                met = np.zeros(n, bool)
                met[order[dims[down], n - to:n - depth]] = True
                met[order[dims[~down], depth:to]] = True
                fresh = np.nonzero(met & ~seen)[0]
                seen[fresh] = True
                if len(fresh):  # random access
                    got = (floats[fresh] @ as_float).astype("int64") if small else _product(cand[fresh], q[:, None])[:, 0]
                    best, score = np.concatenate([best, fresh]), np.concatenate([score, got])
                    if len(score) > k:  # only what reaches the k-th score is sorted
                        high = score >= np.partition(score, len(score) - k)[len(score) - k]
                        best, score = best[high], score[high]
                    top = np.lexsort((cand_ids[best], -score))[:k]
                    best, score = best[top], score[top]
                depth, step = to, 2 * step
                if seen.all():
                    break
                edge = listed[dims, np.where(down, n - to, to - 1)]
                bound = int(weight @ edge) if small else sum(int(w) * int(x) for w, x in zip(weight, edge))
                # an unseen candidate may reach the bound itself and win a tie by its id
                if len(best) == k and score[-1] > bound:
                    break
        out_q.append(np.full(len(best), row))
        out_c.append(best)
        out_s.append(score)
    return tuple(np.concatenate(x).astype("int64") if x else np.empty(0, "int64") for x in (out_q, out_c, out_s))


def _search(k: int):
    def run(key, cands, queries):
        import numpy as np
        import pandas as pd

        names = ["query_id", "vec_id", "score"]
        if not len(cands) or not len(queries):
            return pd.DataFrame({x: np.empty(0, "int64") for x in names})
        cid, qid = cands.vec_id.to_numpy(), queries.vec_id.to_numpy()
        q, c, s = search_block(cid, np.stack(cands.v), qid, np.stack(queries.v), k)
        return pd.DataFrame({"query_id": qid[q], "vec_id": cid[c], "score": s})

    return run


def quantised(vectors: DataFrame, scale: int = 64, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v``: whole components floor(scale * x) of the vectors that take part."""
    x = F.col(vector)
    ok = F.coalesce(F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != F.lit(float("inf")))), F.lit(False))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("long"))
    return vectors.where(ok & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), v.alias("v"))


def top_k(rows: DataFrame, is_query, k: int = 20, candidates: int = CANDIDATES, queries: int = QUERIES) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vec_id, v``; ``is_query``: a condition on vec_id."""
    base = written(rows.dropDuplicates(["vec_id", "v"]).withColumn("d", F.size("v")), "topk-vectors")
    asked = base.where(is_query)
    n, m = base.count(), asked.count()
    n_cand, n_query = max(1, math.ceil(n / candidates)), max(1, math.ceil(m / queries))
    block = lambda parts, seed: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(parts)).cast("int")
    c = (base.withColumn("cb", block(n_cand, 1)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1)))))
    q = (asked.withColumn("qb", block(n_query, 2)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_cand - 1)))))
    found = c.groupBy("d", "cb", "qb").cogroup(q.groupBy("d", "cb", "qb")).applyInPandas(_search(k), "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir):
    """op6: the 20 best candidates of every query vector."""
    from opinion_spark.llm.common import table

    return top_k(quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % 20 == 0)


SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, * FROM (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)),
e AS (SELECT r, vec_id, len(v) AS n, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x)::BIGINT AS score
      FROM e q JOIN e c ON q.d = c.d AND q.n = c.n AND q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0 GROUP BY q.r, c.r, 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
