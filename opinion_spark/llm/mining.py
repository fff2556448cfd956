"""Hard negatives by slot-decomposed selection over blocks of anchors.

1. Every block of about ``ANCHORS`` anchors meets every part of about ``PART`` candidates (a stated query set against
   all rows, in blocks), so a task's memory depends on neither table's size. It keeps each anchor's best same-label
   candidates so far (a combiner: at most k rows an anchor leave a task); merging the parts gives the positives.
2. A positive of score p takes negatives from ceil(low * p) to floor(high * p). The windows of one anchor overlap, but
   their upper limits, in falling order, cut the scores into disjoint slots: slot j holds what lies under limit j and
   over limit j + 1. The candidates stream past once more, and the combiner keeps the best k of each slot.
3. A window's best are among the slots from its own limit down, so one pass from the lowest slot upwards, merging
   each slot into the k kept so far, answers all windows; what is under a window's lower limit goes last.

Scores are integer products, exact: float products are used only where every sum stays below 2**53. Scores beyond
64 bits raise an error.

Defined results: rows take part by themselves, so a row that repeats an id is a row of its own (and one of
the "other rows" of its copy); a null label, a null vector, a null or non-finite component or a null id takes no part;
vectors meet only vectors of their own length; ties go to the smaller id; an anchor without a positive, or a positive without a
negative in its window, gives no row; negative scores give empty windows; extra columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import Scratch, table

ANCHORS, PART = 16384, 16384
#: Scores held at once (8 bytes each).
SCORES = 1 << 21


def whole_vectors(rows: DataFrame, scale: int, key: str, vector: str, label: Column) -> DataFrame:
    """``id, label, v``: the rows that take part, components as floor(scale * x)."""
    x = F.col(vector)
    whole = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(float(scale))).cast("long"))
    out = rows.where(F.coalesce(whole, F.lit(False)) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    return out.where("label is not null")


def products(a, b):
    """Exact integer products of the rows of ``a`` and ``b``."""
    import numpy as np

    most = max(1, a.shape[1]) * max(1, int(np.abs(a.astype("float64")).max(initial=0))) * max(1, int(np.abs(b.astype("float64")).max(initial=0)))
    if most < 1 << 52:
        return (a.astype("float64") @ b.astype("float64").T).astype("int64")
    if most < 1 << 62:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    if max(map(abs, exact.ravel()), default=0) >= 1 << 63:
        raise OverflowError("a score exceeds 64 bits")
    return exact.astype("int64")


class Best:
    """The k best (score, then smaller id) of every group, fed with candidates in rising order of ids."""

    def __init__(self, groups: int, k: int):
        import numpy as np

        self.k = k
        self.group, self.score, self.id = (np.empty(0, "int64") for _ in range(3))
        #: a candidate must exceed this to enter: at equal scores the earlier, smaller id stays
        self.floor = np.full(groups, np.iinfo("int64").min)

    def add(self, group, score, ids) -> None:
        import numpy as np

        if not len(group):
            return
        g, s, i = (np.concatenate(x) for x in ((self.group, group), (self.score, score), (self.id, ids)))
        order = np.lexsort((i, -s, g))
        g, s, i = g[order], s[order], i[order]
        start = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        place = np.arange(len(g)) - np.repeat(start, np.diff(np.r_[start, len(g)]))
        keep = place < self.k
        last = place == self.k - 1
        self.floor[g[last]] = s[last]
        self.group, self.score, self.id = g[keep], s[keep], i[keep]



def _matrix(column):
    """The rows of an Arrow list column whose lists have one length."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1 if len(column[0]) else 0)


def _pairs(anchors, candidates):
    """For each vector length: anchors, and candidates by id in batches of SCORES scores (at least one row each)."""
    import numpy as np
    import pyarrow.compute as pc

    if not anchors.num_rows or not candidates.num_rows:
        return
    of = lambda t, d: t.filter(pc.equal(pc.list_value_length(t["v"]), d))
    for d in pc.unique(pc.list_value_length(anchors["v"])).to_pylist():
        a, c = of(anchors, d), of(candidates, d)
        if not len(c):
            continue
        ids, labels, rows, v = c["id"].to_numpy(), c["label"].to_numpy(), c["row"].to_numpy(), _matrix(c["v"])
        order, step = np.argsort(ids, kind="stable"), max(1, SCORES // len(a))
        parts = (order[k:k + step] for k in range(0, len(order), step))
        yield a, _matrix(a["v"]), ((ids[p], labels[p], rows[p], v[p]) for p in parts)


def _answer(anchors, best, k: int):
    """The rows ``anchor, slot, id, score`` of a Best whose groups are anchor * k + slot."""
    import pyarrow as pa

    row = anchors["row"].to_numpy()
    return pa.table({"anchor": row[best.group // k], "slot": (best.group % k).astype("int32"), "id": best.id, "score": best.score})


def _joined(tables: list):
    import pyarrow as pa

    empty = pa.table({"anchor": pa.array([], "int64"), "slot": pa.array([], "int32"), "id": pa.array([], "int64"), "score": pa.array([], "int64")})
    return pa.concat_tables([empty, *tables])


FOUND = "anchor long, slot int, id long, score long"


def _same_label(k: int):
    def run(anchors, candidates):
        import numpy as np

        out = []
        for a, vectors, batches in _pairs(anchors, candidates):
            best, label, own = Best(len(a), k), a["label"].to_numpy()[:, None], a["row"].to_numpy()[:, None]
            for ids, labels, rows, v in batches:
                s = products(vectors, v)
                x, y = np.nonzero((label == labels) & (own != rows) & (s > best.floor[:, None]))
                best.add(x, s[x, y], ids[y])
            out.append(_answer(a, best, 1))
        return _joined(out)

    return run


def _slots(k: int):
    def run(anchors, candidates):
        import numpy as np

        out = []
        for a, vectors, batches in _pairs(anchors, candidates):
            highs, lows = a["high"].to_pylist(), a["low"].to_pylist()
            n = max(map(len, highs))
            least, most = np.iinfo("int64").min, np.iinfo("int64").max
            # slot j: over the next limit, and not under the window's own lower limit, which is the lowest of windows 1 to j
            high = np.array([h + [least] * (n - len(h)) for h in highs])
            low = np.array([x + [most] * (n - len(x)) for x in lows])
            under = np.c_[high[:, 1:], np.full(len(a), least)]
            best, label = Best(len(a) * n, k), a["label"].to_numpy()[:, None]
            for ids, labels, _, v in batches:
                s = products(vectors, v)
                other = label != labels
                found = []
                for j in range(n):
                    over = np.maximum(under[:, j], best.floor[j::n])[:, None]
                    x, y = np.nonzero(other & (s <= high[:, j, None]) & (s >= low[:, j, None]) & (s > over))
                    found.append((x * n + j, s[x, y], ids[y]))
                best.add(*(np.concatenate(f) for f in zip(*found)))
            out.append(_answer(a, best, n))
        return _joined(out)

    return run


def meet(anchors: DataFrame, candidates: DataFrame, blocks: int, parts: int, run) -> DataFrame:
    """``anchor, slot, id, score`` of ``run`` on every block of anchors with every part of candidates."""
    deal = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = anchors.withColumn("block", deal(blocks, 1)).withColumn("part", every(parts))
    # columns renamed to themselves: cogroup mistakes columns that both sides read from one table
    c = candidates.select(*[F.col(x).alias(x) for x in candidates.columns]).withColumn("part", deal(parts, 2)).withColumn("block", every(blocks))
    return a.groupBy("block", "part").cogroup(c.groupBy("block", "part")).applyInArrow(run, FOUND)


def floor_percent(score: Column, percent: int) -> Column:
    """floor(percent / 100 * score) of a whole score, in whole numbers of no more bits than the score's."""
    hundred, rest = F.lit(100).cast("long"), F.pmod(score, F.lit(100).cast("long"))
    return F.call_function("div", score - rest, hundred) * percent + F.call_function("div", rest * percent, hundred)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
         anchors_each: int = ANCHORS, part: int = PART) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` from ``id, label, v``.

    Negatives of a positive with score p: low * p <= 100 * score <= high * p (0 <= low <= high <= 100).
    """
    s = Scratch(rows.sparkSession, "mining")
    # the rows' numbers are written, so they are the same in every later reading
    base = s.written(rows.withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = base.where(is_anchor)
    n, m = base.count(), anchors.count()
    blocks, parts = max(1, math.ceil(m / anchors_each)), max(1, math.ceil(n / part))
    near = meet(anchors, base, blocks, parts, _same_label(positives))
    order = [F.desc("score"), F.asc("id")]
    near = near.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(F.col("place") <= positives)
    # an anchor's positives, best first, and the limits of their windows
    chosen = near.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("p"))
    limits = chosen.select("anchor", "p", F.transform("p.score", lambda x: floor_percent(x, high)).alias("high"), F.transform("p.score", lambda x: -floor_percent(-x, low)).alias("low"))
    asked = s.written(anchors.join(limits.withColumnRenamed("anchor", "row"), "row"), "anchors")
    found = meet(asked.select("id", "label", "v", "row", "high", "low"), base, blocks, parts, _slots(negatives))
    merged = found.withColumn("place", F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(*order))).where(F.col("place") <= negatives)
    # at most positives * negatives entries an anchor, best first in each slot
    entry = F.struct((-F.col("score")).alias("down"), "id", "slot")
    slots = merged.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(entry).alias("found"))
    suffix = F.expr(f"""aggregate(reverse(sequence(0, size(p) - 1)),
        cast(array() as array<struct<best:array<struct<down:bigint,id:bigint,slot:int>>>>),
        (done, j) -> concat(array(struct(slice(array_sort(concat(
            if(size(done) > 0, done[0].best, cast(array() as array<struct<down:bigint,id:bigint,slot:int>>)),
            filter(found, x -> x.slot = j))), 1, {negatives}) as best)), done))""")
    each = asked.select("id", "row", "p", "low").join(slots, "row").withColumn("windows", suffix)
    each = each.select(F.col("id").alias("anchor_id"), F.explode(F.arrays_zip("p", "windows", "low")).alias("w"))
    each = each.select("anchor_id", F.col("w.p").alias("p"), F.posexplode(F.expr("filter(w.windows.best, x -> -x.down >= w.low)")).alias("at", "n"))
    return each.select("anchor_id", F.col("p.id").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"), F.col("n.id").alias("negative_id"),
                       F.col("p.score").alias("positive_score"), (-F.col("n.down")).alias("negative_score"))


def query(spark, sf_dir):
    """op13: three hard negatives for each of the five positives of every fiftieth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), 256, "vec_id", "embedding", label)
    return mine(rows, F.col("id") % 50 == 0)


SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, sum(a.x * c.x)::BIGINT AS score
      FROM e a JOIN e c ON a.d = c.d AND a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""
