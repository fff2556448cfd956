"""Mixing sources to target weights: Sainte-Lague apportionment of equal blocks.

1. Targets: the sources, by code point with null last, have weights that
   repeat; they share ``share`` times all words by weight, none above
   ``ceiling`` times its own size, the excess going to the others by weight.
2. Quotas: words are dealt in blocks of ``block`` words. A source takes a seat
   for each quotient target / (2 q + 1) of at least half a block, which is the
   Sainte-Lague allocation of as many blocks as that makes.
3. Shards: a large source is cut into at most ``MAX_SHARDS`` hash shards of
   about ``SHARD_WORDS`` words, and its quota is dealt to them by highest
   quotients of their sizes (a heap over a bounded list).
4. Selection: the documents of a shard in seeded order are one word stream, cut
   into n blocks. Of a quota of Q blocks, block b is taken
   floor(((b+1) Q + u) / n) - floor((b Q + u) / n) times, u a seeded start: Q in
   all, evenly spread, each floor(Q/n) or ceil(Q/n) times. A document's words
   follow from the blocks at its two ends and the count between, so nothing is
   exploded.
5. Whole documents, on request: the documents of a shard, largest first, are
   drawn systematically at the rate of the shard's quota to its size, u again a
   seeded start, so each gets floor or ceil of that rate copies, in expectation the
   rate itself. In falling order of size the copies' words differ from the quota
   by less than the shard's largest document.

Defined results: null text has size 0 and takes 0; a source of size 0 has
target 0; documents that repeat an id are separate documents; an empty table
gives an empty table. Equal sort keys (repeated rows) are interchangeable.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import WORD, written

SHARD_WORDS, MAX_SHARDS = 1 << 20, 4096


def sainte_lague(votes: list[float], seats: int, most: list[int] | None = None) -> list[int]:
    """Seats by highest quotients votes / (2 q + 1); ties go to the earlier entry; none gets over ``most``.

    Starts from a divisor that gives no entry more than its final seats and
    deals the rest with a heap, so it costs the list's length, not the seats.
    """
    total, most = sum(votes), most or [seats] * len(votes)
    if total <= 0 or seats <= 0:
        return [0] * len(votes)
    spare = seats - len(votes)
    got = [min(m, int(v * spare / total + 0.5)) if spare > 0 else 0 for v, m in zip(votes, most)]
    heap = [(-v / (2 * g + 1), i) for i, (v, g) in enumerate(zip(votes, got)) if v > 0 and g < most[i]]
    heapq.heapify(heap)
    left = seats - sum(got)
    while left > 0 and heap:
        _, i = heap[0]
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heapreplace(heap, (-votes[i] / (2 * got[i] + 1), i))
        else:
            heapq.heappop(heap)
    return got


def targets(sizes: DataFrame, weights: tuple = (3, 1, 2), share: float = 1.5, ceiling: int = 2) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``.

    Each round is one aggregate of the source table: sources above their
    ceiling stay there and the rest share what is left, until none is above.
    """
    spark = sizes.sparkSession
    order = sizes.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    ranked = written(spark.createDataFrame(order, "source string, source_size long, rank long"), "mix-sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    src = ranked.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(ceiling)).alias("cap"))
    words = src.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words for each unit of weight; sources whose ceiling lies below are full
    while words:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        r = src.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not r[1] or (new := (share * words - r[0]) / r[1]) <= level:
            break
        level = new
    return src.select("source", "source_size", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def _deal(block: int, ceiling: int):
    def run(pdf):
        pdf = pdf.sort_values("shard")
        most = [ceiling * -(-int(x) // block) for x in pdf.shard_size]
        pdf["quota"] = sainte_lague([float(x) for x in pdf.shard_size], int(pdf.source_quota.iloc[0]), most)
        return pdf[["source", "shard", "shard_size", "quota"]]

    return run


def mix(docs: DataFrame, seed: int = 7, block: int = 4, share: float = 1.5, weights: tuple = (3, 1, 2),
        ceiling: int = 2, key: str = "doc_id", text: str = "text", source: str = "source", whole: bool = False) -> DataFrame:
    """``key, source, size, source_size, target, taken`` of every document and, with ``whole``, its number of ``copies``."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    base = written(docs.select(F.col(key).alias("_key"), F.col(source).cast("string").alias("source"), size.alias("size")), "mix-sizes")
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(sizes, weights, share, ceiling).withColumns({
        "quota": F.floor(F.col("target") / F.lit(float(block)) + F.lit(0.5)),
        "shards": F.least(F.lit(MAX_SHARDS), F.ceil((F.col("source_size") + 1) / F.lit(SHARD_WORDS))).cast("int")})
    goal = written(goal, "mix-goal")

    tag = F.xxhash64(F.lit(seed), F.col("_key"), F.col("size"))
    g = goal.select(F.col("source").alias("_s"), "source_size", "target", "quota", "shards")
    placed = (base.join(g, base.source.eqNullSafe(g["_s"])).drop("_s")
              .withColumn("_tag", tag).withColumn("shard", F.pmod(F.col("_tag"), F.col("shards")).cast("int")))
    totals = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("quota").alias("source_quota"))
    dealt = totals.groupBy("source").applyInPandas(_deal(block, ceiling), "source string, shard int, shard_size long, quota long")
    d = dealt.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "shard_size", F.col("quota").alias("shard_quota"))
    joined = placed.join(d, (placed.shard == d["_h"]) & placed.source.eqNullSafe(d["_s"])).drop("_s", "_h")

    w = Window.partitionBy("source", "shard").orderBy("_tag", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = joined.withColumn("_end", F.sum("size").over(w)).withColumn("_start", F.col("_end") - F.col("size"))
    n = F.ceil(F.col("shard_size") / F.lit(block))
    start = F.pmod(F.xxhash64(F.lit(seed), F.col("source"), F.col("shard")), F.greatest(n, F.lit(1)))

    def before(b: Column) -> Column:
        """Blocks taken before block b, repeats counted."""
        return F.call_function("div", b * F.col("shard_quota") + F.col("_u"), F.col("_n"))

    def words(x: Column) -> Column:
        """Words taken of the first x words of the shard's stream."""
        b = F.call_function("div", x, F.lit(block).cast("long"))
        return before(b) * block + (x - b * block) * (before(b + 1) - before(b)) - before(F.lit(0).cast("long")) * block

    rows = rows.withColumns({"_n": F.greatest(n, F.lit(1)), "_u": start})
    taken = F.when(F.col("size") == 0, F.lit(0).cast("long")).otherwise(words(F.col("_end")) - words(F.col("_start")))
    out = [F.col("_key").alias(key), "source", "size", "source_size", "target", taken.alias("taken")]
    if whole:
        largest = Window.partitionBy("source", "shard").orderBy(F.desc("size"), "_tag", "_key")
        rows = rows.withColumn("_place", F.row_number().over(largest).cast("long"))
        ends = F.greatest(F.col("shard_size"), F.lit(1))
        quota = F.least(F.col("shard_quota") * block, F.col("shard_size") * ceiling)  # the last block may be short
        begin = F.pmod(F.xxhash64(F.lit(seed), F.lit("whole"), F.col("source"), F.col("shard")), ends)
        drawn = lambda i: F.call_function("div", i * quota + begin, ends)
        out.append(F.when(F.col("size") == 0, 0).otherwise(drawn(F.col("_place")) - drawn(F.col("_place") - 1)).cast("long").alias("copies"))
    return rows.select(*out)


def query(spark, sf_dir):
    """op4: how many words of each document the mix takes."""
    from opinion_spark.llm.common import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
