"""Threshold-scaled sketches: DataFrame functions only.

A document's fingerprint is every hash of its 5-word shingles in the lowest
``1/SCALE`` of the hash range. It grows with the text, so the share of one
sketch found in another estimates containment even when the texts' lengths
differ by orders of magnitude, and the sketch of a union is the union of the
sketches. A text with words but no hash that low keeps its smallest one; on
merging, such a lone hash goes as soon as a low one is there.

Likeness is the share of the smaller sketch found in the larger.

The query needs each document's successor by id. Rows are dealt to ranges of ids
whose bounds are percentiles; each range also gets the first row of the next
one, so one partitioned window finds every successor.

Defined results: null text is empty, and has an empty fingerprint; two texts without words
are alike (1), one without and one with words are not (0); ids that are null come last;
rows that repeat an id are ordered by text; a single row is its own successor; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import table

SCALE, SHINGLE = 4, 5
_LOW = -(1 << 63) + (1 << 64) // SCALE
_LAST = (1 << 63) - 1


def add_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the sorted sketch of column ``text`` as ``out``."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    n = F.size("_words")
    hashed = F.transform(F.sequence(F.lit(0), F.greatest(n - SHINGLE, F.lit(0))),
                         lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(SHINGLE)]))
    low = F.array_sort(F.array_distinct(F.filter("_shingles", lambda h: h < F.lit(_LOW))))
    step = df.withColumn("_words", words)
    step = step.withColumn("_hashes", F.transform("_words", lambda w: F.xxhash64(w)))
    # under five words, the missing places are null: the whole sequence is one shingle
    step = step.withColumn("_shingles", F.when(n == 0, F.array().cast("array<bigint>")).otherwise(hashed)).drop("_words", "_hashes")
    step = step.withColumn(out, low)
    return step.withColumn(out, F.when((F.size(out) == 0) & (F.size("_shingles") > 0), F.array(F.array_min("_shingles"))).otherwise(F.col(out))).drop("_shingles")


def merge(a: Column, b: Column) -> Column:
    """Sketch of the two texts' shingles together."""
    both = F.array_sort(F.array_union(a, b))
    low = F.filter(both, lambda h: h < F.lit(_LOW))
    return F.when(F.size(low) > 0, low).otherwise(F.slice(both, 1, 1))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    least, most = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    return F.when(most == 0, F.lit(1.0)).when(least == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / least)


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def _range_of(value: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at or below the value, by binary search."""
    if not bounds:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    b = F.array(*[F.lit(x).cast("long") for x in bounds])
    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, s: F.when(
        (at + s <= len(bounds)) & (F.get(b, at + s - 1) <= value), at + s).otherwise(at))


def with_next(df: DataFrame, key: str, tie: str, carry: list[str], ranges: int) -> DataFrame:
    """``df`` with ``next_<c>`` of the successor by ``key`` for each carried column."""
    rows = df.withColumn("_ord", F.coalesce(F.col(key).cast("long"), F.lit(_LAST)))
    found = rows.agg(F.percentile_approx("_ord", [(i + 1) / ranges for i in range(ranges - 1)] or [0.5], 10 * ranges)).first()[0]
    bounds = sorted(set(found or [])) if ranges > 1 else []
    rows = rows.withColumn("_range", _range_of(F.col("_ord"), bounds))
    # at most ``ranges`` rows: the first id of each range, which the range before also needs
    firsts = sorted(tuple(r) for r in rows.groupBy("_range").agg(F.min("_ord")).collect())
    if not firsts:
        return rows.select(*df.columns, *[F.col(c).alias(f"next_{c}") for c in carry])
    borrow = [(first, firsts[k - 1][0]) for k, (_, first) in enumerate(firsts)]
    borrow = df.sparkSession.createDataFrame(borrow, "_ord long, _to int")
    lent = rows.join(F.broadcast(borrow), "_ord").withColumn("_range", F.col("_to")).drop("_to").withColumn("_lent", F.lit(True))
    w = Window.partitionBy("_range").orderBy("_lent", "_ord", tie)
    every = rows.withColumn("_lent", F.lit(False)).unionByName(lent)
    every = every.withColumns({f"next_{c}": F.lead(c).over(w) for c in carry})
    return every.where(~F.col("_lent")).drop("_lent", "_ord", "_range")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likeness and the next document's."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = add_sketch(rows, "_text", "_sketch")
    ranges = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_next(rows, "_key", "_text", ["_text", "_sketch"], ranges)
    rows = rows.withColumn("n_chars", F.length("_text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next__text"), F.lit(1), cut))
    rows = add_sketch(rows.withColumn("_edited", edited), "_edited", "_edited_sketch")
    return rows.select(F.col("_key").alias(key), "n_chars", F.sha2("_edited", 256).alias("edited_sha256"),
                       as_text(F.col("_sketch")).alias("fingerprint"), as_text(F.col("_edited_sketch")).alias("edited_fingerprint"),
                       likeness(F.col("_sketch"), F.col("_edited_sketch")).alias("near_edited"),
                       likeness(F.col("_sketch"), F.col("next__sketch")).alias("near_next"))


def query(spark, sf_dir):
    """op8: the fingerprint of every document."""
    return fingerprints(table(spark, sf_dir, "documents"))
