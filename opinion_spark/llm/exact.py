"""Exact deduplication by a 128-bit content hash, with collisions excluded by their bytes.

1. Every text is normalised (each run of ASCII white space becomes one space) and hashed to 128 bits.
2. Bytes are compared where texts share a hash: an aggregation over (hash, text) lets Spark's own hash
   table compare the bytes, after copies have met in each map task, so that a group of any size sends one
   copy per task. A hash with several texts is a collision; its texts get a number, by which its rows are told apart.
3. Sizes and survivors are aggregated over (hash, number), again copies first in each map task, and go back to
   the rows. At most ``HOT_GROUPS`` groups can each hold more than that part of all rows; these are broadcast, and
   only rows of other groups are shuffled. No group is collected, and no text but one copy of each per task moves.

Defined results: a null text counts as empty; white space is not trimmed, only shortened; of rows that repeat the
smallest id of a group one stays; an id that is null comes after all others, and a group of such rows keeps one
of them, with a null ``keep_id``; extra columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.llm.common import Scratch, table

#: A group is hot with more than 1 / HOT_GROUPS of all rows, so there are fewer hot groups than this.
HOT_GROUPS = 10_000


def normalised(text: Column) -> Column:
    """The text with each run of ASCII white space as one space; null: empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    """128 bits of a text's UTF-8 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def repeated_hashes(hashed: DataFrame) -> DataFrame:
    """``hash`` of every hash that more than one text has: bytes are compared by the aggregation's hash table."""
    texts = hashed.groupBy("hash", "body").agg(F.count(F.lit(1)).alias("_copies"))
    return texts.groupBy("hash").agg(F.count(F.lit(1)).alias("_texts")).where("_texts > 1").select("hash")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", hashing: Callable[[Column], Column] = content_hash, hot_groups: int = HOT_GROUPS) -> DataFrame:
    """``key, keep_id, group_size, kept, text_sha256`` of every row; ``hashing`` maps a text to a hash."""
    s = Scratch(docs.sparkSession, "exact")
    hashed = docs.select(F.col(key).alias("id"), normalised(F.col(text)).alias("body")).withColumn("hash", hashing(F.col("body")))
    sha = F.unhex(F.sha2(F.col("body").cast("binary"), 256)).alias("sha")
    collided = s.written(repeated_hashes(hashed), "collided")
    plain = hashed.withColumn("variant", F.lit(0))
    if not collided.isEmpty():
        apart = hashed.join(collided, "hash", "left_semi").groupBy("hash", "body").agg(F.count(F.lit(1)).alias("_copies"))
        number = F.row_number().over(Window.partitionBy("hash").orderBy("body")).alias("variant")
        apart = apart.select("hash", "body", number)
        plain = plain.join(collided, "hash", "left_anti").unionByName(hashed.join(apart, ["hash", "body"]))
    # the rows' numbers are written, so they are the same in every later reading
    rows = s.written(plain.select("id", "hash", "variant", sha, F.monotonically_increasing_id().alias("row")), "rows")
    total = rows.count()
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))
    groups = rows.groupBy("hash", "variant").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first")).where("group_size > 1")
    groups = s.written(groups.select("hash", "variant", "group_size", F.col("first.id").alias("keep_id"), F.col("first.row").alias("keep_row")), "groups")
    hot = groups.where(F.col("group_size") * hot_groups > total)
    on = ["hash", "variant"]
    in_hot = rows.join(F.broadcast(hot), on)
    others = rows.join(F.broadcast(hot.select(*on)), on, "left_anti").join(groups, on, "left")
    out = in_hot.unionByName(others)
    alone = F.col("group_size").isNull()
    return out.select(
        F.col("id").alias(key), F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col("row") == F.col("keep_row"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def query(spark, sf_dir):
    """op12: every document's group of equal texts."""
    return deduplicate(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
FROM d WINDOW w AS (PARTITION BY body)
"""
