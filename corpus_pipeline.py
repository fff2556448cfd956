"""The training-data pipeline: language ID, toxicity, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; ``run`` writes each result as Parquet in the shared
folder and reads it again for the next. All but the last return the columns of
``docs`` as they came; columns that an operator adds never meet them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opinion_spark.llm import bpe, language, mixing, near, toxicity
from opinion_spark.llm.common import table, written

#: Similarity of word shingles from which the pipeline's documents are copies (op5's own contract is 85).
NEAR_PERCENT = 80


def _where(docs: DataFrame, scored: DataFrame, condition) -> DataFrame:
    """``scored``'s rows that meet the condition, with the columns of ``docs`` (packed into ``_row`` before)."""
    return scored.where(condition).select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def _packed(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_body"))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that have a language; texts in several languages stay, whatever their shares."""
    scored = language.identify(_packed(docs), language.learn_from(docs), ["_row"], text="_body")
    return _where(docs, scored, F.col("lang_pred") != language.UNKNOWN)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents that are not predicted toxic; texts that are null or without words are not."""
    model = toxicity.learn_from(docs, table(spark, sf_dir, "labels"))
    return _where(docs, toxicity.score(_packed(docs), model, ["_row"], text="_body"), F.col("predicted") == 0)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies: that with the smallest id (rows without an id last).

    Groups are of rows, so rows that share an id but not their text both stay, and rows without an id are compared
    like all others. Rows are numbered by the scan of ``docs``, a written table, which numbers them alike every time.
    Null, empty and wordless texts are copies of nothing and stay; an empty table gives an empty table.
    """
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = docs.withColumn(row, F.monotonically_increasing_id())
    found = near.components(rows, NEAR_PERCENT, key=row).select(row, "component_id")
    ids = rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")).alias("_first"))
    groups = found.join(ids, row).groupBy("component_id").agg(F.min("_first").alias("_first"))
    kept = groups.select(F.col("_first.row").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix's whole-document draw says; a source's words come to its target."""
    # ids may repeat or be null, so rows go by a digest; equal rows are interchangeable and share their copies
    rows = docs.withColumn("_row", F.xxhash64("doc_id", F.col("source").isNull(), "source", "text"))
    drawn = mixing.mix(rows, key="_row", whole=True).groupBy("_row").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_of"))
    both = rows.join(drawn.where("_copies > 0"), "_row")
    both = both.withColumn("_place", F.row_number().over(Window.partitionBy("_row").orderBy("_row")).cast("long"))
    times = F.expr("div(_place * _copies, _of) - div((_place - 1) * _copies, _of)").cast("int")
    each = both.withColumn("_times", times).where("_times > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
    return each.select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every document: counts and digests, the ids themselves and the decoded text (null text: as empty, no ids)."""
    return bpe.encode_decode(docs, bpe.vocabulary(), keep_ids=True)


STAGES = [("language_id", languages), ("toxicity", clean), ("near_dedup", distinct_documents), ("mixing", mixed), ("bpe", encoded)]

#: SQL cannot express the learned and seeded stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, keep_ids: bool = False) -> DataFrame:
    """The last stage's table, written in the shared folder; on request with its ``ids`` and ``decoded``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs if keep_ids else docs.drop("ids", "decoded")
