"""Cleaning and de-duplication of posts.

Input order matters for "keep first" semantics, so every source carries an
ordinal ``_ord``, a struct of source index and row order. Dedup is a
``row_number() = 1`` window: Spark plans it with a map-side
``WindowGroupLimit`` so duplicates are dropped before the shuffle, and the
survivor is the first row in input order rather than an arbitrary one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.functions.exprs import NONSPACE_CLASS, WS_CLASS

ORD = "_ord"


def tag_source(df: DataFrame, name: str, col: str = "source") -> DataFrame:
    """Constant source tag."""
    return df.withColumn(col, F.lit(name))


def ordinal(source_index: Column, row_order: Column) -> Column:
    """Input order: structs compare field by field, so no packing can overflow."""
    return F.struct(source_index.cast("long").alias("source"), row_order.alias("row"))


def with_ordinal(df: DataFrame, source_index: int | Column, row_order: Column | None = None) -> DataFrame:
    """Attach ``_ord`` = (source index, row order).

    ``row_order`` defaults to (file, start of the split, row in it), taken right
    at the scan: Spark packs files into partitions by size, so the row id alone
    would not follow their order.
    """
    row = row_order
    if row is None:
        row = F.struct(F.input_file_name().alias("file"), F.input_file_block_start().alias("start"),
                       F.monotonically_increasing_id().alias("id"))
    src = source_index if isinstance(source_index, Column) else F.lit(source_index)
    return df.withColumn(ORD, ordinal(src, row))


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Bag union by column name; columns missing on one side become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: list[str], order: str = ORD) -> DataFrame:
    """One row per key, the first in input order (not an arbitrary one)."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def distinct_rows(df: DataFrame, order: str = ORD) -> DataFrame:
    """Full-row distinct over the data columns, first occurrence kept."""
    keys = [c for c in df.columns if c != order]
    return keep_first(df, keys, order)


def replace_urls(col: Column, placeholder: str = "[]") -> Column:
    """C4: every ``http`` run up to whitespace becomes the placeholder."""
    return F.regexp_replace(col, "http" + NONSPACE_CLASS + "+", placeholder)


def strip_urls(col: Column) -> Column:
    """Remove ``http``/``www`` runs (the ``https`` branch is subsumed)."""
    return F.regexp_replace(col, "http" + NONSPACE_CLASS + "+|www" + NONSPACE_CLASS + "+", "")


def normalize_text(col: Column) -> Column:
    """Lower-case and collapse whitespace runs to one space."""
    return F.regexp_replace(F.lower(col), WS_CLASS + "+", " ")


def keep_regions(df: DataFrame, regions: DataFrame, col: str = "state",
                 region_col: str = "state") -> DataFrame:
    """Membership filter as a left-semi join (broadcast when Spark finds the list small enough)."""
    dim = regions.select(F.col(region_col).alias("_region")).where(F.col("_region").isNotNull())
    return df.join(dim, df[col] == dim["_region"], "left_semi")


def clean_posts(df: DataFrame, text: str = "tweet", *, regions: DataFrame | None = None,
                state_col: str = "state", normalize_case: bool = False,
                order: str = ORD) -> DataFrame:
    """C3 + C4 + C5 (+ C7) + C6 in the reference order.

    Full-row distinct followed by keep-first on the cleaned text equals a single
    keep-first on the cleaned text (full-row copies share that text and the
    first copy survives both), so one shuffle does both. Dedup runs before the
    region filter (quirk Q4).
    """
    out = df.withColumn(text, replace_urls(F.col(text)))
    if normalize_case:
        out = out.withColumn(text, normalize_text(F.col(text)))
    out = keep_first(out, [text], order)  # NULL texts are equal: the first stays
    if regions is not None:
        out = keep_regions(out, regions, state_col)
    return out


def add_score_columns(df: DataFrame) -> DataFrame:
    """Default-valued score columns."""
    return df.withColumns({
        "positive": F.lit(0.0), "neutral": F.lit(0.0), "negative": F.lit(0.0),
        "compound": F.lit(0.0), "likely_party": F.lit(0),
    })


def condition_counts(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """C15 for stages that are filters of one table: all counted in one pass."""
    counts = df.agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])
    return counts.unpivot([], list(conditions), "stage", "n_rows")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One row per named stage with its row count, as one DataFrame.

    Each stage is counted by its own global aggregate (partial counts per
    partition, one tiny final merge); the union keeps it a single job.
    """
    parts = [d.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("stage"), "n_rows")
             for name, d in stages.items()]
    return union_sources(parts)
