"""Mention classification (C8-C12): which subject a post talks about."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opinion_spark.functions.exprs import null_false, substring_alternation, word_alternation


def mention_pattern(names: list[str], whole_word: bool = False) -> str:
    """Alternation from a name list; unescaped substrings by default (Q3)."""
    return word_alternation(names) if whole_word else substring_alternation(names)


def mention_mask(col: Column, pattern: str) -> Column:
    """Case-insensitive containment; NULL text counts as no match."""
    return null_false(col.rlike("(?i)" + pattern))


def classify_mentions(df: DataFrame, names: dict[str, list[str]], text: str = "tweet",
                      whole_word: bool = False, label_col: str = "tweet_about",
                      none_label: str = "None") -> DataFrame:
    """C9 + C12: per-label masks and an exclusive label column.

    ``names`` maps exactly two labels to name lists. A post gets a label when it
    mentions that side only; otherwise the literal string ``'None'``.
    """
    (la, na), (lb, nb) = list(names.items())
    a = mention_mask(F.col(text), mention_pattern(na, whole_word))
    b = mention_mask(F.col(text), mention_pattern(nb, whole_word))
    return (df.withColumn(f"mentions_{la}", a).withColumn(f"mentions_{lb}", b)
              .withColumn(label_col,
                          F.when(F.col(f"mentions_{la}") & ~F.col(f"mentions_{lb}"), F.lit(la))
                           .when(F.col(f"mentions_{lb}") & ~F.col(f"mentions_{la}"), F.lit(lb))
                           .otherwise(F.lit(none_label))))


def only_label(df: DataFrame, label: str, label_col: str = "tweet_about") -> DataFrame:
    """Posts that mention ``label`` and not the other side."""
    return df.where(F.col(label_col) == label)


def exactly_one(df: DataFrame, labels: list[str], label_col: str = "tweet_about") -> DataFrame:
    """C11: XOR of the two exclusive masks = posts with exactly one side."""
    return df.where(F.col(label_col).isin(labels))
