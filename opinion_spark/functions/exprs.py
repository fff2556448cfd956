"""Column-expression helpers shared by the operators.

Everything here returns a ``Column`` built from JVM-side functions, so it
stays inside whole-stage codegen and never leaves the executor.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode-aware classes written out explicitly: Java's and RE2's ``\w`` /
# ``\s`` are ASCII-only, Python's are Unicode; these spell the Python meaning
# so results agree across engines.
WORD_CLASS = r"[\p{L}\p{N}_]"
_SPACES = (r" \t\n\r\f\x0b\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
           r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_CLASS = f"[{_SPACES}]"
NONSPACE_CLASS = f"[^{_SPACES}]"


def safe_div(num: Column, den: Column) -> Column:
    """x / y as double, NULL when y is 0 or NULL (pandas gives NaN / inf)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def null_false(cond: Column) -> Column:
    """A predicate whose NULL counts as false (``na=False``)."""
    return F.coalesce(cond, F.lit(False))


def substring_alternation(names: list[str]) -> str:
    """Unescaped ``a|b|c`` alternation, exactly as written (quirk Q3)."""
    return "|".join(names)


def word_alternation(names: list[str]) -> str:
    """Escaped whole-word alternation.

    Word edges are spelled with the Unicode word class instead of ``\\b``
    (Java's ``\\b`` is Unicode-aware, RE2's is ASCII-only), so ``les`` does
    not match inside ``éles`` in any engine.
    """
    body = "|".join(re.escape(n) for n in names)
    return f"(^|[^\\p{{L}}\\p{{N}}_])({body})([^\\p{{L}}\\p{{N}}_]|$)"


def spread(df):
    """Give CPU-heavy per-row work at least one partition per core.

    A scan of few large files can arrive as fewer partitions than the cluster
    has cores; only then is it round-robin repartitioned. On a big input the
    scan already has more splits than cores and this is a no-op (no shuffle).
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df
