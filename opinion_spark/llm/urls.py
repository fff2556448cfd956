"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact join.

A listed entry is ``host/path``; it covers its host, all subdomains and every
path that starts with its own. A URL can be covered only by the entries made
of a label suffix of its host and a prefix of its path, so these few strings
are looked up: first in the Bloom filter, and what passes in the list itself.

Defined results: a null URL or one without ``://`` has an empty host and path,
no rule and the default verdict; repeated rows are judged alike; of equally
long entries the one with the longer host wins, then the greater text, then
the greater verdict; an empty list or an empty table is no error. Other columns
may have any name; those named like a result are replaced by it.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter for each listed entry; words of 64 bits in a block.
BITS_PER_ENTRY, WORDS = 16, 8
#: Largest filter that is broadcast: 2**18 blocks of 64 bytes (16 MB). A longer
#: list makes it less selective; the exact join still decides.
MAX_BLOCKS = 1 << 18


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return F.translate(part(1), string.ascii_uppercase, string.ascii_lowercase), part(2)


def _hashes(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a key, and in each word of the block one bit."""
    block = F.pmod(F.xxhash64(key), F.lit(blocks))
    h = F.xxhash64(key, F.lit("bits"))
    bits = []
    for w in range(WORDS):
        shift = F.shiftrightunsigned(h, 6 * w).bitwiseAND(F.lit(63)).cast("int")
        bits.append(F.call_function("shiftleft", F.lit(1).cast("long"), shift))
    return block, bits


def bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """Blocked Bloom filter of ``key`` as a table: a block's number and its eight words."""
    block, bits = _hashes(F.col(key), blocks)
    rows = listed.select(block.alias("bloom_block"), *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return rows.groupBy("bloom_block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(rows: DataFrame, key: str, filter_table: DataFrame, blocks: int) -> DataFrame:
    """The rows whose key the filter may hold; the filter has at most MAX_BLOCKS rows, so it is broadcast."""
    block, bits = _hashes(F.col(key), blocks)
    names = [f"_m{i}" for i in range(WORDS)]
    probe = rows.select("*", block.alias("bloom_block"), *[b.alias(n) for b, n in zip(bits, names)])
    hit = F.lit(True)
    for i, n in enumerate(names):
        hit = hit & (F.col(f"w{i}").bitwiseAND(F.col(n)) == F.col(n))
    return probe.join(F.broadcast(filter_table), "bloom_block").where(hit).select(*rows.columns)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict``, in place of columns that have one of these names.

    ``rules``: ``rule`` (``host/path``) and ``verdict``. The distinct (host, path) pairs
    are judged once, so a URL that fills a third of the table costs one row;
    joining the verdict back is an equi-join whose page side can be split.
    """
    spark = pages.sparkSession
    slash = F.instr("rule", "/")
    listed = (rules.where(F.col("rule").isNotNull() & (slash > 1))
              .select("rule", "verdict", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("rule_host"))
              .withColumn("_labels", F.size(F.split("rule_host", r"\.")))
              .withColumn("_chars", F.length("rule") - F.length("rule_host")))
    # kinds of entries: label count and path length, a few integers whatever the list's length
    shapes = sorted(tuple(r) for r in listed.select("_labels", "_chars").distinct().collect())
    n = listed.count()
    blocks = min(MAX_BLOCKS, max(1, math.ceil(n * BITS_PER_ENTRY / (64 * WORDS))))

    host, path = host_and_path(F.col(url))
    keep = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    split = pages.select(*keep, host.alias("host"), path.alias("path"))
    todo = split.select("host", "path").where(F.col("host") != "").distinct()
    if shapes:
        want = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(c).alias("chars")) for n, c in shapes])
        n_labels = F.size(F.split("host", r"\."))
        fits = F.filter(want, lambda k: (k["labels"] <= n_labels) & (k["chars"] <= F.length("path")))
        keys = F.transform(fits, lambda k: F.concat(
            F.call_function("substring_index", F.col("host"), F.lit("."), -k["labels"]),
            F.substring(F.col("path"), F.lit(1), k["chars"])))
        cand = todo.select("host", "path", F.explode(keys).alias("rule"))
    else:
        cand = todo.select("host", "path", F.lit(None).cast("string").alias("rule"))
    maybe = possible(cand, "rule", bloom(listed, "rule", blocks), blocks)
    best = (maybe.join(listed.select("rule", "verdict", "rule_host"), "rule")
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("a"), F.length("rule_host").alias("b"), "rule", "verdict")).alias("_best"))
            .select("host", "path", F.col("_best.rule").alias("rule"), F.col("_best.verdict").alias("verdict")))
    return (split.join(best, ["host", "path"], "left")
            .select(*keep, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))


#: The rules that the registered query applies.
RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
         ("net/es/", "block"), ("net/fr/", "block")]


def query(spark, sf_dir):
    """op10: verdict for every page."""
    from opinion_spark.llm.common import table

    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN NULL
                       ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id, row_number() OVER () AS rid,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
r(rh, rp, v) AS (VALUES ('com','/','allow'), ('example.com','/en/','block'), ('www.example.com','/en/','allow'),
                        ('net','/es/','block'), ('net','/fr/','block')),
m AS (
  SELECT p.rid, rh || rp AS rule, v,
         row_number() OVER (PARTITION BY p.rid ORDER BY length(rh || rp) DESC, length(rh) DESC) AS k
  FROM p JOIN r ON (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(p.path, rp))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM p LEFT JOIN m ON m.rid = p.rid AND m.k = 1
"""
