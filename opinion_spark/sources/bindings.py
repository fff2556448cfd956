"""Bindings of the analysis' roles to the driver's tables.

The driver supplies no posts, states or vote files; each role is derived from
the given tables by Spark, over whole tables and whole texts:

* post  = ``documents`` row: ``tweet`` = full ``text``, ``source`` = its
  ``source`` tag, input order = (source number, ``doc_id``);
* state = the nation of the post's author (customer ``c_custkey = doc_id``);
  the region filter keeps nations of regions 0-3;
* state code = ``'N' || n_nationkey``;
* precinct votes = ``orders`` x ``customer`` x ``nation``: state_po = code,
  candidate = ``o_orderstatus``, votes = ``bigint(o_totalprice)``;
* vote history = same join: year = ``year(o_orderdate)``, party =
  ``o_orderstatus`` (F = DEMOCRAT, O = REPUBLICAN, P = other), office =
  ``o_orderpriority`` ('1-URGENT' = presidential);
* short posts (similarity, topics end to end) = the turns of
  ``conversations``; their language is that of the document ``conv_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opinion_spark.functions.exprs import spread
from opinion_spark.operators.cleaning import ORD, with_ordinal

# --- fixed values: the roles' parameters on the driver tables ---
MENTION_NAMES = {"trump": ["the", "and"], "biden": ["les", "des"]}
LEXICON = {"the": 1.2, "and": -0.8, "of": 0.5, "to": -1.1, "is": 1.9, "in": -0.4,
           "de": 0.9, "la": -1.3, "der": 0.7, "die": -0.6}
IDIOMS = {"attion to": 2.5, "in the": -2.0, "la de": 1.4, "of the": -1.7, "to thanedble the": 0.8, "a the": -0.9, "that the": 0.0, "de la": 1.1}
KEPT_REGIONS = [0, 1, 2, 3]
CANDIDATE_A = "F"  # plays the side-A candidate (democratic share)
CANDIDATE_B = "O"
PARTY_OF_STATUS = {"F": "DEMOCRAT", "O": "REPUBLICAN", "P": "OTHER"}
PRESIDENT_OFFICE = "1-URGENT"
HELD_OUT_YEAR = 2001
CONVERSATION_IDS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post table: ``doc_id, tweet, source, state, _ord``.

    A post's author is the customer with ``c_custkey = doc_id``; its state is
    the author's nation (posts without an author have no state, like posts
    without a location, and are dropped by the region filter).
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    src_no = F.regexp_extract("source", r"(\d+)$", 1).cast("long")
    out = (docs.join(cust, docs.doc_id == cust.c_custkey, "left")
           .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
           .select("doc_id", F.col("text").alias("tweet"), "source", F.col("n_name").alias("state")))
    return with_ordinal(out, src_no, F.col("doc_id"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region membership list (plays the 51-state list)."""
    return (table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(KEPT_REGIONS))
            .select(F.col("n_name").alias("state")))


def state_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """state -> state_code for every nation."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("state"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_code"))


def state_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map centres for the kept regions only (a dimension with gaps, like DC)."""
    n = table(spark, sf_dir, "nation").where(F.col("n_regionkey").isin(KEPT_REGIONS))
    return n.select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("state_code"),
                    (F.col("n_nationkey") * 1.5 + 20.0).alias("lat"),
                    (F.col("n_regionkey") * -10.0 - 70.0).alias("lon"))


def precinct_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``state_po, candidate, votes`` rows (one per order)."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("state_po"),
                    F.col("o_orderstatus").alias("candidate"),
                    F.floor("o_totalprice").cast("long").alias("votes")))


def vote_history(spark: SparkSession, sf_dir: str, parties: tuple[str, ...] | None = None) -> DataFrame:
    """``year, state, state_po, office, party_detailed, candidatevotes`` rows.

    ``parties`` filters on the status behind the party, which the scan can skip by.
    """
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    if parties is not None:
        o = o.where(F.col("o_orderstatus").isin([s for s, p in PARTY_OF_STATUS.items() if p in parties]))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    party = None
    for status, name in PARTY_OF_STATUS.items():
        cond = F.col("o_orderstatus") == status
        party = F.when(cond, F.lit(name)) if party is None else party.when(cond, F.lit(name))
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "inner")
            .select(F.year("o_orderdate").alias("year"),
                    F.upper("n_name").alias("state"),
                    F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("state_po"),
                    F.col("o_orderpriority").alias("office"),
                    party.alias("party_detailed"),
                    F.floor("o_totalprice").cast("long").alias("candidatevotes")))


def short_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short posts for similarity: every turn of every conversation, whole.

    ``doc_id`` = ``conv_id * CONVERSATION_IDS + turn``.
    """
    t = table(spark, sf_dir, "conversations")
    return t.select((F.col("conv_id") * CONVERSATION_IDS + F.col("turn")).alias("doc_id"), "text")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for similarity and topics: ``doc_id, text`` (whole texts)."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


__all__ = ["ORD", "posts", "regions", "state_codes", "state_centers", "precinct_votes",
           "vote_history", "docs", "table"]
