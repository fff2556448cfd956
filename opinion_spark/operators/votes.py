"""Actual results, historical priors and prediction-vs-actual.

Vote rows are reduced by grouped aggregation first (partial aggregation on
the map side), and every later step works on those per-region rows, whose
count is the number of regions, never the number of vote records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.functions.exprs import safe_div


def state_votes(precinct: DataFrame, cand_a: str, cand_b: str, region: str = "state_po",
                candidate: str = "candidate", votes: str = "votes") -> DataFrame:
    """V1-V4: votes of two named candidates, total over all, pct and lead.

    Conditional sums replace an open-ended pivot; rows with a NULL region or
    candidate are dropped as a grouped sum would drop them.
    """
    v = F.col(votes).cast("long")
    agg = (precinct.where(F.col(region).isNotNull() & F.col(candidate).isNotNull())
           .groupBy(region)
           .agg(F.coalesce(F.sum(F.when(F.col(candidate) == cand_a, v)), F.lit(0)).alias("votes_a"),
                F.coalesce(F.sum(F.when(F.col(candidate) == cand_b, v)), F.lit(0)).alias("votes_b"),
                F.coalesce(F.sum(v), F.lit(0)).alias("total_votes")))
    return agg.withColumns({
        "biden_pct": safe_div(F.col("votes_a"), F.col("total_votes")) * 100.0,
        "democratic_proportion": safe_div(F.col("votes_a"), F.col("total_votes")),
        "lead_size": safe_div(F.col("votes_a") - F.col("votes_b"), F.col("total_votes")) * 100.0,
    })


def national_margin(votes_df: DataFrame) -> DataFrame:
    """V5: |x - y| / (x + y) * 100 over the per-region totals."""
    x = F.sum("votes_b")
    y = F.sum("votes_a")
    return votes_df.agg(x.alias("votes_b"), y.alias("votes_a")).select(
        "votes_a", "votes_b",
        (safe_div(F.abs(F.col("votes_b") - F.col("votes_a")), F.col("votes_b") + F.col("votes_a")) * 100.0)
        .alias("national_margin"))


def lead_difference(actual: DataFrame, predicted: DataFrame, actual_key: str = "state_po",
                    predicted_key: str = "state_code") -> DataFrame:
    """J2 + V6: left join actual onto predicted; diff = actual - predicted lead."""
    p = predicted.select(F.col(predicted_key).alias("_pk"),
                         F.col("democratic_proportion").alias("predicted_democratic_proportion"),
                         F.col("republican_proportion").alias("predicted_republican_proportion"),
                         F.col("lead_size").alias("predicted_lead"))
    a = actual.withColumnRenamed("lead_size", "actual_lead") \
              .withColumnRenamed("democratic_proportion", "actual_democratic_proportion")
    j = a.join(p, a[actual_key] == p["_pk"], "left").drop("_pk")
    return j.withColumn("lead_size_diff", F.col("actual_lead") - F.col("predicted_lead"))


def markers(diffs: DataFrame, centers: DataFrame, key: str = "state_po",
            center_key: str = "state_code") -> DataFrame:
    """J4 + V7: one marker per region with a centre and a non-NULL diff.

    |diff| < 1 is clamped to +-1 (0 -> +1); colour by sign; size =
    min(|d|/2, 10); font = 2 * size; glyph up / down; label "{st}: {d:.1f}%".
    """
    c = centers.withColumnRenamed(center_key, "_ck")
    j = diffs.where(F.col("lead_size_diff").isNotNull()).join(c, F.col(key) == F.col("_ck"), "inner")
    d = F.col("lead_size_diff")
    clamped = F.when((d < 1) & (d >= 0), F.lit(1.0)).when((d > -1) & (d <= 0), F.lit(-1.0)).otherwise(d)
    j = j.withColumn("diff", clamped)
    size = F.least(F.abs("diff") * 0.5, F.lit(10.0))
    return j.select(
        F.col(key).alias("state_po"), "lat", "lon", "diff",
        F.when(F.col("diff") > 0, "blue").otherwise("red").alias("color"),
        F.when(F.col("diff") > 0, "▲").otherwise("▼").alias("glyph"),
        F.format_string("%s: %.1f%%", F.col(key), F.col("diff")).alias("label"),
        size.alias("size"), (size * 2).alias("font"))


def history_filter(history: DataFrame, parties=("DEMOCRAT", "REPUBLICAN"), office: str = "US PRESIDENT",
                   held_out_year: int = 2020) -> DataFrame:
    """V8: two parties, one office, held-out year removed (pushed to the scan)."""
    return history.where(F.col("party_detailed").isin(list(parties)) & (F.col("office") == office)
                         & (F.col("year") != held_out_year))


def two_party_prior(history: DataFrame) -> DataFrame:
    """V9 + V10: mean over rows of votes / Σvotes of its (year, state).

    Computed exactly as Σ_year(Σ votes / T_year) / n_rows per (state, party):
    the rows are first summed per (year, state, party) with a map-side
    partial aggregate, and the (year, state) total is a window over that small
    table instead of over every vote record.
    """
    g = (history.groupBy("year", "state", "state_po", "party_detailed")
         .agg(F.sum("candidatevotes").alias("_v"), F.count("candidatevotes").alias("_n")))
    t = g.withColumn("_t", F.sum("_v").over(Window.partitionBy("year", "state")))
    share = safe_div(F.col("_v"), F.col("_t"))  # rows without a share do not enter the mean
    return (t.groupBy("state", "state_po", "party_detailed")
            .agg(safe_div(F.sum(share), F.sum(F.when(share.isNotNull(), F.col("_n")))).alias("ratio")))


def year_shares(history: DataFrame) -> DataFrame:
    """V9 alone at the (year, state, party) grain: share of the two-party vote."""
    g = history.groupBy("year", "state", "state_po", "party_detailed").agg(F.sum("candidatevotes").alias("votes"))
    return g.withColumn("share", safe_div(F.col("votes"), F.sum("votes").over(Window.partitionBy("year", "state"))))


def prior_weighted(shares: DataFrame, prior: DataFrame, how: str = "inner",
                   party_a: str = "DEMOCRAT", party_b: str = "REPUBLICAN") -> DataFrame:
    """J3 + V11: d*p_d / (d*p_d + r*p_r) with the prior pivoted per state.

    ``how='inner'`` drops regions without a prior (the reference raises).
    """
    p = (prior.groupBy("state")
         .agg(F.max(F.when(F.col("party_detailed") == party_a, F.col("ratio"))).alias("_pa"),
              F.max(F.when(F.col("party_detailed") == party_b, F.col("ratio"))).alias("_pb")))
    j = shares.join(p, F.upper(shares["state"]) == p["state"], how).drop(p["state"])
    da = F.col("_pa") * F.col("democratic_proportion")
    db = F.col("_pb") * F.col("republican_proportion")
    return j.withColumns({"democratic_proportion": F.try_divide(da, da + db),
                          "republican_proportion": F.try_divide(db, da + db)}).drop("_pa", "_pb")


def drill_down(df: DataFrame, state: str, col: str = "state") -> DataFrame:
    """One region's rows."""
    return df.where(F.col(col) == state)
