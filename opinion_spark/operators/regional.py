"""Regional shares, rebalancing and leads.

All per-region work is one grouped aggregation with conditional counts
(partial aggregation on the map side, so a region holding a third of all posts
costs one buffer row per task). Global ratios are scalar subqueries
(``DataFrame.scalar()``): Spark computes the one-row aggregate once and inlines
it as a value, with no cross join and nothing collected by hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opinion_spark.functions.exprs import safe_div

CLASS_COLS = {0: "n_unsure", 1: "n_dem", 2: "n_rep"}


def frequency_table(df: DataFrame, key: str, count_name: str = "count") -> DataFrame:
    """Value counts of ``key``, NULL keys dropped, most frequent first."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.col(count_name).desc(), F.col(key)))


def lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """R2: dictionary lookup; unmapped keys get NULL (left join; broadcast when Spark finds the dictionary small enough)."""
    dim_key = dim_key or key
    d = dim.withColumnRenamed(dim_key, "_lk") if dim_key != key else dim.withColumnRenamed(key, "_lk")
    return df.join(d, df[key] == d["_lk"], "left").drop("_lk")


def class_pivot(df: DataFrame, region: str = "state", label: str = "likely_party",
                classes: dict[int, str] = CLASS_COLS) -> DataFrame:
    """R3 + R4: region x class counts with fixed classes (absent -> 0) and total."""
    aggs = [F.count_if(F.col(label) == k).cast("long").alias(name) for k, name in classes.items()]
    out = df.where(F.col(region).isNotNull()).groupBy(region).agg(*aggs)
    return out.withColumn("total", sum((F.col(c) for c in classes.values()), F.lit(0)).cast("long"))


def two_class_proportions(df: DataFrame, a: str = "n_dem", b: str = "n_rep",
                          out_a: str = "democratic_proportion",
                          out_b: str = "republican_proportion") -> DataFrame:
    """a/(a+b), b/(a+b); NULL when both are 0."""
    den = F.col(a) + F.col(b)
    return df.withColumns({out_a: safe_div(F.col(a), den), out_b: safe_div(F.col(b), den)})


def share_of_total(df: DataFrame, a: str = "n_dem", b: str = "n_rep", total: str = "total") -> DataFrame:
    """a/total and b/total."""
    return df.withColumns({"dem_share_of_all": safe_div(F.col(a), F.col(total)),
                           "rep_share_of_all": safe_div(F.col(b), F.col(total))})


def class_totals(df: DataFrame, a: str = "n_dem", b: str = "n_rep") -> DataFrame:
    """One row with global class totals and their ratio."""
    return df.agg(F.coalesce(F.sum(a), F.lit(0)).cast("long").alias("total_dem"),
                  F.coalesce(F.sum(b), F.lit(0)).cast("long").alias("total_rep")) \
             .withColumn("tweet_ratio", safe_div(F.col("total_dem"), F.col("total_rep")))


def rebalance(df: DataFrame, a: str = "n_dem", b: str = "n_rep",
              pa: str = "democratic_proportion", pb: str = "republican_proportion",
              renormalize: bool = True) -> DataFrame:
    """R8 (R9 with ``renormalize=False``): scale side B by Σa/Σb.

    With renormalisation both shares are re-divided by their sum and given in
    percent; without it only side B is scaled.
    """
    # a window over the region table (one row a region): the posts below it are processed once
    every = Window.partitionBy(F.lit(0))
    out = df.withColumn("_ratio", safe_div(F.sum(a).over(every), F.sum(b).over(every)))
    scaled_b = F.col(pb) * F.col("_ratio")
    if not renormalize:
        return out.withColumn(pb, scaled_b).drop("_ratio")
    tot = F.col(pa) + scaled_b
    return out.withColumns({pa: F.try_divide(F.col(pa), tot) * 100.0,
                            pb: F.try_divide(scaled_b, tot) * 100.0}).drop("_ratio")


def half_margin_lead(df: DataFrame, pa: str = "democratic_proportion", out: str = "lead_size",
                     full_margin: bool = False) -> DataFrame:
    """lead = share% - 50 (quirk Q5); ``full_margin`` doubles it."""
    lead = F.col(pa) - 50.0
    return df.withColumn(out, lead * 2.0 if full_margin else lead)


def measure_range(df: DataFrame, measure: str) -> DataFrame:
    """Min, max and midpoint of a measure."""
    return df.agg(F.min(measure).alias("min_value"), F.max(measure).alias("max_value")) \
             .withColumn("mid_value", (F.col("min_value") + F.col("max_value")) / 2.0)


def tick_edges(df: DataFrame, measure: str, n: int = 5) -> DataFrame:
    """n+1 equal-width edges min + i(max-min)/n labelled 0%..100%."""
    rng = measure_range(df, measure)
    return (rng.select(F.explode(F.sequence(F.lit(0), F.lit(n))).alias("tick"), "min_value", "max_value")
            .select("tick",
                    (F.col("min_value") + F.col("tick") * (F.col("max_value") - F.col("min_value")) / n)
                    .alias("edge"),
                    F.concat((F.col("tick") * (100 // n)).cast("string"), F.lit("%")).alias("label")))


def lead_category(lead: Column) -> Column:
    """Colour-scale bucket of a signed lead (tie = 0; (0,5], (5,10], >10)."""
    a = F.abs(lead)
    side = F.when(lead > 0, F.lit("A")).otherwise(F.lit("B"))
    band = F.when(a <= 5, F.lit("0-5")).when(a <= 10, F.lit("5-10")).otherwise(F.lit(">10"))
    return F.when(lead.isNull(), F.lit(None)).when(lead == 0, F.lit("tie")).otherwise(F.concat(side, F.lit(" "), band))


def party_totals(df: DataFrame, a: str = "n_dem", b: str = "n_rep") -> DataFrame:
    """Two-row table (party, tweet_count)."""
    t = class_totals(df, a, b)
    return t.unpivot([], ["total_dem", "total_rep"], "party", "tweet_count") \
            .withColumn("party", F.when(F.col("party") == "total_dem", "Democratic").otherwise("Republican"))


def melt(df: DataFrame, ids: list[str], values: list[str], var: str = "party",
         value: str = "count") -> DataFrame:
    """Wide -> long."""
    return df.unpivot(ids, values, var, value)


def sentiment_difference(df: DataFrame, label: str = "likely_party", compound: str = "compound",
                         a: int = 1, b: int = 2) -> DataFrame:
    """(Σ|c| of class a - Σ|c| of class b) / (sum of both)."""
    sa = F.coalesce(F.sum(F.when(F.col(label) == a, F.abs(compound))), F.lit(0.0))
    sb = F.coalesce(F.sum(F.when(F.col(label) == b, F.abs(compound))), F.lit(0.0))
    return df.agg(F.round(F.try_divide(sa - sb, sa + sb), 6).alias("sentiment_difference"))


def first_per_group(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """First non-NULL ``value`` per ``key`` in ``order``."""
    return (df.where(F.col(value).isNotNull()).groupBy(key)
            .agg(F.min_by(value, order).alias(value)))


def joint_frequency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts of (a, b) pairs; rows with a NULL in either are not counted."""
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("count"))


def relative_frequency(df: DataFrame, key: str) -> DataFrame:
    """Share of the non-NULL rows per value; the total is a scalar subquery."""
    total = df.agg(F.count(key)).scalar()
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .select(key, F.round(F.col("n") / total, 9).alias("proportion")))


def second_largest(df: DataFrame, measure: str) -> DataFrame:
    """The 2nd value of the descending order, ties kept (one row -> it)."""
    top2 = df.where(F.col(measure).isNotNull()).orderBy(F.col(measure).desc()).limit(2)
    return top2.agg(F.min(measure).alias("second_largest"))


def activity_weighted(df: DataFrame, wa: float = 0.31, wb: float = 0.69, a: str = "n_dem",
                      b: str = "n_rep") -> DataFrame:
    """wa*a / (wa*a + wb*b) and the complement."""
    da = F.col(a) * wa
    db = F.col(b) * wb
    return df.withColumns({"democratic_proportion": F.try_divide(da, da + db),
                           "republican_proportion": F.try_divide(db, da + db)})


def attach_counts(freq: DataFrame, props: DataFrame, key: str = "state") -> DataFrame:
    """Inner equi-join of a per-region table onto the frequency table.

    Both sides are keyed by region; their size is the number of regions, so
    the join plans as a broadcast once AQE sees the real sizes.
    """
    return freq.join(props, key, "inner")
