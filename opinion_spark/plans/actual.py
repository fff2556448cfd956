"""Entry C: actual results, prediction-vs-actual and prior reweighting."""

from __future__ import annotations

from pyspark.sql import DataFrame

from opinion_spark.operators import votes


def actual_lead(precinct: DataFrame, cand_a: str, cand_b: str) -> DataFrame:
    return votes.state_votes(precinct, cand_a, cand_b)


def compare(precinct: DataFrame, predicted: DataFrame, cand_a: str, cand_b: str) -> DataFrame:
    """Per-region actual lead next to the predicted one."""
    return votes.lead_difference(actual_lead(precinct, cand_a, cand_b), predicted)


def prior_reweighted(shares: DataFrame, history: DataFrame, office: str, held_out_year: int,
                     parties=("DEMOCRAT", "REPUBLICAN")) -> DataFrame:
    """Un-rebalanced shares reweighted by the historical prior."""
    prior = votes.two_party_prior(votes.history_filter(history, parties, office, held_out_year))
    return votes.prior_weighted(shares, prior)
