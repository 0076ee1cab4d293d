"""Votes: mode with a quorum, unanimity, vetoes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import latest


def mode(votes: DataFrame, item: str, verdict: list[str], confidence: str, quorum: int = 2) -> DataFrame:
    """item, the verdict most voted for (ties to the smaller), votes, passes, least confidence of its voters, and whether the quorum is met."""
    per = votes.groupBy(item, *verdict).agg(F.count("*").alias("votes"), F.min(confidence).alias("minimum_confidence"))
    passes = votes.groupBy(item).agg(F.count("*").alias("passes"))
    top = latest(per, [item], F.desc("votes"), *verdict)
    return top.join(passes, item).withColumn("consensus", F.col("votes") >= quorum)


def unanimous(votes: DataFrame, item: str, verdict: str, confidence: str) -> DataFrame:
    """item, verdict (null unless all agree), views and least confidence."""
    agg = votes.groupBy(item).agg(F.count_distinct(verdict).alias("_d"), F.min(verdict).alias("_v"), F.count("*").alias("views"), F.min(confidence).alias("minimum_confidence"))
    return agg.withColumn("verdict", F.when(F.col("_d") == 1, F.col("_v"))).drop("_d", "_v")


def veto(votes: DataFrame, item: str, family: str, verdict: str, background: str) -> DataFrame:
    """item, vetoed (some verdict is not background) and complete (one vote of each family)."""
    families = votes.select(family).distinct().count()
    agg = votes.groupBy(item).agg(F.bool_or(F.col(verdict) != background).alias("vetoed"), F.count("*").alias("n"), F.count_distinct(family).alias("families"))
    return agg.withColumn("complete", (F.col("n") == families) & (F.col("families") == families))
