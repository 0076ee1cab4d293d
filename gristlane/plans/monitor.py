"""Operations analytics over a log of events: value stands for latency, event_type for status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import table


def monitor_summary(spark, sf_dir) -> DataFrame:
    """Counts, share of all, mean, median and nearest-rank 95th percentile per event type."""
    e = table(spark, sf_dir, "events")
    per = e.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.median("value").alias("median_value"), F.expr("percentile_disc(0.95) within group (order by value)").alias("p95_value"), F.count_if(F.col("value") >= 100).alias("slow")
    )
    total = e.agg(F.count("*").alias("total"))
    return per.crossJoin(total).withColumn("rate", F.col("n") / F.col("total")).drop("total")  # total is one row


QUERIES = {"monitor_summary": monitor_summary}
ORACLE_SQL = {
    "monitor_summary": """
        SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, median(value) AS median_value,
               quantile_disc(value, 0.95) AS p95_value, count(*) FILTER (WHERE value >= 100) AS slow,
               count(*) / (SELECT count(*) FROM events)::DOUBLE AS rate
        FROM events GROUP BY event_type"""
}
