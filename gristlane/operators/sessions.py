"""Gap sessions with ids that follow from their members."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import micros


def gap_sessions(df: DataFrame, by: str, ts: str, key: str, seconds: float) -> DataFrame:
    """(by, session_id, n, first, last): runs of rows with no gap longer than so many seconds; rows without a time are alone."""
    timed = df.where(F.col(ts).isNotNull())
    w = W.partitionBy(by).orderBy(ts, key)
    gap = (micros(ts) - F.lag(micros(ts)).over(w)) / 1e6
    marked = timed.withColumn("_new", F.when(gap <= seconds, 0).otherwise(1))
    runs = marked.withColumn("_s", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    named = F.concat(F.lit("session_"), F.substring(F.sha2(F.array_join(F.sort_array(F.collect_list(F.col(key).cast("string"))), ","), 256), 1, 16))
    out = runs.groupBy(by, "_s").agg(named.alias("session_id"), F.count("*").alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")).drop("_s")
    alone = df.where(F.col(ts).isNull()).select(by, F.concat(F.lit("session_"), F.substring(F.sha2(F.col(key).cast("string"), 256), 1, 16)).alias("session_id"), F.lit(1).cast("long").alias("n"), F.col(ts).alias("first"), F.col(ts).alias("last"))
    return out.unionByName(alone)
