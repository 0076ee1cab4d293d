"""Joins: nearest in time, full coverage, upsert, three-way agreement, expected pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import micros


def nearest(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, seconds: int, left_id: str, right_id: str) -> DataFrame:
    """left with the row of right of the same key that is nearest in time, either way, within so many seconds.

    Columns of both keep their names (they must differ, the key apart); ties go to the smaller
    ``right_id``.  Time is cut into buckets as long as the tolerance, so each row meets its own bucket
    and the two beside it: the work follows the rows within reach, not a key's whole history.
    """
    lt, rt = micros(left_ts), micros(right_ts)
    step = seconds * 1_000_000
    a = left.withColumn("_b", F.floor(lt / step)).withColumn("_bucket", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
    b = right.withColumn("_bucket", F.floor(rt / step))
    near = a.join(b, [key, "_bucket"]).withColumn("gap", F.abs(micros(left_ts) - micros(right_ts))).where(F.col("gap") <= step)
    best = near.groupBy(left_id).agg(F.min(F.struct("gap", right_id, *[c for c in right.columns if c not in (key, right_id)])).alias("_m"))
    picked = best.select(left_id, *[F.col(f"_m.{c}").alias(c) for c in ("gap", right_id, *[c for c in right.columns if c not in (key, right_id)])])
    return left.join(picked, left_id, "left")


def coverage(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n_left, n_right and status (both, missing, unexpected, duplicate) of every key on either side."""
    a = left.groupBy(*keys).agg(F.count("*").alias("n_left"))
    b = right.groupBy(*keys).agg(F.count("*").alias("n_right"))
    both = a.join(b, keys, "full_outer").withColumns({"n_left": F.coalesce("n_left", F.lit(0)), "n_right": F.coalesce("n_right", F.lit(0))})
    return both.withColumn("status", F.when(F.col("n_right") == 0, "missing").when(F.col("n_left") == 0, "unexpected").when(F.greatest("n_left", "n_right") > 1, "duplicate").otherwise("both"))


def latest(df: DataFrame, keys: list[str], *order) -> DataFrame:
    """The first row of each key in the given order."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], line: str, columns: list[str], when=None) -> DataFrame:
    """base with columns taken from the last line of updates of its key, where ``when`` holds for that line."""
    last = latest(updates, keys, F.col(line).desc())
    if when is not None:
        last = last.where(when)
    new = last.select(*keys, F.lit(True).alias("updated"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    out = base.join(new, keys, "left").withColumn("updated", F.coalesce("updated", F.lit(False)))
    for c in columns:
        out = out.withColumn(c, F.when(F.col("updated"), F.col(f"_new_{c}")).otherwise(F.col(c))).drop(f"_new_{c}")
    return out


def expected_pairs(rows: DataFrame, judges: DataFrame, votes: DataFrame, row: str, judge: str) -> DataFrame:
    """Coverage of all (row, judge) pairs by votes.  The product is what the audit is about; judges are a handful."""
    return coverage(rows.select(row).distinct().crossJoin(judges.select(judge).distinct()), votes, [row, judge])
