"""Deterministic sampling: ranks by hash, stratified round robin, strides and quotas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize


def ranked(df: DataFrame, by: list[str], *order, column: str = "rank") -> DataFrame:
    return df.withColumn(column, F.row_number().over(W.partitionBy(*by).orderBy(*order)))


def order_hash(seed: str, *parts) -> Column:
    """SHA-256 of seed|part|part as hex: the canonical order of all samplers here."""
    return F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]), 256)


def hash_top_k(df: DataFrame, by: list[str], k: int, seed: str, key: str) -> DataFrame:
    """The k rows of each group that come first by hash; spark cuts each task to k before the shuffle."""
    return ranked(df.withColumn("_h", order_hash(seed, key)), by, "_h", key).where(F.col("rank") <= k).drop("_h")


def capped(df: DataFrame, by: str, rare: list, k: int, seed: str, key: str) -> DataFrame:
    """At most k rows of each group by hash, all rows of rare ones (rank null).

    Only the other groups are ranked, and those are cut to k within each task before the shuffle.
    """
    often = df.where(~F.coalesce(F.col(by).isin(rare), F.lit(False)))
    top = ranked(often.withColumn("_h", order_hash(seed, key)), [by], "_h", key).where(F.col("rank") <= k).drop("_h")
    return top.unionByName(df.where(F.col(by).isin(rare)).withColumn("rank", F.lit(None).cast("int")))


def distinct_capped(df: DataFrame, identity: str, by: list[str], k: int, *order) -> DataFrame:
    """Of rows of equal identity the first in the order, and of those the first k of each group.

    Filling a quota in order and passing over identities already seen gives the same, since the first
    row of an identity is the one that counts.
    """
    return ranked(ranked(df, [identity], *order, column="_seen").where("_seen = 1").drop("_seen"), by, *order).where(F.col("rank") <= k)


def examples(df: DataFrame, n: int, *order) -> DataFrame:
    """The first n rows in a total order: a bounded report."""
    return df.orderBy(*order).limit(n)


def round_robin(df: DataFrame, strata: list[str], n: int, seed: str, key: str, priority=None) -> DataFrame:
    """The first n rows when strata take turns, rows in hash order within a stratum, strata in hash order.

    ``priority``: an expression whose smaller values go first as a whole.
    """
    first = priority if priority is not None else F.lit(0)
    d = df.withColumns({"_p": first, "_h": order_hash(seed, key), "_s": order_hash(seed, *strata)})
    # no stratum can give more than n
    d = ranked(d, ["_p", *strata], "_h", key, column="_turn").where(F.col("_turn") <= n)
    top = d.orderBy("_p", "_turn", "_s", key).limit(n)
    return top.withColumn("position", F.row_number().over(W.orderBy("_p", "_turn", "_s", key))).drop("_p", "_h", "_s").withColumnRenamed("_turn", "turn")


def _ranges(df: DataFrame, *order) -> DataFrame:
    """df as a written table with _run, the range of the order that a row is in.

    Written, because the bounds of ranges are sampled anew whenever a plan runs.
    """
    runs = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return materialize(df.repartitionByRange(runs, *order).withColumn("_run", F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, *order, column: str = "index") -> DataFrame:
    """df with the place of each row in a total order, from 0, without one task that holds them all.

    Rows are dealt into ranges of the first order column; a range's rows are numbered apart and start
    after those of the ranges before.
    """
    d = _ranges(df, *[F.col(o) for o in order])
    counts = d.groupBy("_run").agg(F.count("*").alias("_n"))  # a row a range
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_run", "_before")
    own = d.withColumn("_rn", F.row_number().over(W.partitionBy("_run").orderBy(*order)) - 1)
    return own.join(F.broadcast(before), "_run").withColumn(column, F.col("_before") + F.col("_rn")).drop("_run", "_before", "_rn")


def stride(df: DataFrame, cap: int, *order) -> DataFrame:
    """Rows floor(i * n / cap) of the order for i below cap (all rows if there are fewer), with their index."""
    rows = numbered(df, *order)
    total = df.agg(F.count("*").alias("_total"))
    i = F.ceil(F.col("index") * cap / F.col("_total"))
    # an index is taken if some whole i maps to it
    hit = (F.col("_total") <= cap) | ((i < cap) & (F.floor(i * (F.col("_total") / F.lit(float(cap)))) == F.col("index")))
    return rows.crossJoin(total).where(hit).drop("_total")  # total is one row


def complement(df: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(chosen.select(*keys), keys, "left_anti")


def sampled(df: DataFrame, seed: str, key: str, rate: float) -> DataFrame:
    """Rows whose hash, as a fraction, is below rate."""
    value = F.conv(F.substring(order_hash(seed, key), 1, 13), 16, 10).cast("double") / float(1 << 52)
    return df.where(value < rate)


def cyclic_repeat(df: DataFrame, by: str, target: int, seed: str, key: str) -> DataFrame:
    """Each group's rows in hash order, over and over, up to target rows (``copy`` counts the rounds from 0)."""
    d = ranked(df.withColumn("_h", order_hash(seed, key)), [by], "_h", key).where(F.col("rank") <= target).drop("_h")
    size = d.groupBy(by).agg(F.count("*").alias("_n"))
    out = d.join(size, by).withColumn("copy", F.explode(F.sequence(F.lit(0), F.expr(f"cast(({target} - rank) div _n as int)"))))
    return out.drop("_n")


def quota(df: DataFrame, by: str, n: int, tier: Column, seed: str, key: str) -> DataFrame:
    """n rows of each group: those of the anchor tier (0) up to max(1, n / 5), the rest by tier, then hash."""
    anchors = max(1, n // 5)
    d = df.withColumns({"_t": tier, "_h": order_hash(seed, key)})
    # no tier can give more than n, so that tasks cut to n before the shuffle
    d = ranked(d, [by, "_t"], "_h", key, column="_r").where(F.col("_r") <= n)
    d = d.withColumn("_first", F.when((F.col("_t") == 0) & (F.col("_r") <= anchors), 0).otherwise(F.when(F.col("_t") == 0, 3).otherwise(F.col("_t"))))
    return ranked(d, [by], "_first", "_h", key).where(F.col("rank") <= n).withColumn("tier", F.col("_t")).drop("_t", "_h", "_r", "_first")


def shortages(chosen: DataFrame, by: str, n: int) -> DataFrame:
    return chosen.groupBy(by).agg(F.count("*").alias("got")).withColumn("missing", F.greatest(F.lit(0), F.lit(n) - F.col("got")))


def oldest_first_budget(df: DataFrame, ts: str, size: str, key: str, budget: int, since=None) -> DataFrame:
    """The newest rows whose sizes sum to no more than the budget, by a running sum over ranges of time.

    Rows before ``since`` (a value or column) go first and do not count.
    """
    df = df if since is None else df.where(F.col(ts) >= since)
    d = _ranges(df, F.col(ts).desc(), F.col(key))
    sums = d.groupBy("_run").agg(F.sum(size).alias("_n"))
    before = sums.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_run").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).select("_run", "_before")
    own = d.withColumn("_own", F.sum(size).over(W.partitionBy("_run").orderBy(F.col(ts).desc(), key).rowsBetween(W.unboundedPreceding, 0)))
    return own.join(F.broadcast(before), "_run").withColumn("running", F.col("_before") + F.col("_own")).where(F.col("running") <= budget).drop("_run", "_before", "_own")


def rotating_round_robin(df: DataFrame, base: list[str], value: str, key: str) -> DataFrame:
    """Bases take turns; within a base its values take turns, begun one value later for each base in order.

    A value that is used up is passed over, which keeps the cyclic order, so ranks give the sequence.
    """
    bases = df.select(*base).distinct().withColumn("_i", F.row_number().over(W.orderBy(*base)) - 1)
    values = df.select(*base, value).distinct()
    values = values.withColumns({"_j": F.row_number().over(W.partitionBy(*base).orderBy(value)) - 1, "_k": F.count("*").over(W.partitionBy(*base))})
    order = values.join(bases, base).withColumn("_at", F.pmod(F.col("_j") - F.pmod(F.col("_i"), F.col("_k")), F.col("_k")))
    d = ranked(df, [*base, value], key, column="_r").join(order, [*base, value])
    d = ranked(d, base, "_r", "_at", column="turn")
    return numbered(d, "turn", *base, column="position").drop("_i", "_j", "_k", "_at", "_r")
