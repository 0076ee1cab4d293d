"""Exact duplicates, leakage across partitions and precedence."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialize
from .joins import latest


def conflicts(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Keys whose rows differ in the columns: (key, variants, n)."""
    return df.groupBy(key).agg(F.count_distinct(F.struct(*columns)).alias("variants"), F.count("*").alias("n")).where("variants > 1")


def leakage(df: DataFrame, role: str, *fields: str) -> DataFrame:
    """(field, value, roles, n): values of any of the fields that occur in more than one role."""
    cells = df.select(role, F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("c")).select(role, "c.*").where("value is not null and value <> ''")
    return cells.groupBy("field", "value").agg(F.array_join(F.sort_array(F.collect_set(role)), ",").alias("roles"), F.count("*").alias("n"), F.count_distinct(role).alias("_r")).where("_r > 1").drop("_r")


def content_duplicates(df: DataFrame, content: str, split: str, truth: str, path: str) -> DataFrame:
    """df with fate: cross_split and conflicting_truth groups go as a whole, of others the smallest path stays."""
    per = df.groupBy(content).agg(F.count_distinct(split).alias("_s"), F.count_distinct(truth).alias("_t"), F.min(path).alias("_p"))
    fate = F.when(F.col("_s") > 1, "cross_split").when(F.col("_t") > 1, "conflicting_truth").when(F.col(path) > F.col("_p"), "duplicate").otherwise("kept")
    return df.join(per, content).withColumn("fate", fate).drop("_s", "_t", "_p")


def partition_precedence(df: DataFrame, fields: list[str], partition: str, priority: Column, key: str) -> DataFrame:
    """df with dropped_for: field by field, of the rows that share a value only those of the best partition stay.

    Drops for one field are seen by the next.  Greater priority wins, then the greater name.
    """
    out = df.withColumn("dropped_for", F.lit(None).cast("string"))
    for field in fields:
        live = out.where(F.col("dropped_for").isNull() & F.col(field).isNotNull())
        best = live.groupBy(field).agg(F.max(F.struct(priority.alias("p"), F.col(partition).alias("name"))).alias("_best"), F.count_distinct(partition).alias("_n")).where("_n > 1").select(field, F.col("_best.name").alias("_win"))
        out = out.join(best, field, "left").withColumn("dropped_for", F.when(F.col("dropped_for").isNull() & F.col("_win").isNotNull() & (F.col(partition) != F.col("_win")), F.lit(field)).otherwise(F.col("dropped_for"))).drop("_win")
    return out


def component_winners(df: DataFrame, components: DataFrame, node: str, *order) -> DataFrame:
    """One row of each component: the first in the order; rows on no edge are components of their own."""
    named = df.join(components.withColumnRenamed("node", node), node, "left").withColumn("component", F.coalesce("component", F.col(node)))
    return latest(named, ["component"], *order)


def exclusion_reasons(df: DataFrame, key: str, reasons: dict[str, DataFrame]) -> DataFrame:
    """key, reasons (sorted, joined by commas) and n of rows that one of the frames of keys holds; reasons overlap."""
    tagged = None
    for name, keys in reasons.items():
        one = keys.select(key).distinct().withColumn("reason", F.lit(name))
        tagged = one if tagged is None else tagged.unionByName(one)
    return df.select(key).distinct().join(tagged, key).groupBy(key).agg(F.array_join(F.sort_array(F.collect_set("reason")), ",").alias("reasons"), F.count_distinct("reason").alias("n"))


def _sequence(left: str, right: str):
    """Edges in their order to those that are taken, one after the other."""

    def run(batches):
        gone = set()
        for batch in batches:
            ends = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (left, right, "loser")]
            kept = []
            for i, (a, b, loser) in enumerate(zip(*ends)):
                if a not in gone and b not in gone:
                    gone.add(loser)
                    kept.append(i)
            yield batch.take(pa.array(kept, pa.int64()))

    return run


def greedy_resolution(edges: DataFrame, left: str, right: str, winner: str, *order: str, one_task: int = 1_000_000) -> DataFrame:
    """Edges that cost their other end its place, with that end as ``loser``: edges are taken in the given order, one with a dropped end is passed over, and of any other the end that is not the ``winner`` is dropped.

    The order must tell all edges apart.  In rounds: an edge that is first at both of its ends is
    taken, and all edges at its loser go; those of the winner wait for the next round.  An edge waits
    only for earlier ones that share an end, so the rounds give what the sequence gives.  As soon as at most
    ``one_task`` edges are left (counted first), one task takes them one after the other, which saves the rounds.
    """
    rank = F.struct(*order)
    now, taken = materialize(edges.withColumn("loser", F.when(F.col(winner) == F.col(left), F.col(right)).otherwise(F.col(left))), "edges"), None
    while n := now.limit(one_task + 1).count():
        if n <= one_task:
            rest = materialize(now.coalesce(1).sortWithinPartitions(*order).mapInArrow(_sequence(left, right), now.schema), "taken")
            return rest if taken is None else taken.unionByName(rest)
        first = now.select(rank.alias("r"), F.explode(F.array(left, right)).alias("e")).groupBy("e").agg(F.min("r").alias("m"))
        a, b = first.select(F.col("e").alias(left), F.col("m").alias("ma")), first.select(F.col("e").alias(right), F.col("m").alias("mb"))
        won = materialize(now.join(a, left).join(b, right).where((rank == F.col("ma")) & (rank == F.col("mb"))).select(*now.columns), "taken")
        taken = won if taken is None else taken.unionByName(won)
        gone = won.select(F.col("loser").alias("g")).distinct()
        left_over = now.join(won.select(left, right), [left, right], "left_anti")
        now = materialize(left_over.join(gone, F.col(left) == F.col("g"), "left_anti").join(gone, F.col(right) == F.col("g"), "left_anti"), "edges")
    return taken if taken is not None else now


def reason_counts(df: DataFrame, reasons: str, key: str, examples: int = 100) -> DataFrame:
    """reason, n and the first so many keys in order; a row counts under each of its reasons."""
    one = df.select(key, F.explode(F.array_distinct(reasons)).alias("reason"))
    shown = one.withColumn("_rn", F.row_number().over(W.partitionBy("reason").orderBy(key))).where(F.col("_rn") <= examples)
    shown = shown.groupBy("reason").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_rn", F.col(key).cast("string").alias("k")))), lambda x: x["k"]), ",").alias("examples"))
    return one.groupBy("reason").agg(F.count("*").alias("n")).join(shown, "reason")
