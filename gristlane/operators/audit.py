"""Audits of evidence: consistency, partitions, exclusions and acceptance."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def queue_decisions(queue: DataFrame, known: DataFrame, key: str, split: str) -> DataFrame:
    """queue with decision (names are fixed values): known rows by their split, all others for the teacher."""
    told = known.groupBy(key).agg(F.min(split).alias("_split"))
    decision = F.when(F.col("_split").isNull(), "teacher_required").when(F.col("_split") == "train", "known_train").otherwise("protected_validation")
    return queue.join(told, key, "left").withColumn("decision", decision).drop("_split")


def consistency(base: DataFrame, others: dict[str, DataFrame], key: str, content: str) -> DataFrame:
    """base with a column for each other list: missing, repeated, other_hash or same, by key and content.

    Each list is counted by key before the join, so a key that repeats costs a row.
    """
    out = base
    for name, rows in others.items():
        one = rows.groupBy(key).agg(F.count("*").alias("_n"), F.min(content).alias("_c"))
        status = F.when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "repeated").when(~F.col(content).eqNullSafe(F.col("_c")), "other_hash").otherwise("same")
        out = out.join(one, key, "left").withColumn(name, status).drop("_n", "_c")
    return out


def partition(whole: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """key and status of every key of whole or a part: the part that holds it, missing, repeated or unexpected."""
    rows = None
    for name, part in parts.items():
        one = part.select(key, F.lit(name).alias("part"))
        rows = one if rows is None else rows.unionByName(one)
    held = rows.groupBy(key).agg(F.count("*").alias("n"), F.min("part").alias("part"))
    both = whole.select(key).distinct().withColumn("_w", F.lit(True)).join(held, key, "full_outer")
    return both.select(key, F.when(F.col("_w").isNull(), "unexpected").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated").otherwise(F.col("part")).alias("status"))


def difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with kind: missing ones of expected and unexpected ones of found, as bags."""
    return expected.exceptAll(found).withColumn("kind", F.lit("missing")).unionByName(found.exceptAll(expected).withColumn("kind", F.lit("unexpected")))


def first_rule(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """df with rule: the name of the first one that holds, else kept; unknown does not hold."""
    rule = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items()], F.lit("kept"))
    return df.withColumn("rule", rule)


def mismatches(wrong: dict[str, Column]) -> Column:
    """Names of what is wrong, sorted and joined by commas."""
    return F.array_join(F.array_compact(F.array(*[F.when(wrong[n], F.lit(n)) for n in sorted(wrong)])), ",")


def accept(df: DataFrame, rules: dict[str, Column], empty: Column) -> DataFrame:
    """df with reasons (sorted) and fate: rejected with any reason, else empty_scene or accepted."""
    reasons = F.array_compact(F.array(*[F.when(rules[n], F.lit(n)) for n in sorted(rules)]))
    fate = F.when(F.size("reasons") > 0, "rejected").when(F.coalesce(empty, F.lit(False)), "empty_scene").otherwise("accepted")
    return df.withColumn("reasons", reasons).withColumn("fate", fate)


def first_valid_box(*boxes: Column) -> tuple[Column, Column]:
    """(box, source) of known and deployed boxes: the first that is given; one without four ordered corners is invalid and never passed over."""
    known, deployed = boxes
    fine = lambda b: (F.size(b) == 4) & (F.get(b, F.lit(2)) > F.get(b, F.lit(0))) & (F.get(b, F.lit(3)) > F.get(b, F.lit(1)))
    given = F.coalesce(known, deployed)
    source = F.when(given.isNull(), "none").when(~F.coalesce(fine(given), F.lit(False)), "invalid").when(known.isNotNull(), "known").otherwise("deployed")
    return F.when(F.coalesce(fine(given), F.lit(False)), given), source


def pending(queue: DataFrame, done: DataFrame, key: str, failed: str) -> DataFrame:
    """Rows of a queue that are not done, or whose results all failed (``again``)."""
    told = done.groupBy(key).agg(F.bool_and(failed).alias("_f"))
    return queue.join(told, key, "left").where("_f is null or _f").withColumn("again", F.col("_f").isNotNull()).drop("_f")


def contract(terms: dict) -> str:
    """SHA-256 of the canonical JSON of what a teacher was told."""
    return hashlib.sha256(json.dumps(terms, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
