"""Evaluation: confusion, per-class scores, weights, quantiles and drift."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def confusion(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """(truth, predicted, n); a missing prediction is a column of its own, unlabelled rows (-1, null) are masked."""
    masked = df.where(F.col(truth).isNotNull() & (F.col(truth).cast("string") != "-1"))
    return masked.groupBy(F.col(truth).cast("string").alias("truth"), F.coalesce(F.col(pred).cast("string"), F.lit("none")).alias("predicted")).agg(F.count("*").alias("n"))


def class_scores(matrix: DataFrame) -> DataFrame:
    """class, support, predicted, hits, precision, recall and f1 from a confusion matrix; 0 where undefined."""
    t = matrix.groupBy(F.col("truth").alias("class")).agg(F.sum("n").alias("support"))
    p = matrix.groupBy(F.col("predicted").alias("class")).agg(F.sum("n").alias("predicted"))
    h = matrix.where("truth = predicted").select(F.col("truth").alias("class"), F.col("n").alias("hits"))
    s = t.join(p, "class", "full_outer").join(h, "class", "left").fillna(0, ["support", "predicted", "hits"])
    s = s.withColumns({"precision": F.coalesce(F.try_divide("hits", "predicted"), F.lit(0.0)), "recall": F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))})
    return s.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)))


def summary(scores: DataFrame) -> DataFrame:
    """n, accuracy, macro_f1 and balanced_accuracy over classes with support (null without any)."""
    has = F.col("support") > 0
    return scores.agg(F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg(F.when(has, F.col("f1"))).alias("macro_f1"), F.avg(F.when(has, F.col("recall"))).alias("balanced_accuracy"), F.count_if(~has).alias("unsupported"))


def class_weights(df: DataFrame, cls: str, beta: float = 0.99) -> DataFrame:
    """class, n, inverse and effective-number weights, each with mean 1; an empty class counts as one row."""
    n = df.groupBy(F.col(cls).alias("class")).agg(F.greatest(F.lit(1), F.count(cls)).alias("n"))
    raw = n.withColumns({"_i": 1.0 / F.col("n"), "_e": (1 - beta) / (1 - F.pow(F.lit(beta), F.col("n").cast("double")))})
    mean = raw.agg(F.avg("_i").alias("_mi"), F.avg("_e").alias("_me"))
    return raw.crossJoin(mean).select("class", "n", (F.col("_i") / F.col("_mi")).alias("inverse"), (F.col("_e") / F.col("_me")).alias("effective"))  # mean is one row


def mass(df: DataFrame, by: str, weight) -> DataFrame:
    """group, mass and share of the whole."""
    per = df.groupBy(by).agg(F.sum(weight).alias("mass"))
    return per.withColumn("share", F.col("mass") / F.sum("mass").over(W.partitionBy()))


def quantiles(df: DataFrame, by: list[str], value: str, points=(0.5, 0.9, 0.95, 0.99)) -> DataFrame:
    """Nearest-rank quantiles, minimum and maximum."""
    cols = [F.expr(f"percentile_disc({p}) within group (order by {value})").alias(f"p{round(p * 100)}") for p in points]
    return df.groupBy(*by).agg(F.count(value).alias("n"), F.min(value).alias("least"), F.max(value).alias("most"), *cols)


def drift(df: DataFrame, by: str, declared: str, replayed: str, threshold: float, tolerance: float) -> DataFrame:
    """Per stratum: rows, mismatches beyond tolerance, threshold crossings both ways and quantiles of the absolute drift."""
    d = df.withColumn("_d", F.abs(F.col(declared) - F.col(replayed)))
    up = (F.col(declared) < threshold) & (F.col(replayed) >= threshold)
    down = (F.col(declared) >= threshold) & (F.col(replayed) < threshold)
    return d.groupBy(by).agg(F.count("*").alias("n"), F.count_if(F.col("_d") > tolerance).alias("mismatches"), F.count_if(up).alias("crossed_up"), F.count_if(down).alias("crossed_down"), F.expr("percentile_disc(0.5) within group (order by _d)").alias("p50"), F.expr("percentile_disc(0.95) within group (order by _d)").alias("p95"), F.max("_d").alias("most"))


def transitions(df: DataFrame, before: str, after: str) -> DataFrame:
    return df.groupBy(F.concat_ws("->", before, after).alias("transition")).agg(F.count("*").alias("n"))


def digest(df: DataFrame, *columns: str) -> DataFrame:
    """One row: number of rows and a SHA-256 that does not depend on their order.

    Rows are hashed, and hashes are combined by their first 6, 4 and 2 digits in turn, so that a group
    holds a part in 256 ** 3 of the rows, then 256 digests.
    """
    h = df.select(F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256).alias("g"))
    level = h.groupBy("g").agg(F.count("*").alias("n")).select("g", F.concat_ws(":", "g", "n").alias("d"), "n")
    for length in (6, 4, 2, 0):
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("g", "d"))), lambda x: x["d"]), ",")
        level = level.groupBy(F.substring("g", 1, length).alias("g")).agg(joined.alias("j"), F.sum("n").alias("n")).select("g", F.sha2("j", 256).alias("d"), "n")
    return level.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.max("d").alias("digest"))


def heads(df: DataFrame, tasks: dict[str, tuple[str, str, str]]) -> DataFrame:
    """task, truth, predicted, n and the sum of confidence: labels of several heads, each (truth, prediction, confidence), masked ones (-1, null) left out."""
    cells = F.array(*[F.struct(F.lit(t).alias("task"), F.col(a).cast("string").alias("truth"), F.col(b).cast("string").alias("predicted"), F.col(c).cast("double").alias("confidence")) for t, (a, b, c) in tasks.items()])
    flat = df.select(F.explode(cells).alias("x")).select("x.*").where("truth is not null and truth <> '-1'")
    return flat.groupBy("task", "truth", "predicted").agg(F.count("*").alias("n"), F.sum("confidence").alias("confidence"))


def head_scores(cells: DataFrame) -> DataFrame:
    """task, n, accuracy, balanced_accuracy (mean recall of the classes with support) and mean_confidence."""
    per = cells.groupBy("task", "truth").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)).alias("hits"), F.sum("confidence").alias("confidence"))
    return per.groupBy("task").agg(F.sum("support").alias("n"), (F.sum("hits") / F.sum("support")).alias("accuracy"), F.avg(F.col("hits") / F.col("support")).alias("balanced_accuracy"), (F.sum("confidence") / F.sum("support")).alias("mean_confidence"))


def selection_score(scores: DataFrame) -> DataFrame:
    """One row: mean balanced accuracy over the heads."""
    return scores.agg(F.count("*").alias("heads"), F.avg("balanced_accuracy").alias("score"))
