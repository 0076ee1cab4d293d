"""Streaming forms of the log analytics, over folders of files."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files: int = 64) -> DataFrame:
    """A folder as a stream, so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).format(fmt).load(path)


def usage(events: DataFrame, ts: str, by: str, length: str = "24 hours", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Counts and sums by window and kind; rows later than the watermark are left out."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    return events.withWatermark(ts, late).groupBy(w, by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, ts: str, by: str, gap: str, late: str = "1 hour") -> DataFrame:
    """Gap sessions of a stream; a gap of exactly the length does not split."""
    s = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap), by).agg(F.count("*").alias("n"))
    return s.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def cooldown(events: DataFrame, by: str, ts: str, failed: str, seconds: float = 300.0) -> DataFrame:
    """(by, ts, failed, cooling): whether a provider failed within so many seconds before, across batches.

    The state of a provider is the time of its last failure.  Rows of a trigger are taken in order of time;
    a row that comes in a later trigger than a younger one sees failures up to its own time only if they were the last.
    """
    kinds = dict(events.dtypes)

    def run(key, batches, state):
        last = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches)).sort_values(ts, kind="stable")
        at = pdf[ts].astype("datetime64[us]").astype("int64") / 1e6
        fail = at.where(pdf[failed].astype(bool)).ffill().shift()
        fail = fail if last is None else fail.fillna(last).where(lambda x: x >= last, last)
        gap = at - fail
        newest = at[pdf[failed].astype(bool)].max()
        if pd.notna(newest):
            state.update((float(newest if last is None else max(newest, last)),))
        yield pd.DataFrame({by: key[0], ts: pdf[ts], failed: pdf[failed], "cooling": (gap > 0) & (gap <= seconds)})

    out = f"{by} {kinds[by]}, {ts} {kinds[ts]}, {failed} boolean, cooling boolean"
    return events.groupBy(by).applyInPandasWithState(run, out, "last double", "append", GroupStateTimeout.NoTimeout)


def into(df: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Run a stream to a parquet folder until the files at hand are read."""
    return df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).option("path", path).trigger(availableNow=True).start()
