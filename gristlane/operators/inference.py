"""Hook for models: whole Arrow batches in, typed columns out."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame


def predict(df: DataFrame, load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], schema: str) -> DataFrame:
    """df run through a model that ``load`` makes once a task; rows already done are left out beforehand by an anti join."""

    def run(batches):
        model = load()
        for batch in batches:
            yield model(batch)

    return df.mapInPandas(run, schema)


def remaining(queue: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a queue without a finished result."""
    return queue.join(done.select(*keys), keys, "left_anti")
