"""Every labelled row is learned from, also when they are too many for the driver."""

import numpy as np

from gristlane.llm import quality


def _rows(n=600):
    return [(i, ("the quiet river ran past old stone houses and nobody hurried. " * (1 + i % 3)) + str(i * 7919) if i % 6 else "BUY!!! $$$ CLICK now %d " % i * (2 + i % 4)) for i in range(n)]


def test_all_labels(spark):
    """The means are those of all labelled rows; before, of a sample of ``max_labelled``."""
    docs = spark.createDataFrame(_rows(), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 6 > 0), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    whole, groups = quality.fit(docs, labels), quality.fit(docs, labels, max_labelled=100)
    assert np.allclose(whole.mean, groups.mean) and np.allclose(whole.scale, groups.scale, atol=1e-6)
    got = {r.doc_id: r.predicted for r in quality.scores(docs, labels, max_labelled=100).collect()}
    assert got == {i: int(i % 6 > 0) for i in range(600)}
    again = quality.fit(docs.repartition(5), labels.repartition(3), max_labelled=100)
    assert np.allclose(again.weight, groups.weight, atol=1e-6)


def test_quantiles(spark):
    s = np.random.default_rng(1).normal(size=3001)
    df = spark.createDataFrame([(float(v),) for v in s], "s double")
    assert np.allclose(quality._quantiles(df, len(s), [0, 0.25, 0.5, 1], s.min(), s.max()), np.quantile(s, [0, 0.25, 0.5, 1], method="lower"), atol=1e-9)
