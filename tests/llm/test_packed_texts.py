"""Texts that a join of the suffix operator shuffles travel compressed, and come out the same."""

import random

from gristlane.llm import suffixes


def test_shuffled_texts_are_packed(spark, monkeypatch):
    rng = random.Random(2)
    words = ["alpha", "beta", "gämma", "delta", "epsilon"]
    passage = " ".join(rng.choice(words) for _ in range(60))
    rows = [(i, " ".join(rng.choice(words) for _ in range(30)) + (passage if i % 3 else "")) for i in range(40)] + [(40, None), (41, ""), (None, passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, suffixes.digests(docs).collect()))
    monkeypatch.setattr(suffixes, "small", lambda table, **kw: table)
    assert dict(suffixes._with_spans(docs, 100, suffixes.K, pack=True).dtypes)["text"] == "binary"
    assert sorted(map(str, suffixes.digests(docs).collect())) == want
