"""A corpus pipeline of five stages; each one reads what its predecessor wrote.

Near duplicates are judged on five-word shingles at a similarity of 0.8.  All stages: an empty table
gives an empty one; columns besides doc_id, text, source and n_chars are carried along, whatever their
names; rows that repeat an id are judged each by their own text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristlane.llm import decontam, jaccard, mixing, quality, suffixes
from gristlane.session import discard, scratch, shared_path
from gristlane.sources.tables import table


def quality_filter(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject (a score of 0.3 stays); it learns from the labels of its own input.

    A null or empty text is scored as one without words; without labels of both kinds nothing is rejected.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"), at=0.3)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return quality.score(docs, model, out=name).where(F.col(name) >= 0.3).drop(name)


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id, a null one before all, then of the smallest text hash.

    Texts without a word are no duplicates of one another and all stay; of rows that repeat id and text one stays.
    """
    return jaccard.survivors(docs, k=5, num=80, den=100)


def repeated_spans(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the spans of 100 bytes or more that start earlier in the corpus, by id, then place; n_chars follows.

    A null text stays null and has no n_chars; a text that is removed as a whole is empty.
    """
    return suffixes.remove(docs, width=100).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[F.col(f"`{c}`") for c in docs.columns])


def decontaminate(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than one word in twenty stands in a benchmark window; one in twenty is too many.

    A null or empty text is clean; benchmark items without words or id hit nothing.
    """
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixture of sources; a null source is one of its own.

    Columns named as the added ones (block_no, place, slot, position, release, due) are replaced.
    """
    return mixing.schedule(docs, power=0.7, block=16)


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_spans),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
]

#: A trained score has no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str) -> DataFrame:
    """All stages over documents, with a written table between two stages; a stage's own intermediate tables, and its input, go when it has ended."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            discard(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
