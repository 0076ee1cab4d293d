"""License scans by diagonal voting.

All rolling word k-gram hashes of the texts are joined to the places where they stand in license
templates.  A hit votes for its diagonal (place in the text less place in the template).  Neighbouring
diagonals are merged, which bears words added or left out, but no further than an eighth of the
template.  A merged diagonal is a span, which is verified word by word: of the hits in order, the
template's words that they cover and the span's words that they cover must both be enough.  Phrases
that name a license are short templates whose diagonal must be whole.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.

Defined cases: a null or empty text has no words, labels or places; rows that repeat an id are rows of
their own; overlapping places of a phrase all count; other columns are not looked at.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .license_texts import PHRASES, TEMPLATES

def _hash(text: str) -> np.ndarray:
    b = W.LOWER[np.frombuffer(text.encode(), np.uint8)]
    s, e, _ = W.split(b, np.array([0, len(b)]), W.NONWORD)
    return W.word_hashes(b, s, e)


def _templates(spark, k: int, templates: dict, phrases: dict) -> DataFrame:
    """(gram, template, label, place, size, whole): the size is that of the constants above."""
    rows = []
    number = 0
    for whole, group in ((False, [(v, key) for key, texts in templates.items() for v in texts]), (True, list(phrases.items()))):
        for text, label in group:
            h = _hash(text)
            width = 2 if whole else k
            for place, g in enumerate(W.grams(h, width).view(np.int64).tolist()):
                rows.append((g, number, label, place, len(h), whole))
            number += 1
    return spark.createDataFrame(rows, "gram long, template int, label string, place int, size int, whole boolean")


def _grams(k: int):
    """text -> a row for each word with the hashes of the pair and the k-gram that begin there; one more of place -1 with the number of words."""

    @W.lean
    def run(batches):
        for batch in batches:
            first = 0
            for _lo, _hi, d, off in W.pieces(batch.column(2)):
                b = W.LOWER[d]
                s, e, at = W.split(b, off, W.NONWORD)
                h = W.word_hashes(b, s, e)
                n = np.diff(at)
                who = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(h)) - np.repeat(at[:-1], n)
                left = n[who] - place
                two, many = np.zeros(len(h), np.int64), np.zeros(len(h), np.int64)
                for width, out in ((2, two), (k, many)):
                    g = W.grams(h, width).view(np.int64)
                    out[: len(g)] = g
                pair = left >= 2
                rows = np.concatenate([who[pair], np.arange(len(n))]) + first
                place = np.concatenate([place[pair], np.full(len(n), -1)]).astype(np.int32)
                two, many = np.concatenate([two[pair], n]), np.concatenate([np.where(left >= k, many, 0)[pair], np.zeros(len(n), np.int64)])
                pick = pa.array(rows)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pick), batch.column(1).take(pick), pa.array(place), pa.array(two), pa.array(many)], ["doc_id", "row", "place", "two", "many"])
                first += len(n)

    return run


def hits(docs: DataFrame, k: int = 4, templates: dict | None = None, phrases: dict | None = None) -> DataFrame:
    """Rows (row, doc_id, place, two, many, and what of the templates they hit) of hits; place -1 has a row's number of words in ``two``.

    ``row`` tells the rows apart.
    """
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    kind = docs.schema["doc_id"].dataType.simpleString()
    t = _templates(spark, k, templates or TEMPLATES, phrases or PHRASES)
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), "text")
    flat = rows.mapInArrow(_grams(k), f"doc_id {kind}, row long, place int, two long, many long")
    long_ = t.where("not whole").select(F.col("gram").alias("many"), "template", "label", F.col("place").alias("at"), "size")
    short = t.where("whole").select(F.col("gram").alias("two"), F.struct(F.col("template").alias("template"), F.col("label").alias("label"), F.col("place").alias("at"), F.col("size").alias("size")).alias("p"))
    # both sides are the constants above
    return flat.join(F.broadcast(long_), "many", "left").join(F.broadcast(short), "two", "left").where("place < 0 or template is not null or p is not null")


def labels(docs: DataFrame, k: int = 4, drift: int = 3, cover: float = 0.6) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row.

    ``drift``: diagonals this near are merged.  ``cover``: share of a template's words, and of a span's, that its hits must hold.
    """
    hit = hits(docs, k)
    sizes = F.max(F.when(F.col("place") < 0, F.col("two")))
    vote = lambda template, at, size: F.struct(template.alias("template"), (F.col("place") - at).alias("diagonal"), at.alias("at"), size.alias("size"))
    long_ = F.when(F.col("template").isNotNull() & (F.col("place") >= 0), vote(F.col("template"), F.col("at"), F.col("size")))
    short = F.when(F.col("p").isNotNull() & (F.col("place") >= 0), vote(F.col("p.template"), F.col("p.at"), F.col("p.size")))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # the hits of one text, a few words of license each: no more than its own words times the templates' repeats
    per = hit.groupBy("row").agg(F.first("doc_id").alias("doc_id"), sizes.alias("n_words"), F.collect_set(long_).alias("long"), F.collect_set(short).alias("short"))
    named = dict(enumerate([*(label for label, texts in TEMPLATES.items() for _ in texts), *PHRASES.values()]))
    return per.select("doc_id", "n_words", "long", "short").mapInArrow(_vote(k, drift, cover, named), f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _rising(at: np.ndarray) -> np.ndarray:
    """Places of a longest strictly rising run of values, not necessarily next to one another."""
    ends: list[int] = []  # the smallest value that a run of each length ends with
    where: list[int] = []
    back = np.full(len(at), -1)
    for i, v in enumerate(at.tolist()):
        n = bisect_left(ends, v)
        ends[n : n + 1], where[n : n + 1] = [v], [i]
        back[i] = where[n - 1] if n else -1
    out, i = [], where[-1] if where else -1
    while i >= 0:
        out.append(i)
        i = int(back[i])
    return np.array(out[::-1], int)


def _covered(starts: np.ndarray, k: int) -> int:
    """Words that rising runs of k words cover."""
    return int(np.minimum(np.diff(starts), k).sum() + k) if len(starts) else 0


def spans(template: np.ndarray, diagonal: np.ndarray, at: np.ndarray, sizes: np.ndarray, k: int, drift: int, cover: float) -> list[tuple[int, int, int, float]]:
    """(template, start, end, share) of the verified spans that the hits of one text add up to."""
    order = np.lexsort((at, diagonal, template))
    template, diagonal, at, sizes = template[order], diagonal[order], at[order], sizes[order]
    out = []
    # runs of neighbouring diagonals, then cut where a run is wider than the template allows
    edge = np.flatnonzero(np.concatenate([[True], (template[1:] != template[:-1]) | (diagonal[1:] - diagonal[:-1] > drift), [True]]))
    for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        size = int(sizes[lo])
        reach = max(drift, size // 8)
        while lo < hi:
            end = lo + int(np.searchsorted(diagonal[lo:hi], diagonal[lo] + reach, "right"))
            if (end - lo) * k >= cover * size:  # fewer hits cannot cover enough
                place = diagonal[lo:end] + at[lo:end]
                by = np.lexsort((-at[lo:end], place))
                picked = by[_rising(at[lo:end][by])]
                mine, here = at[lo:end][picked], place[picked]
                share = min(_covered(mine, k) / size, _covered(here, k) / (int(here[-1] - here[0]) + k))
                if share >= cover:
                    out.append((int(template[lo]), int(here[0]), int(here[-1]) + k, share))
            lo = end
    return out


def _vote(k: int, drift: int, cover: float, names_of: dict[int, str]):
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]

    def columns(listed: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
        """Offsets and the fields of a list of structs."""
        listed = listed.combine_chunks() if isinstance(listed, pa.ChunkedArray) else listed
        off = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(listed), 0).to_numpy(zero_copy_only=False))]).astype(int)
        flat = listed.flatten()
        return off, [f.to_numpy(zero_copy_only=False).astype(np.int64) for f in flat.flatten()]

    @W.lean
    def run(batches):
        for batch in batches:
            rows = [[] for _ in names[1:]]
            lo, (lt, ld, la, ls) = columns(batch.column(2))
            so, (st, sd, sa, ss) = columns(batch.column(3))
            for i, n in enumerate(batch.column(1).to_pylist()):
                # a phrase is whole where all of its pairs vote for one diagonal
                a, b = so[i], so[i + 1]
                whole, count = np.unique(np.stack([st[a:b], sd[a:b], ss[a:b]]), axis=1, return_counts=True) if b > a else (np.zeros((3, 0), int), np.zeros(0, int))
                whole = whole[:, count == whole[2] - 1]
                a, b = lo[i], lo[i + 1]
                found = spans(lt[a:b], ld[a:b], la[a:b], ls[a:b], k, drift, cover) if b > a else []
                named = sorted({names_of[t] for t in whole[0].tolist()})
                every = sorted({*named, *(names_of[s[0]] for s in found)})
                places = whole[1].tolist()
                best = max([1.0] * bool(places) + [s[3] for s in found], default=0.0)
                for x, v in zip(rows, (n, len(places), min(places, default=None), max(places, default=None), ",".join(named), ",".join(every), best), strict=True):
                    x.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, t) for r, t in zip(rows, kinds, strict=True))], names)

    return run
