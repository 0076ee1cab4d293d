"""Benchmark decontamination by winnowing, in DataFrame functions only.

Item words are cut into windows.  Of every window of a text the smallest k-gram hash is kept, so a
text that holds a window holds its fingerprint at the same place: every shared span as long as a
window shares one.  Document fingerprints meet the items' fingerprints in one equi-join; what is
found extends to whole windows, whose words are compared by their
64-bit hashes.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased.

Defined cases: a null or empty text has no words and is never contaminated; an item without words
has no window; an item of fewer words than a window is one window; rows that repeat a document id
are judged each by their own text; rows that repeat an item id are one item with the windows of all;
a null item id is left out, since the list of hits could not name it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType

from ..session import materialize
from .sizes import small

#: ASCII that separates words, each put to a blank beside A-Z to a-z
_SEPARATORS = "".join(chr(c) for c in range(1, 128) if not chr(c).isalnum() and c != 32)
#: bits of a packed fingerprint that hold the place; the rest hold the hash
PLACE = 27
#: distinct fingerprints of the benchmark (16 bytes each) that are sent to every executor; more are joined by a shuffle
BROADCAST = 1_000_000


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a null."""
    # \\x00 has no place in translate's dictionary (it would delete), so it is replaced first
    plain = F.translate(F.replace(F.coalesce(text, F.lit("")), F.lit("\x00"), F.lit(" ")), string.ascii_uppercase + _SEPARATORS, string.ascii_lowercase + " " * len(_SEPARATORS))
    return F.filter(F.split(plain, " "), lambda w: w != "")


def let(value: Column, then) -> Column:
    """then(value) with the value computed once: inside a lambda a plain expression would be computed for every element."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _grams(h: Column, k: int) -> Column:
    """Hash of the k hashes from each place on (places past the end have nulls, which hash on)."""
    return F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + j) for j in range(1, k)]))


def _later(a: Column, step: int) -> Column:
    return F.transform(a, lambda x, i: F.least(x, F.get(a, i + step)))


def _sliding_min(a: Column, width: int, done: int = 1) -> Column:
    """Smallest of each run of ``width`` (shorter at the end), by doubling."""
    if done >= width:
        return a
    step = min(done, width - done)
    return let(_later(a, step), lambda b: _sliding_min(b, width, done + step))


def fingerprints(h: Column, window: int, k: int) -> Column:
    """Distinct packed (hash, place) of the smallest k-gram in each run of ``window`` of word hashes h."""

    def picked(h: Column) -> Column:
        n = F.size(h)
        grams = F.transform(F.slice(_grams(h, k), 1, F.greatest(n - k + 1, F.lit(0))), lambda x, i: F.shiftleft(F.shiftright(x, PLACE), PLACE) + i)
        least = let(grams, lambda g: _sliding_min(g, window - k + 1))
        return F.array_distinct(F.slice(least, 1, F.greatest(n - window + 1, F.lit(0))))

    return let(h, picked)


def _windows(bench: DataFrame, window: int, k: int) -> DataFrame:
    """item_id, len and the word hashes h of every window."""
    w = bench.where("item_id is not null").select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    w = w.withColumn("len", F.least(F.size("w"), F.lit(window)))
    w = w.select("item_id", "len", F.explode(let(F.col("w"), lambda v: F.transform(F.sequence(F.lit(1), F.size(v) - F.col("len") + 1), lambda i: F.slice(v, i, F.col("len"))))).alias("w"))
    w = w.select("item_id", "len", F.transform("w", lambda x: F.xxhash64(x)).alias("h"))
    return w.distinct()


def _pick(h: Column, length: int, k: int) -> Column:
    """The one packed fingerprint of a window."""
    return F.get(fingerprints(h, length, min(k, length)), F.lit(0))


def hits(docs: DataFrame, bench: DataFrame, window: int = 13, k: int = 5) -> tuple[DataFrame, DataFrame]:
    """(texts, found): (doc_id, thash, n_words) of every row, and (doc_id, thash, item_id, start, len) of every occurrence."""
    grid = materialize(_windows(bench, window, k), "windows")
    # window lengths below ``window`` come from short items: at most window - 1 of them
    lengths = sorted(r[0] for r in grid.select("len").distinct().collect())
    keyed = None
    for n in lengths:
        part = grid.where(F.col("len") == n).withColumn("fp", _pick(F.col("h"), n, k))
        keyed = part if keyed is None else keyed.unionByName(part)
    base = docs.select("doc_id", "text").withColumn("thash", F.xxhash64("text"))
    if keyed is None:
        texts = base.select("doc_id", "thash", F.size(words(F.col("text"))).cast("long").alias("n_words"))
        return texts, texts.limit(0).select("doc_id", "thash", F.lit(None).cast(bench.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("len"))
    keyed = keyed.withColumn("at", F.expr(f"cast(fp & {(1 << PLACE) - 1} as int)")).withColumn("fp", F.shiftright("fp", PLACE) * 16 + F.col("len"))
    keyed = materialize(keyed.select("item_id", "len", "h", "fp", "at"), "keyed")
    fps = keyed.select("fp").distinct()
    few = fps.count() <= BROADCAST

    def packed(h: Column, n: int) -> Column:
        wide = window - min(k, n)  # words before a fingerprint that its window may begin with

        def one(p: Column) -> Column:
            place = (p % (1 << PLACE)).cast("int")
            place = F.when(place < 0, place + (1 << PLACE)).otherwise(place)
            low = F.greatest(place - wide, F.lit(0))
            near = F.slice(h, low + 1, place - low + n) if few else F.lit(None).cast("array<bigint>")
            return F.struct((F.shiftright(p, PLACE) * 16 + n).alias("fp"), place.cast("long").alias("p"), near.alias("near"))

        return F.transform(fingerprints(h, n, min(k, n)), one)

    h = F.transform(words(F.col("text")), lambda w: F.xxhash64(w))
    size = lambda h: F.array(F.struct(F.lit(None).cast("long").alias("fp"), F.size(h).cast("long").alias("p"), F.lit(None).cast("array<bigint>").alias("near")))
    flat = base.select("doc_id", "thash", F.explode(let(h, lambda h: F.concat(size(h), *[packed(h, n) for n in lengths]))).alias("x"))
    flat = flat.select("doc_id", "thash", "x.fp", "x.p", "x.near")
    known = fps.withColumn("known", F.lit(True))
    seen = flat.join(F.broadcast(known) if few else known, "fp", "left").where("fp is null or known").drop("known")
    seen = materialize(seen, "seen")
    texts = seen.where("fp is null").select("doc_id", "thash", F.col("p").alias("n_words"))

    # A fingerprint extends to each window that has it at some place, and the hashes of all its words are compared.
    hit = seen.where("fp is not null").distinct() if few else _again(base, seen.where("fp is not null").select("doc_id", "thash", "fp", "p").distinct(), window, k)
    hit = hit.join(keyed.select("fp", "len", "at", F.col("h").alias("want"), "item_id"), "fp").withColumn("start", F.col("p").cast("int") - F.col("at")).where("start >= 0")
    low = F.greatest(F.col("p").cast("int") - (window - F.least(F.lit(k), F.col("len"))), F.lit(0))
    hit = hit.where(F.slice("near", F.col("start") - low + 1, F.col("len")) == F.col("want"))
    return texts, materialize(hit.select("doc_id", "thash", "item_id", "start", "len").distinct(), "found")


def _again(base: DataFrame, spots: DataFrame, window: int, k: int) -> DataFrame:
    """spots (doc_id, thash, fp, p) with the hashes of the words near each, from a second reading of their texts."""
    # of one text, so no more than its own fingerprints
    per = materialize(spots.groupBy("doc_id", "thash").agg(F.collect_list(F.struct("fp", "p")).alias("at")), "spots").select(F.col("doc_id").alias("d"), F.col("thash").alias("t"), "at")
    rows = base.join(per, F.col("doc_id").eqNullSafe(F.col("d")) & F.col("thash").eqNullSafe(F.col("t"))).select("doc_id", "thash", F.transform(words(F.col("text")), lambda w: F.xxhash64(w)).alias("h"), "at")

    def one(h: Column, a: Column) -> Column:
        low = F.greatest(a["p"].cast("int") - (window - F.least(F.lit(k), (a["fp"] % 16 + 16) % 16)).cast("int"), F.lit(0))
        return F.struct(a["fp"].alias("fp"), a["p"].alias("p"), F.slice(h, low + 1, a["p"].cast("int") - low + window).alias("near"))

    return rows.select("doc_id", "thash", F.explode(let(F.col("h"), lambda h: F.transform("at", lambda a: one(h, a)))).alias("x")).select("doc_id", "thash", "x.fp", "x.p", "x.near").distinct()


def judged(texts: DataFrame, found: DataFrame, times: int = 20) -> DataFrame:
    """The result of ``contamination`` with thash, from the result of ``hits``."""
    # covered words: places below the furthest end so far are counted once
    places = found.groupBy("doc_id", "thash", "start").agg(F.max("len").alias("len"))
    sorted_ = places.groupBy("doc_id", "thash").agg(F.sort_array(F.collect_list(F.struct("start", "len"))).alias("s"))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def add(acc, x):
        end = (x["start"] + x["len"]).cast("long")
        return F.struct((acc["n"] + F.greatest(end - F.greatest(acc["end"], x["start"].cast("long")), F.lit(0).cast("long"))).alias("n"), F.greatest(acc["end"], end).alias("end"))

    n_hit = sorted_.select("doc_id", "thash", F.aggregate("s", zero, add)["n"].alias("n_hit"))
    items = found.groupBy("doc_id", "thash").agg(F.sort_array(F.collect_set(F.col("item_id").cast(StringType()))).alias("ids"))
    per = n_hit.join(items, (n_hit["doc_id"].eqNullSafe(items["doc_id"])) & (n_hit["thash"] == items["thash"])).select(n_hit["doc_id"].alias("h_doc"), n_hit["thash"].alias("h_hash"), "n_hit", "ids")
    out = texts.join(per, texts["doc_id"].eqNullSafe(F.col("h_doc")) & (texts["thash"] == F.col("h_hash")), "left")
    n = F.coalesce("n_hit", F.lit(0).cast(LongType()))
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return out.select(
        "doc_id", "thash", "n_words", n.alias("n_hit"), F.size(ids).cast(LongType()).alias("n_items"), F.sha2(F.array_join(ids, ",").cast("binary"), 256).alias("items_sha256"), ((n > 0) & (times * n >= F.col("n_words"))).alias("contaminated")
    )


def contamination(docs: DataFrame, bench: DataFrame, window: int = 13, k: int = 5, times: int = 20) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated (n_hit > 0 and times * n_hit >= n_words) of every row."""
    return judged(*hits(docs, bench, window, k), times).drop("thash")


def clean(docs: DataFrame, bench: DataFrame, window: int = 13, k: int = 5, times: int = 20) -> DataFrame:
    """docs without the rows that ``contamination`` judges contaminated."""
    bad = judged(*hits(docs, bench, window, k), times).where("contaminated")
    bad = materialize(bad.select(F.col("doc_id").alias("b_doc"), F.col("thash").alias("b_hash")).distinct(), "contaminated")
    bad = small(bad)
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["b_doc"]) & F.xxhash64(docs["text"]).eqNullSafe(bad["b_hash"]), "left_anti")
