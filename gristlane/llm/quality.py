"""Quality classifier: Bradley-Terry pairwise ranking over features of whole texts.

Preference pairs (a text labelled 1 beats a text labelled 0) are fitted by logistic loss on the
difference of their features; scores are then cut at a quantile.  Every labelled row is learned from:
up to ``max_labelled`` of them on the driver, more in groups on the executors, of which each step of the
fit gathers sums.  Every text is scored by one pass without a shuffle.

Defined cases: a null or empty text has zero features and still gets a score; rows that repeat an
id are scored each; of rows that repeat a labelled id one is learned from; a null id is never held out;
labels other than 0 and 1 are ignored, and so is an id that is labelled both ways; with labels of one
kind only, every score is the cut (no preference is known); other columns are kept as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .sizes import small

#: byte classes for counting
CLASSES = 16
KIND = np.full(256, 15, np.uint8)
KIND[ord("a") : ord("z") + 1] = 0
KIND[ord("A") : ord("Z") + 1] = 1
KIND[ord("0") : ord("9") + 1] = 2
KIND[ord(" ")] = 3
KIND[ord("\n")] = 4
KIND[ord(".")] = 5
KIND[ord(",")] = 6
KIND[ord("!")] = 7
KIND[ord("?")] = 8
KIND[ord("|")] = 9
for _c in "#$%&*+<=>@\\^_~":
    KIND[ord(_c)] = 10
for _c in "()[]{}":
    KIND[ord(_c)] = 11
for _c in "-/:;\"'`":
    KIND[ord(_c)] = 12
KIND[:32][KIND[:32] == 15] = 13
KIND[127] = 13
KIND[128:192] = 14  # continuation bytes
NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
FEATURES = CLASSES + 14


def features(b: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of FEATURES numbers for each text; shares of bytes and words, so length alone is two of them."""
    n = len(off) - 1
    size = np.diff(off).astype(np.float64)
    owner = np.repeat(np.arange(n), np.diff(off))
    count = np.bincount(owner * CLASSES + KIND[b], minlength=n * CLASSES).reshape(n, CLASSES)
    share = count / np.maximum(size, 1)[:, None]
    low = W.LOWER[b]
    s, e, at = W.split(low, off, W.SPACE)
    words = np.diff(at).astype(np.float64)
    most = np.maximum(words, 1)
    h = W.word_hashes(low, s, e)
    who = np.repeat(np.arange(n), np.diff(at))
    length = e - s

    def per(flag: np.ndarray) -> np.ndarray:
        return np.bincount(who, weights=flag, minlength=n) / most

    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (who[1:] == who[:-1])
    last = b[np.maximum(e - 1, 0)] if len(e) else b[:0]
    first = b[s] if len(s) else b[:0]
    odd = np.isin(KIND[last], (7, 10))
    upper = (KIND[first] == 1) & (KIND[last] == 1) & (length > 1)
    stem = np.bincount(who[1:], weights=same[1:], minlength=n) / most if len(h) > 1 else np.zeros(n)
    key = W.mix(h + who.astype(W.U) * W.U(W.BASE))
    distinct = np.bincount(who[np.unique(key, return_index=True)[1]], minlength=n) / most
    pair = W.mix(key[:-1] * W.U(3) + key[1:]) if len(key) > 1 else key[:0]
    inside = who[:-1] == who[1:] if len(key) > 1 else np.zeros(0, bool)
    pairs = np.bincount(who[:-1][inside], minlength=n) if len(key) > 1 else np.zeros(n)
    uniq = np.unique(pair[inside], return_index=True)[1] if len(pair) else np.zeros(0, int)
    distinct2 = np.bincount(who[:-1][inside][uniq], minlength=n) / np.maximum(pairs, 1) if len(key) > 1 else np.zeros(n)
    ls, le, lat = W.split(b, off, NEWLINE)
    lines = np.diff(lat).astype(np.float64)
    lwho = np.repeat(np.arange(n), np.diff(lat))
    lkey = W.mix(W.word_hashes(b, ls, le) + lwho.astype(W.U) * W.U(W.BASE))
    dlines = np.bincount(lwho[np.unique(lkey, return_index=True)[1]], minlength=n) / np.maximum(lines, 1)
    mean = per(length)
    spread = np.sqrt(np.maximum(per(length.astype(np.float64) ** 2) - mean**2, 0))
    more = [np.log1p(size) / 10, np.log1p(words) / 10, mean / 10, spread / 10, stem, per(odd), per(upper), distinct, distinct2, dlines, np.log1p(lines) / 10, per(length <= 2), per(length >= 12), (words < 5).astype(float)]
    return np.concatenate([np.sqrt(share), np.stack(more, 1)], 1)


@dataclass(frozen=True)
class Model:
    """Weights over standardised features (and their squares), and the cut that maps to ``at``."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float
    at: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.concatenate([z, z * z / 6], 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.clip(self.inputs(x) @ self.weight - self.cut + np.log(self.at / (1 - self.at)), -40, 40)
        return 1 / (1 + np.exp(-z))


def bradley_terry(x: np.ndarray, y: np.ndarray, at: float = 0.3, max_pairs: int = 60_000, l2: float = 1e-3, steps: int = 25, seed: int = 7) -> Model:
    """Fit scores so that rows with y = 1 beat rows with y = 0; cut at the quantile of the share of 0."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(FEATURES), np.ones(FEATURES))
    model = Model(mean, scale, np.zeros(2 * len(mean)), 0.0, at)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return model
    z = model.inputs(x)
    rng = np.random.default_rng(seed)
    n = int(min(max_pairs, 20 * max(len(good), len(bad))))
    d = z[rng.choice(good, n)] - z[rng.choice(bad, n)]
    w = np.zeros(z.shape[1])
    for _ in range(steps):  # Newton steps on the pairwise logistic loss
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        grad = d.T @ (p - 1) / n + l2 * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / n + l2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    # The quantile of the labels' share of 0; between the two kinds if they are apart there.
    q = len(bad) / (len(good) + len(bad))
    low, high = np.quantile(s, [max(q - 0.01, 0), min(q + 0.01, 1)])
    cut = np.quantile(s, q) if high - low < 1e-9 else (low + high) / 2
    return Model(mean, scale, w, float(cut), at)


@W.lean
def _feature_rows(batches):
    for batch in batches:
        text = batch.column(batch.schema.get_field_index("text"))
        x = [features(b, off) for _, _, b, off in W.pieces(text)]
        x = np.concatenate(x) if x else np.zeros((0, FEATURES))
        kind = batch.column(batch.schema.get_field_index("quality"))
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), kind, pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), FEATURES).cast(pa.list_(pa.float64()))], ["doc_id", "quality", "x"])


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sums(df: DataFrame, part) -> np.ndarray:
    """The sum of what ``part`` makes of the batches, one array a task; tasks are added in one order always."""

    @W.lean
    def run(batches):
        total = None
        for batch in batches:
            got = part(batch)
            total = got if total is None else total + got
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["s"])

    return np.sum([np.frombuffer(b) for b in sorted(bytes(r[0]) for r in df.mapInArrow(run, "s binary").collect())], 0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, FEATURES)


def _quantiles(scores: DataFrame, n: int, qs: list[float], low: float, high: float, bins: int = 4096, rounds: int = 4) -> list[float]:
    """The order statistics below the quantiles, by counts in ever finer bins."""
    ends, ranks = [(low, high)] * len(qs), [int(q * (n - 1)) for q in qs]
    for _ in range(rounds):
        edges = [np.linspace(a, b, bins + 1) for a, b in ends]
        count = _sums(scores, lambda b, edges=edges: np.concatenate([np.bincount(np.searchsorted(e[1:-1], b.column(0).to_numpy()), minlength=bins) for e in edges]).astype(float)).reshape(len(qs), -1)
        at = [int(np.searchsorted(np.cumsum(c), r, "right")) for c, r in zip(count, ranks)]
        # rows below the range are in the first bin, so counts of all rows keep their ranks
        ends = [(float(e[a]), float(e[a + 1])) for e, a in zip(edges, at)]
    return [(a + b) / 2 for a, b in ends]


def _fit_groups(rows: DataFrame, at: float, l2: float = 1e-3, steps: int = 25, seed: int = 7, size: int = 512, pairs: int = 8) -> Model:
    """``bradley_terry`` on all rows (doc_id, quality, x), too many for the driver.

    They are dealt to groups of about ``size``; of the rarer kind each row goes to as many as give each group
    64 of them.  Of a group each row of the larger kind stands in ``pairs`` pairs, each of the other in as many at least.
    """
    stat = _sums(rows, lambda b: np.concatenate([[len(b), b.column(1).to_numpy().sum()], (x := _matrix(b.column(2))).sum(0), (x * x).sum(0)]))
    n, good = int(stat[0]), int(stat[1])
    mean = stat[2 : 2 + FEATURES] / n
    model = Model(mean, np.sqrt(np.maximum(stat[2 + FEATURES :] / n - mean**2, 0)) + 1e-6, np.zeros(2 * FEATURES), 0.0, at)
    if good in (0, n):
        return model
    many = -(-n // size)
    copies = {k: min(many, -(-64 * many // c)) for k, c in ((1, good), (0, n - good))}
    j = F.explode(F.sequence(F.lit(0), F.when(F.col("quality") == 1, copies[1] - 1).otherwise(copies[0] - 1))).alias("j")
    dealt = rows.select("doc_id", "quality", "x", j)
    step = F.when(F.col("quality") == 1, many // copies[1]).otherwise(many // copies[0])
    dealt = dealt.select(F.pmod(F.xxhash64("doc_id") + F.col("j") * step, F.lit(many)).alias("g"), "quality", "x")
    groups = materialize(dealt.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("quality", "x"))).alias("r")), "groups")

    def newton(w):
        def part(batch):
            out = np.zeros(1 + len(w) + len(w) ** 2)
            for g, members in zip(batch.column(0).to_pylist(), batch.column(1)):
                y, z = members.values.field(0).to_numpy(), model.inputs(_matrix(members.values.field(1)))
                kinds = [np.flatnonzero(y == 1), np.flatnonzero(y == 0)]
                most = pairs * max(map(len, kinds))
                if not min(map(len, kinds)):
                    continue
                rng = np.random.default_rng([seed, g])
                a, b = (np.concatenate([rng.permutation(k) for _ in range(-(-most // len(k)))])[:most] for k in kinds)
                d = z[a] - z[b]
                p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
                out += np.concatenate([[most], d.T @ (p - 1), ((d * (p * (1 - p))[:, None]).T @ d).ravel()])
            return out

        return part

    w = np.zeros(2 * FEATURES)
    for _ in range(steps):  # as in bradley_terry
        got = _sums(groups, newton(w))
        grad = got[1 : 1 + len(w)] / got[0] + l2 * w
        hess = got[1 + len(w) :].reshape(len(w), -1) / got[0] + l2 * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w = w - move
        if np.abs(move).max() < 1e-6:
            break

    def scored(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.inputs(_matrix(b.column(2))) @ w)], ["s"])

    scores = materialize(rows.mapInArrow(scored, "s double"), "label-scores")
    low, high = scores.agg(F.min("s"), F.max("s")).first()
    q = (n - good) / n
    a, b, c = _quantiles(scores, n, [max(q - 0.01, 0), min(q + 0.01, 1), q], low, high)
    return Model(mean, model.scale, w, c if b - a < 1e-9 else (a + b) / 2, at)


def fit(docs: DataFrame, labels: DataFrame, at: float = 0.3, max_labelled: int = 8192, **kw) -> Model:
    """Learn from all labelled rows that are not held out; more than ``max_labelled`` (counted first) stay on the executors."""
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality"), F.max(F.col("quality").cast("int")).alias("_q")).where("quality = _q")
    known = small(materialize(known.select("doc_id", "quality"), "labels"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").join(known, "doc_id").select("doc_id", "text", "quality").mapInArrow(_feature_rows, f"doc_id {kind}, quality int, x array<double>")
    # a row an id
    rows = rows.groupBy("doc_id").agg(F.min(F.struct("quality", "x")).alias("r")).select("doc_id", "r.*")
    rows = materialize(rows.sortWithinPartitions("doc_id"), "labelled")
    if rows.count() > max_labelled:
        conf, name = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
        before = conf.get(name)
        conf.set(name, "64")  # a group is a row
        try:
            return _fit_groups(rows, at, **kw)
        finally:
            conf.set(name, before)
    rows = rows.select("quality", "x").toPandas()
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), -1) if len(rows) else np.zeros((0, FEATURES))
    order = np.lexsort((*x.T, rows["quality"].to_numpy())) if len(rows) else []  # rows arrive in any order
    return bradley_terry(x[order], rows["quality"].to_numpy()[order], at, **kw)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """docs with the column ``out``: one pass, no shuffle, no other column is read."""
    schema = [f for f in docs.schema.fields if f.name != out]
    names = [f.name for f in schema]

    @W.lean
    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            got = [model.score(features(b, off)) for _, _, b, off in W.pieces(column)]
            got = np.concatenate(got) if got else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names] + [pa.array(got)], [*names, out])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.select(*(F.col(f"`{n}`") for n in names)).mapInArrow(run, StructType([*schema, StructField(out, DoubleType())]))


def scores(docs: DataFrame, labels: DataFrame, at: float = 0.3, **kw) -> DataFrame:
    """doc_id, held_out, score and predicted (1 where score >= at) of every row of docs."""
    model = fit(docs, labels, at, **kw)
    got = _digest(docs.select("doc_id", "text"), model)
    return got.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= at).cast("int").alias("predicted"))


def _digest(docs: DataFrame, model: Model) -> DataFrame:
    @W.lean
    def run(batches):
        for batch in batches:
            got = [model.score(features(b, off)) for _, _, b, off in W.pieces(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(got) if got else np.zeros(0))], ["doc_id", "score"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
