"""Approximate nearest neighbours by learned partitions.

On a bounded sample the neighbour graph is built exactly and cut into balanced partitions, by moves
that keep neighbours together under a capacity.  A small network learns which partitions hold a
vector's neighbours.  Its first choice is a vector's own partition; a query goes to its most probable
ones, as many as reach the wanted recall on the part of the sample that it was not trained on.  All
routed candidates are ranked by the exact cosine in double precision.

Partitions grow in number with the index: where a partition would hold too many entries, a second
router is learned from a bounded sample of that partition's own entries and cuts it again.  Entries and
queries of a partition meet in blocks; a partition is repeated only as often as blocks of queries that
were routed to it ask.

Equal vectors are one entry that keeps the k + 1 smallest ids: no query can return more of them.

Defined cases: null or zero vectors, vectors with null or non-finite components, vectors of another
length than most, and rows of a null id take no part; rows that repeat a query's id are its own row;
with fewer than k candidates all are returned; an empty table gives an empty result.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from ..session import materialize
from .sizes import small


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def neighbours(x: np.ndarray, k: int, others: np.ndarray | None = None) -> np.ndarray:
    """Indexes of the k nearest rows of others (of x itself, without the own row)."""
    out = []
    for lo in range(0, len(x), 512):
        s = x[lo : lo + 512] @ (x if others is None else others).T
        if others is None:
            s[np.arange(len(s)), lo + np.arange(len(s))] = -np.inf
        out.append(np.argpartition(-s, min(k, s.shape[1] - 1), 1)[:, :k])
    return np.concatenate(out) if out else np.zeros((0, k), int)


def balanced_cut(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.1, seed: int = 5) -> np.ndarray:
    """Partition of the graph's nodes: each round nodes move to where most of their neighbours are, the surest first, up to the capacity."""
    n = len(x)
    rng = np.random.default_rng(seed)
    cap = int(np.ceil(slack * n / parts))
    centre = x[rng.choice(n, parts, replace=False)]
    label = np.zeros(n, int)
    for r in range(rounds):
        votes = np.zeros((n, parts))
        if r:
            np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), label[graph].ravel()), 1.0)
            np.add.at(votes, (graph.ravel(), np.repeat(label, graph.shape[1])), 1.0)
            votes /= 2 * graph.shape[1]
        gain = votes + (x @ centre.T) * (0.5 if r else 1.0)
        best = np.sort(gain, 1)
        label = np.full(n, -1)
        room = np.full(parts, cap)
        for i in np.argsort(best[:, -2] - best[:, -1] if parts > 1 else best[:, -1]):
            for p in np.argsort(-gain[i]):
                if room[p]:
                    label[i] = p
                    room[p] -= 1
                    break
        for p in range(parts):
            if (label == p).any():
                c = x[label == p].mean(0)
                centre[p] = c / max(np.sqrt(c @ c), 1e-12)
    return label


@dataclass(frozen=True)
class Router:
    """A network of one hidden layer over unit vectors, and how many partitions a query visits."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    probes: int
    recall: float

    @property
    def parts(self) -> int:
        return len(self.b2)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2


def train(x: np.ndarray, parts: int, k: int = 5, want: float = 0.97, degree: int = 10, hidden: int = 128, steps: int = 250, seed: int = 5) -> Router:
    """Fit on unit vectors x; every fourth is held back to choose the number of probes."""
    n, dim = x.shape
    rng = np.random.default_rng(seed)
    parts = max(1, min(parts, n // 32))
    back = np.arange(n) % 4 == 3
    own = x[~back]
    graph = neighbours(own, min(degree, len(own) - 1)) if len(own) > 1 else np.zeros((len(own), 0), int)
    label = balanced_cut(own, graph, parts) if parts > 1 else np.zeros(len(own), int)
    target = np.zeros((len(own), parts))
    target[np.arange(len(own)), label] += 1
    if graph.shape[1]:
        np.add.at(target, (np.repeat(np.arange(len(own)), graph.shape[1]), label[graph].ravel()), 2.0 / graph.shape[1])
    target /= target.sum(1, keepdims=True)
    w = [rng.normal(0, (2 / dim) ** 0.5, (dim, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, (hidden, parts)), np.zeros(parts)]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, steps + 1 if parts > 1 else 1):  # Adam on the cross-entropy
        pick = rng.integers(0, len(own), min(1024, len(own)))
        a, y = own[pick], target[pick]
        h = np.maximum(a @ w[0] + w[1], 0)
        z = h @ w[2] + w[3]
        p = np.exp(z - z.max(1, keepdims=True))
        d = (p / p.sum(1, keepdims=True) - y) / len(a)
        dh = (d @ w[2].T) * (h > 0)
        for i, g in enumerate((a.T @ dh, dh.sum(0), h.T @ d, d.sum(0))):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - 0.01 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    router = Router(*w, parts, 1.0)
    if parts == 1 or not back.any() or len(own) < k:
        return router
    home = router.logits(own).argmax(1)
    order = np.argsort(-router.logits(x[back]), 1, kind="stable")
    near = home[neighbours(x[back], k, own)]
    at = np.argsort(order, 1)[np.arange(len(order))[:, None], near]  # which choice holds each neighbour
    for probes in range(1, parts + 1):
        if (recall := float((at < probes).mean())) >= want:
            break
    return Router(*w, probes, recall)


def _clean(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    ok = ~F.exists("v", lambda a: a.isNull() | F.isnan(a) | (F.abs(a) == float("inf")))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id is not null and v is not null and size(v) > 0").where(ok & F.exists("v", lambda a: a != 0))
    return rows


def _stack(column) -> np.ndarray:
    return np.array(column.tolist(), np.float64) if len(column) else np.zeros((0, 1))


@dataclass(frozen=True)
class Tree:
    """A router, and one for each of its partitions that is cut again (None for the others).

    A leaf is named by its partition times WIDE plus its place in it.
    """

    top: Router
    below: tuple[Router | None, ...]

    @property
    def leaves(self) -> int:
        return sum(r.parts if r else 1 for r in self.below)

    def route(self, x: np.ndarray, probes: int | None, whole: bool = False) -> list[np.ndarray]:
        """Leaves of each unit vector: its ``probes`` best partitions (the router's number if None) and of those the best leaves; all leaves if ``whole``."""
        if whole:
            every = np.array([p * WIDE + i for p, r in enumerate(self.below) for i in range(r.parts if r else 1)])
            return [every] * len(x)
        first = np.argsort(-self.top.logits(x), 1, kind="stable")[:, : probes or self.top.probes]
        out: list[list[int]] = [[] for _ in range(len(x))]
        for p in np.unique(first):
            at = np.flatnonzero((first == p).any(1))
            router = self.below[p]
            second = np.argsort(-router.logits(x[at]), 1, kind="stable")[:, : probes or router.probes] if router else np.zeros((len(at), 1), int)
            for i, leaves in zip(at.tolist(), second, strict=True):
                out[i] += [int(p) * WIDE + int(s) for s in leaves]
        return [np.array(o) for o in out]


WIDE = 1 << 16


def _route(tree: Tree, probes: int | None, whole: bool = False):
    def run(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            leaves = tree.route(unit(_stack(pdf["v"])), probes, whole)
            yield pdf.assign(parts=[x.astype(np.int32) for x in leaves])

    return run


def _search(k: int):
    def run(key, c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": pd.Series([], dtype="int64"), "vec_id": pd.Series([], dtype="int64"), "score": pd.Series([], dtype="float64")})
        if not len(c) or not len(q):
            return empty
        cv, qv = _stack(c["v"]), _stack(q["v"])
        cu = unit(cv)
        size = np.sqrt(np.einsum("ij,ij->i", cv, cv))
        ids = c["ids"].tolist()
        out = []
        for lo in range(0, len(qv), 256):
            s = unit(qv[lo : lo + 256]) @ cu.T
            for i in range(len(s)):
                x, own = qv[lo + i], int(q["query_id"].iloc[lo + i])
                need = min(k + 1, s.shape[1])  # one entry may be the query's own vector
                least = np.partition(s[i], s.shape[1] - need)[s.shape[1] - need]
                at = np.flatnonzero(s[i] >= least - 1e-9)
                exact = np.einsum("ij,j->i", cv[at], x) / (size[at] * np.sqrt(np.einsum("i,i->", x, x)))
                rows = sorted((-e, int(v)) for e, a in zip(exact.tolist(), at, strict=True) for v in ids[a] if v != own)[:k]
                out += [(own, v, -e) for e, v in rows]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else empty

    return run


def learn(entries: DataFrame, n: int, parts: int, k: int, sample: int, want: float, leaf: int) -> Tree:
    """The routers of n entries (v, ids): as many leaves as hold about ``leaf`` entries each, ``parts`` at least.

    The upper router learns from ``sample`` entries in hash order, a lower one from as many of its own partition.
    """
    order = F.xxhash64(F.get("ids", F.lit(0)))
    seen = np.array([r[0] for r in entries.select("v").orderBy(order).limit(sample).collect()], np.float64)
    leaves = max(parts, -(-n // leaf))
    upper = min(max(parts, int(np.ceil(np.sqrt(leaves)))), sample // 32)
    lower = min(-(-leaves // upper), sample // 32)
    # both levels must find a neighbour
    top = train(unit(seen), upper, k, want if lower == 1 else want**0.5)
    if lower == 1:
        return Tree(top, (None,) * top.parts)
    flat = Tree(top, (None,) * top.parts)
    own = entries.mapInPandas(_route(flat, 1), "v array<double>, ids array<long>, parts array<int>").withColumn("part", F.get("parts", F.lit(0)))
    own = own.withColumn("rn", F.row_number().over(Win.partitionBy("part").orderBy(order, "ids"))).where(F.col("rn") <= sample)

    def fit(key, pdf: pd.DataFrame) -> pd.DataFrame:
        x = _stack(pdf.sort_values("rn")["v"])
        r = train(unit(x), lower, k, want**0.5)
        return pd.DataFrame({"part": [int(key[0])], "router": [pickle.dumps((r.w1, r.b1, r.w2, r.b2, r.probes, r.recall))]})

    # a router a partition: at most sample / 32 networks
    found = {r["part"] // WIDE: Router(*pickle.loads(r["router"])) for r in own.groupBy("part").applyInPandas(fit, "part int, router binary").collect()}
    return Tree(top, tuple(found.get(p) if found.get(p) and found[p].parts > 1 else None for p in range(top.parts)))


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, parts: int = 16, sample: int = 4096, want: float = 0.97, block: int = 8192, leaf: int = 16384, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest of vectors for each row of queries.

    ``sample`` bounds the rows that a router is fitted on, in hash order; every row is indexed.
    ``block`` bounds the entries and the queries that one task compares, ``leaf`` is the wanted size of a
    partition; ``parts`` is their least number.
    """
    rows = _clean(vectors, vec_id, vector)
    long_ = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
    schema = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    if long_ is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == long_["d"])
    asked = _clean(queries, vec_id, vector).where(F.size("v") == long_["d"]).withColumnRenamed("vec_id", "query_id")
    # cut to k + 1 within each task before the shuffle
    some = F.row_number().over(Win.partitionBy("v").orderBy("vec_id")) <= k + 1
    entries = rows.distinct().withColumn("keep", some).where("keep").groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    entries = materialize(entries, "entries")
    tree = learn(entries, entries.count(), parts, k, sample, want, leaf)

    index = entries.mapInPandas(_route(tree, 1), "v array<double>, ids array<long>, parts array<int>").withColumn("part", F.get("parts", F.lit(0)))
    index = materialize(index.select("v", "ids", "part", F.xxhash64("ids").alias("h")), "index")
    # a row a leaf: how many blocks it is cut into
    held = index.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))

    def visit(asked: DataFrame, whole: bool) -> DataFrame:
        to = asked.select("query_id", "v").distinct().mapInPandas(_route(tree, None, whole), "query_id long, v array<double>, parts array<int>")
        to = materialize(to.select("query_id", "v", F.explode("parts").alias("part")), "routed")
        plan = held.join(to.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("splits")), "part")
        plan = small(materialize(plan, "plan"))
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = index.join(plan, "part").select("part", "v", "ids", F.pmod("h", F.col("blocks")).cast("int").alias("b"), each("splits").alias("s"))
        right = to.join(plan, "part").select(F.col("part").alias("to_part"), "query_id", "v", F.pmod(F.xxhash64("query_id"), F.col("splits")).cast("int").alias("to_s"), each("blocks").alias("to_b"))
        found = left.groupBy("part", "b", "s").cogroup(right.groupBy("to_part", "to_b", "to_s")).applyInPandas(_search(k), "query_id long, vec_id long, score double")
        best = Win.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        # an id of several different vectors counts by its nearest
        found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        return materialize(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "found")

    first = visit(asked, False)
    if tree.leaves == 1:
        return first
    # queries whose partitions held too few are asked of all
    full = first.where(F.col("rank") == k).select("query_id")
    short = materialize(asked.join(full, "query_id", "left_anti"), "short")
    if not short.limit(1).count():
        return first
    rest = visit(short, True)
    return first.join(short.select("query_id").distinct(), "query_id", "left_anti").unionByName(rest)
