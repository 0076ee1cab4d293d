"""N-gram Jaccard join by universe partitions, verified exactly.

The universe of shingle hashes is cut into segments; how many depends on the size band.  Two sets
within Hamming distance H agree on one of any H + 1 segments, or come within one deletion on one of
(H + 1) / 2.  Each set indexes its first non-empty segments, as many as its own H demands; short
sets index one-deletion neighbourhoods of all of their fewer, longer segments, which are more selective.
There a segment counts from two members on: if the other set has neither it nor a set one deletion from
both, it costs two changes.  One member is listed, as the other set's segment may count, but has no
deletion, which would be empty.
Allocation follows cost: a segment whose key is frequent gets nothing, and the spare segments pay
for it.  Sets that run out of spare segments ("dominated" by frequent content) meet all sets of their
frequent keys, and those are compared block by block on parity sketches whose distance never
exceeds the sets' own, so nothing is lost.  What survives is verified on the full sets.

Exact copies are one class from the start (their sets are equal), so a large group of copies is one
row.  A set is known by a 64-bit sum of its hashes.

Defined cases: a null, empty or blank text has an empty set and is linked with nothing; a text of
fewer words than a shingle is one shingle of its whole sequence; rows that repeat an id are rows of
their own; a null id never names a component that holds another id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..session import materialize
from . import words as W
from .sizes import small

U = np.uint64
RATIO, SLACK, SPARE = 1.5, 1.08, 2
#: largest bucket whose pairs are listed; a key of more sets is frequent
FREQUENT = 24
#: members of a block of dominated sets
BLOCK = 1024
ODD = 0xC2B2AE3D27D4EB4F


def _bands() -> np.ndarray:
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, int(out[-1] * RATIO + 0.999)))
    return np.array(out)


BANDS = _bands()


def shingle_sets(column, k: int):
    """For each text in turn the sorted distinct hashes of its k-word shingles."""
    for lo, hi, d, off in W.pieces(column):
        b = W.LOWER[d]
        s, e, at = W.split(b, off, W.SPACE)
        h = W.word_hashes(b, s, e)
        for i in range(hi - lo):
            w = h[at[i] : at[i + 1]]
            yield np.unique(W.grams(w, min(k, len(w)))) if len(w) else w


class Threshold:
    """Jaccard of at least num / den, in whole numbers."""

    def __init__(self, num: int = 85, den: int = 100):
        self.num, self.den = num, den

    def distance(self, total):
        """Largest Hamming distance of linked sets whose sizes sum to total."""
        return (self.den - self.num) * total // (self.den + self.num)

    def largest(self, n: int) -> int:
        return self.distance(n + self.den * n // self.num)

    def schemes(self, n: int) -> list[tuple[int, int]]:
        """(band, H) of the segmentations that a set of n takes part in."""
        b = int(np.searchsorted(BANDS, n, "right")) - 1
        out = [(b, self.largest(n))]
        if b and -(-self.num * n // self.den) < BANDS[b]:
            out.append((b - 1, self.distance(n + int(BANDS[b]) - 1)))
        return [x for x in out if x[1] > 0]

    def segments(self, band: int) -> tuple[int, int]:
        """Segments of a band, and 1 or 2: what an indexed segment is worth."""
        most = self.largest(int(BANDS[band + 1]) - 1) + 1
        worth = 2 if most <= 6 else 1
        return int(-(-most // worth) * SLACK) + SPARE + 2 * (worth == 1), worth


#: set in a listed segment's number where it does not count
LOOSE = 1 << 26


def keys(x: np.ndarray, t: Threshold) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set, and for each band << 44 | segment << 16 | spare."""
    n = len(x)
    got, said = [], []
    mixed = W.mix(x)
    sums = np.zeros(n + 1, U)
    np.cumsum(mixed, out=sums[1:])
    for band, h in t.schemes(n):
        m, worth = t.segments(band)
        need = -(-(h + 1) // worth)
        edge = np.minimum(np.arange(m + 1) * (2.0**64 / m), 2.0**64 - 2048).astype(U)
        c = np.searchsorted(x, edge)
        c[-1] = n
        full = np.flatnonzero(np.diff(c))
        if worth == 1:
            # the first non-empty segments in order: of two sets, the shorter run lies within the longer
            full = full[: int(need * SLACK) + SPARE]
        size = c[full + 1] - c[full]
        # An empty segment is never a key.  A set with fewer segments that count than needed lists one key
        # more, under which such sets of its band meet.
        spare = int(np.count_nonzero(size >= worth)) - need
        content = sums[c[full + 1]] - sums[c[full]]
        tag = U(band << 32) + full.astype(U)
        segment = full + np.where(size >= worth, 0, LOOSE)
        if worth == 2:
            long_ = full[size > 1]
            seg = np.repeat(np.flatnonzero(size > 1), size[size > 1])
            of = np.concatenate([np.arange(c[j], c[j + 1]) for j in long_]) if len(long_) else np.zeros(0, int)
            content = np.concatenate([content, content[seg] - mixed[of]])
            tag, segment = np.concatenate([tag, tag[seg]]), np.concatenate([segment, segment[seg]])
        if spare < 0:
            content = np.append(content, U(0))
            tag, segment = np.append(tag, U((band << 32) + 0xFFFFFFF)), np.append(segment, LOOSE - 1)
        got.append(W.mix(content * U(W.BASE) + tag * U(ODD)))
        said.append((np.int64(band) << 44) | (segment.astype(np.int64) << 16) | np.int64(spare + 1000))
    if not got:
        return np.zeros(0, U), np.zeros(0, np.int64)
    return np.concatenate(got), np.concatenate(said)


def sketch(x: np.ndarray) -> np.ndarray:
    """Parity of the set over four to eight times as many bits as it has members (a power of two).

    At so many bits few members cancel each other, so few pairs beyond the threshold seem within it.
    """
    bits = 64
    while bits < 4 * len(x):
        bits *= 2
    at = (x & U(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view(U)


def fold(s: np.ndarray, size: int) -> np.ndarray:
    while len(s) > size:
        half = len(s) // 2
        s = s[:half] ^ s[half:]
    return s


def near(a: np.ndarray, b: np.ndarray) -> int:
    """At most the Hamming distance of the two sets."""
    size = min(len(a), len(b))
    return int(np.bitwise_count(fold(a, size) ^ fold(b, size)).sum())


def identity(x: np.ndarray) -> int:
    return int(np.int64(np.uint64((int(W.mix(x ^ U(ODD)).sum()) + len(x) * W.BASE) & (2**64 - 1)).view(np.int64)))


def members(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, thash (the text's), sid (the set's), n and sketch of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    @W.lean
    def run(batches):
        for batch in batches:
            sid, n, sk = [], [], []
            for x in shingle_sets(batch.column(2), k):
                sid.append(identity(x) if len(x) else 0)
                n.append(len(x))
                sk.append(sketch(x).tobytes() if len(x) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(sk, pa.binary())], ["doc_id", "thash", "sid", "n", "sketch"])

    return docs.select("doc_id", F.xxhash64("text").alias("thash"), "text").mapInArrow(run, f"doc_id {kind}, thash long, sid long, n long, sketch binary")


def _emit(k: int, t: Threshold, known: np.ndarray):
    """mapInArrow function: text -> (key, sid, said); said is negative for the known, very frequent keys."""

    @W.lean
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            ks, ss, ds = [], [], []
            for x in shingle_sets(batch.column(0), k):
                if not len(x):
                    continue
                sid = identity(x)
                if sid in seen:  # a copy within the task
                    continue
                seen.add(sid)
                if len(seen) > 200_000:
                    seen.clear()
                key, said = keys(x, t)
                if not len(key):
                    continue
                key = key.view(np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    said = np.where(known[at] == key, -said, said)
                ks.append(key)
                ss.append(np.full(len(key), sid))
                ds.append(said)
            if ks:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z)) for z in (ks, ss, ds)], ["key", "sid", "said"])

    return run


_TRI = {n: np.triu_indices(n, 1) for n in range(2, FREQUENT + 1)}


def _bucket(key, sid, said):
    """Rows (kind, a, b, c) of whole groups sorted by key and sid: 0 a pair of sets, 1 a frequent key's member."""
    out = []
    hot = said < 0
    if hot.any():
        out.append(np.stack([np.ones(hot.sum(), np.int64), key[hot], sid[hot], -said[hot]]))
        key, sid, said = key[~hot], sid[~hot], said[~hot]
    if len(key):
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (sid[1:] != sid[:-1])
        key, sid, said = key[new], sid[new], said[new]
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))
        size = np.diff(edge)
        big = np.repeat(size > FREQUENT, size)
        if big.any():
            out.append(np.stack([np.ones(big.sum(), np.int64), key[big], sid[big], said[big]]))
        for n in np.unique(size[(size > 1) & (size <= FREQUENT)]):
            rows = sid[edge[:-1][size == n][:, None] + np.arange(n)]
            i, j = _TRI[int(n)]
            a, b = rows[:, i].ravel(), rows[:, j].ravel()
            out.append(np.stack([np.zeros(len(a), np.int64), np.minimum(a, b), np.maximum(a, b), np.zeros(len(a), np.int64)]))
    if not out:
        return None
    got = np.concatenate(out, 1)
    pair = got[0] == 0
    ab = np.unique(got[1:3, pair], axis=1)
    got = np.concatenate([np.stack([np.zeros(ab.shape[1], np.int64), ab[0], ab[1], np.zeros(ab.shape[1], np.int64)]), got[:, ~pair]], 1)
    return pa.RecordBatch.from_arrays([pa.array(z) for z in got], ["kind", "a", "b", "c"])


@W.lean
def _group(batches):
    """Stream over rows sorted by key; a group that goes on in the next batch is held back."""
    held = None
    for batch in batches:
        rows = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)])
        if held is not None:
            rows = np.concatenate([held, rows], 1)
        if not rows.shape[1]:
            continue
        cut = int(np.searchsorted(rows[0], rows[0, -1], "left"))
        held = rows[:, cut:]
        if cut and (got := _bucket(*rows[:, :cut])) is not None:
            yield got
    if held is not None and held.shape[1] and (got := _bucket(*held)) is not None:
        yield got


def _survivors(t: Threshold):
    """Pairs with sketches that may be linked."""

    @W.lean
    def run(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            sa, sb = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            most = t.distance(na + nb)
            keep = [i for i in range(len(a)) if abs(int(na[i]) - int(nb[i])) <= most[i] and near(np.frombuffer(sa[i], U), np.frombuffer(sb[i], U)) <= most[i]]
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return run


def _blocks(t: Threshold, forest: bool):
    """Within a block pair of dominated sets: a forest over sets that may be linked, or all such pairs of different components."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("block", "ascending"), ("sid", "ascending")]).combine_chunks()
        own, other = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        sid, n, comp, block = (rows.column(c).to_numpy() for c in ("sid", "n", "comp", "block"))
        raw = [np.frombuffer(s.as_buffer(), U) for s in rows.column("sketch")]
        width = min(len(s) for s in raw)
        sk = np.stack([fold(s, width) for s in raw])
        out_a, out_b = [], []
        names, parent = np.unique(comp, return_inverse=True)
        parent = parent.copy()
        for x in range(len(sid)):
            if block[x] != own:
                continue
            rest = np.arange(x + 1, len(sid)) if own == other else np.flatnonzero(block == other)
            rest = rest[parent[rest] != parent[x]]
            if not len(rest):
                continue
            most = t.distance(n[rest] + n[x])
            ok = (np.abs(n[rest] - n[x]) <= most) & (np.bitwise_count(sk[rest] ^ sk[x]).sum(1) <= most)
            rest = rest[ok]
            if forest:
                for y in rest:
                    if parent[y] != parent[x]:
                        out_a.append(sid[x])
                        out_b.append(sid[y])
                        parent[parent == parent[y]] = parent[x]
            else:
                out_a.append(np.full(len(rest), sid[x])) if len(rest) else None
                out_b.append(sid[rest]) if len(rest) else None
        if not forest and out_a:
            out_a, out_b = np.concatenate(out_a), np.concatenate(out_b)
        a, b = np.array(out_a, np.int64), np.array(out_b, np.int64)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return run


def _sets(k: int):
    @W.lean
    def run(batches):
        for batch in batches:
            sid, need, raw = [], batch.column(1).to_numpy(zero_copy_only=False), []
            for want, x in zip(need, shingle_sets(batch.column(0), k), strict=True):
                if len(x) and identity(x) == want:
                    sid.append(want)
                    raw.append(x.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(sid, pa.int64()), pa.array(raw, pa.binary())], ["sid", "raw"])

    return run


def _verify(t: Threshold):
    @W.lean
    def run(batches):
        for batch in batches:
            a, b = batch.column(0), batch.column(1)
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(t.den * both >= t.num * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, t: Threshold) -> DataFrame:
    """Of pairs (a, b) of sets the linked ones, by the full sets."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    reps = materialize(classes.join(wanted, "sid").select("sid", F.col("rep.doc_id").alias("r"), F.col("rep.thash").alias("h")), "reps")
    own = docs.select("doc_id", "text").withColumn("thash", F.xxhash64("text"))
    texts = own.join(small(reps), own["doc_id"].eqNullSafe(reps["r"]) & (own["thash"] == reps["h"])).select("text", "sid")
    sets = materialize(texts.mapInArrow(_sets(k), "sid long, raw binary").dropDuplicates(["sid"]), "sets")
    one = pairs.join(sets.select(F.col("sid").alias("a"), F.col("raw").alias("ra")), "a")
    two = one.join(sets.select(F.col("sid").alias("b"), F.col("raw").alias("rb")), "b").select("a", "b", "ra", "rb")
    return materialize(two.mapInArrow(_verify(t), "a long, b long"), "links")


def join(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, salts: int = 64, sample: int = 64, complete: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, classes, links): every row with its class, the classes' sizes and first rows, and all links of different classes.

    Without ``complete`` the links join all that reach each other, but a pair that other links join may
    not be among them; that is enough for components.

    ``sample``: frequent keys that are spread over ``salts`` tasks from the start are found in one
    of so many texts; which keys those are changes where rows go, never what is found.
    """
    t = Threshold(num, den)
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    docs = docs.select("doc_id", "text")
    rows = materialize(members(docs, k), "members")
    classes = materialize(rows.where("n > 0").groupBy("sid").agg(F.min(F.struct("doc_id", "thash")).alias("rep"), F.min("doc_id").alias("low"), F.max("n").alias("n"), F.first("sketch").alias("sketch")), "classes")
    schema = "key long, sid long, said long"
    texts = docs.select("text")
    few = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample)) == 0)
    freq = few.mapInArrow(_emit(k, t, np.zeros(0, np.int64)), schema).groupBy("key").agg(F.count("*").alias("c")).where("c >= 6")
    # the most frequent keys of the sample, at most 4096: a bounded list
    known = np.sort(np.array([r[0] for r in freq.orderBy(F.desc("c"), "key").limit(4096).collect()], np.int64))
    listed = texts.mapInArrow(_emit(k, t, known), schema)
    listed = listed.repartition(parts, "key", F.when(F.col("said") < 0, F.pmod("sid", F.lit(salts)))).sortWithinPartitions("key", "sid")
    found = materialize(listed.mapInArrow(_group, "kind long, a long, b long, c long"), "found")

    cold = found.where("kind = 0").select("a", "b").distinct()
    info = classes.select("sid", "n", "sketch")
    cold = cold.join(info.select(F.col("sid").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("ka")), "a")
    cold = cold.join(info.select(F.col("sid").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("kb")), "b")
    cold = cold.select("a", "b", "na", "nb", "ka", "kb").mapInArrow(_survivors(t), "a long, b long")

    hot = found.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("sid"), F.shiftright("c", 44).alias("band"), F.expr("(c >> 16) & 268435455").alias("seg"), F.expr("(c & 65535) - 1000").alias("spare"))
    counts = F.col("seg") < LOOSE
    dominated = hot.groupBy("sid", "band").agg(F.count_distinct(F.when(counts, F.col("seg"))).alias("lost"), F.min("spare").alias("spare")).where("lost > spare").select("sid", "band")
    # the other set of a pair may have keys to spare: all sets of a dominated set's frequent keys meet
    shared = materialize(hot.where(counts | (F.col("spare") < 0)).join(dominated, ["sid", "band"], "left_semi").select("key").distinct(), "shared")
    # Groups are closed over the keys of one size band, in which each linked pair has a common
    # segmentation: sets of other sizes are not drawn in, and the sketches of a group have like widths.
    meet = hot.join(small(shared), "key", "left_semi").select("key", "sid", F.xxhash64("sid", "band").alias("node")).distinct()
    meet = materialize(meet, "meet")
    pivots = meet.groupBy("key").agg(F.min("node").alias("p"), F.count("*").alias("c")).where("c > 1")
    stars = meet.join(pivots, "key").select(F.col("p").alias("src"), F.col("node").alias("dst")).distinct()
    groups = connected_components(stars).select("node", F.col("component").alias("grp")).join(meet.select("node", "sid").distinct(), "node").drop("node")
    groups = materialize(groups.join(info, "sid"), "groups")

    pairs = materialize(cold.unionByName(_block_pairs(groups.withColumn("comp", F.col("sid")), t, not complete)).distinct(), "pairs")
    links = _links(docs, classes, pairs, k, t)
    if not complete and groups.limit(1).count():
        comp = connected_components(links, "a", "b").select(F.col("node").alias("sid"), F.col("component").alias("c"))
        left = groups.join(comp, "sid", "left").withColumn("comp", F.coalesce("c", "sid")).drop("c")
        rest = materialize(_block_pairs(left, t, False).distinct().join(pairs, ["a", "b"], "left_anti"), "rest")
        links = links.unionByName(_links(docs, classes, rest, k, t))
    return rows, classes, links


def _block_pairs(groups: DataFrame, t: Threshold, forest: bool) -> DataFrame:
    """Candidate pairs within groups of dominated sets, compared in blocks; a group of one component has none."""
    open_ = groups.groupBy("grp").agg(F.count_distinct("comp").alias("comps"), F.count("*").alias("size")).where("comps > 1")
    g = groups.join(open_, "grp").withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    g = g.select("grp", "sid", "n", "sketch", "comp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    g = g.withColumn("i", F.least("block", "o")).withColumn("j", F.greatest("block", "o"))
    return g.groupBy("grp", "i", "j").applyInArrow(_blocks(t, forest), "a long, b long")


def components(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest id reachable by links) of every row."""
    rows, classes, links = join(docs, k, num, den, complete=False)
    comp = connected_components(links, "a", "b")
    at = classes.select("sid", "low").join(comp.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    low = at.groupBy("component").agg(F.min("low").alias("component_id"))
    named = materialize(at.join(low, "component").select("sid", "component_id"), "named")
    out = rows.select("doc_id", "sid", "n").join(named, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def link_counts(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and n_links (rows that are linked with it, exact copies included) of every row."""
    rows, classes, links = join(docs, k, num, den)
    size = rows.where("n > 0").groupBy("sid").agg(F.count("*").alias("c"))
    ways = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    other = ways.join(size.withColumnRenamed("sid", "b"), "b").groupBy(F.col("a").alias("sid")).agg(F.sum("c").alias("others"))
    per = size.join(other, "sid", "left").select("sid", (F.col("c") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.select("doc_id", "sid", "n").join(per, "sid", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def survivors(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """docs with one row of each group: that of the smallest (id, text hash); rows without a shingle all stay."""
    rows, classes, links = join(docs, k, num, den, complete=False)
    comp = connected_components(links, "a", "b").withColumnRenamed("node", "sid")
    at = classes.select("sid", "rep").join(comp, "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    first = at.groupBy("component").agg(F.min("rep").alias("rep")).select(F.col("rep.doc_id").alias("_d"), F.col("rep.thash").alias("_h"))
    own = rows.where("n > 0").groupBy("doc_id", "thash").agg(F.count("*").alias("c"))
    gone = own.join(first, own["doc_id"].eqNullSafe(first["_d"]) & (own["thash"] == first["_h"]), "left_anti").select(F.col("doc_id").alias("_d"), F.col("thash").alias("_h"))
    gone = small(materialize(gone, "gone"))
    out = docs.join(gone, docs["doc_id"].eqNullSafe(gone["_d"]) & F.xxhash64(docs["text"]).eqNullSafe(gone["_h"]), "left_anti")
    # rows that repeat both id and text are copies of one another too
    return out.dropDuplicates(["doc_id", "text"]) if own.where("c > 1").limit(1).count() else out
