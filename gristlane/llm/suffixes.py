"""Removal of repeated spans by column-wise suffix arrays.

Every window of ``width`` bytes belongs to one anchor: the smallest k-gram hash in it (the first of
equal ones), so equal windows have equal anchors at equal places.  The windows of one anchor form a
segment, a short text of at most 2 * width - k bytes.  Segments with an anchor of their own hold no
repeated window.  Segments of equal content are one class.  Where an anchor has several classes,
their contents are one collection, whose Burrows-Wheeler transform and suffix order are built column
by column: each round inserts one symbol of every segment.  Equal windows are then neighbours in the
order.  The segments bound the number of rounds, which for whole documents would be that of the
longest text.

Defined cases: a null or empty text has no bytes; rows that repeat an id count in the order of id,
then text hash; a null id comes first; a text shorter than ``width`` is kept; exact copies of a row
(same id and text) are told apart by nothing, so each of them is judged as the first one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from ..session import materialize
from . import words as W
from .sizes import small

U = np.uint64
K = 32
#: bytes of the anchors by which the segments of a crowded anchor are cut once more
WIDE = 64
#: classes of one anchor whose contents (0.7 MB) are one collection; a crowded anchor's segments are cut more finely
CROWD = 4096


def anchors(b: np.ndarray, width: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For one text: k-gram hash, content hash, first window and number of windows of each segment."""
    n = len(b)
    none = np.zeros(0, np.int64)
    if n < width:
        return none, none, none, none
    sums = np.zeros(n + 1, U)
    np.cumsum((b.astype(U) + U(1)) * W.powers(W.BASE, n), out=sums[1:])
    back = W.powers(W.INVERSE, n + 1)
    g = W.mix((sums[k:] - sums[:-k]) * back[: n - k + 1])
    at = _first_min(g, width - k + 1)
    cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    count = np.diff(np.append(cut, len(at)))
    end = cut + count + width - 1
    content = W.mix((sums[end] - sums[cut]) * back[cut] + W.U(7) * count.astype(U) + U(W.BASE) * (at[cut] - cut).astype(U))
    return g[at[cut]].view(np.int64), content.view(np.int64), cut, count


def _first_min(g: np.ndarray, w: int) -> np.ndarray:
    """Place of the first smallest value in each run of w."""
    best, at = g, np.arange(len(g))
    done = 1
    while done < w:
        step = min(done, w - done)
        right = best[step:] < best[:-step]
        at = np.where(right, at[step:], at[:-step])
        best = np.where(right, best[step:], best[:-step])
        done += step
    return at


def _segments(width: int, k: int, known: np.ndarray):
    """mapInArrow function: rows (doc_id, thash, text) -> segments; those of the ``known`` frequent anchors are hot."""

    @W.lean
    def run(batches):
        for batch in batches:
            out = [[] for _ in range(4)]
            rows = []
            for lo, _, d, off in W.pieces(batch.column(2)):
                for i in range(len(off) - 1):
                    got = anchors(d[off[i] : off[i + 1]], width, k)
                    if len(got[0]):
                        for x, y in zip(out, got, strict=True):
                            x.append(y)
                        rows.append(np.full(len(got[0]), lo + i))
            if rows:
                rows = np.concatenate(rows)
                pick = pa.array(rows)
                a, c, s, n = (np.concatenate(x) for x in out)
                hot = known[np.minimum(np.searchsorted(known, a), len(known) - 1)] == a if len(known) else np.zeros(len(a), bool)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c), batch.column(0).take(pick), batch.column(1).take(pick), pa.array(s.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(hot)], PLACES)

    return run


LATER, WANTED, HOT, REPEAT = 0, 1, 2, 3
PLACES = ["anchor", "content", "doc_id", "thash", "start", "n", "hot"]


def _repeats(a: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before it; two nulls are equal."""
    x, y = a.slice(1), a.slice(0, len(a) - 1)
    return pc.if_else(pc.and_(pc.is_null(x), pc.is_null(y)), True, pc.fill_null(pc.equal(x, y), False)).to_numpy(zero_copy_only=False)


def _classes():
    """mapInArrow over segments sorted by anchor, content and place.

    Of each class of equal segments all but the first start later than an equal one (LATER), apart from
    those of a row that repeats id and text, which are the same place again and are left out.  First ones
    go on if their anchor has another class (WANTED); those of spread anchors meet the other salts (HOT).
    State is one class and, up to CROWD, the first ones of one anchor.
    """

    @W.lean
    def run(batches):
        held = None  # rows of the anchor that may go on
        last = None  # (anchor, content) of the last row
        place = None  # doc_id, thash and start of the last row
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            a = batch.column(0).to_numpy(zero_copy_only=False)
            c = batch.column(1).to_numpy(zero_copy_only=False)
            hot = batch.column(6).to_numpy(zero_copy_only=False)
            new_a, new_c = np.ones(len(a), bool), np.ones(len(a), bool)
            new_a[1:] = a[1:] != a[:-1]
            new_c[1:] = new_a[1:] | (c[1:] != c[:-1])
            if last is not None:
                new_a[0] = a[0] != last[0]
                new_c[0] = new_a[0] or c[0] != last[1]
            last = (a[-1], c[-1])
            table = pa.Table.from_batches([batch])
            kind = np.where(new_c, WANTED, LATER)
            again = ~new_c
            for col in (2, 3, 4):
                again[1:] &= _repeats(batch.column(col))
            now = tuple(batch.column(col)[0].as_py() for col in (2, 3, 4))
            again[0] &= now == place
            place = tuple(batch.column(col)[-1].as_py() for col in (2, 3, 4))
            kind[again] = REPEAT
            kind[hot & new_c] = HOT
            plain = np.flatnonzero(new_c & ~hot)
            decided = (kind == LATER) | (kind == HOT)
            out = [_typed(table.take(pa.array(np.flatnonzero(decided))), kind[decided], False)]
            # first ones by anchor: whole anchors are decided, the last one is held
            firsts = table.take(pa.array(plain))
            name = a[plain]
            if held is not None and len(name) and name[0] == held[0]:
                run_ = int(np.searchsorted(name != held[0], True)) if (name != held[0]).any() else len(name)
                count += run_
                if count > CROWD:
                    if held[1] is not None:
                        out.append(_typed(held[1], None, True))
                        held = (held[0], None)
                    out.append(_typed(firsts.slice(0, run_), None, True))
                else:
                    held = (held[0], pa.concat_tables([held[1], firsts.slice(0, run_)]))
                firsts, name = firsts.slice(run_), name[run_:]
            if len(name):
                if held is not None and held[1] is not None and count > 1:
                    out.append(_typed(held[1], None, False))
                edge = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1], [True]]))
                size = np.diff(edge)
                done = np.repeat(size, size)[: edge[-2]]
                out.append(_typed(firsts.take(pa.array(np.flatnonzero(done > 1))), None, done[done > 1] > CROWD))
                count = int(size[-1])
                rest = firsts.slice(int(edge[-2]))
                held = (name[-1], rest)
                if count > CROWD:
                    out.append(_typed(rest, None, True))
                    held = (name[-1], None)
            for t in out:
                yield from t.to_batches()
        if held is not None and held[1] is not None and count > 1:
            yield from _typed(held[1], None, False).to_batches()

    return run


def _typed(table: pa.Table, kind, crowded) -> pa.Table:
    n = len(table)
    kind = np.full(n, WANTED) if kind is None else kind
    crowded = np.full(n, crowded) if np.ndim(crowded) == 0 else crowded
    return pa.table([pa.array(kind.astype(np.int32)), *table.columns[:6], pa.array(crowded)], ["kind", "anchor", "content", "doc_id", "thash", "start", "n", "crowded"])


def _symbols(texts: list[bytes], step: int) -> np.ndarray:
    """For each byte of the texts, one after the other, the number that it and the next ones make."""
    flat = np.frombuffer(b"".join(texts) + bytes(step - 1), np.uint8)
    value = flat[: len(flat) - step + 1].astype(np.uint32)
    for i in range(1, step):
        value = (value << np.uint32(8)) | flat[i : len(flat) - step + 1 + i]
    return value


def suffix_order(texts: list[bytes], step: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, size) of the suffixes of a collection in order, by inserting one column a round.

    Round j puts the suffix of j symbols of every text into the order of the shorter ones.  Its place
    follows from the transform so far: suffixes sort by first symbol, then by the place of the rest.
    A symbol is ``step`` bytes; each text then stands in the collection once for every phase, cut by so
    many bytes at its end, so that a suffix begins at every byte, in a ``step``-th of the rounds.
    """
    length = np.array([len(t) for t in texts], np.int64)
    names, rank = np.unique(_symbols(texts, step), return_inverse=True)
    rank = (rank + 1).astype(np.uint8 if len(names) < 255 else np.uint16 if len(names) < 65535 else np.uint32)
    owner, phase = np.repeat(np.arange(len(texts)), step), np.tile(np.arange(step), len(texts))
    live = length[owner] >= phase
    owner, phase = owner[live], phase[live]
    blocks = (length[owner] - phase) // step
    tail = np.cumsum(length)[owner] - phase
    m = len(owner)
    most = int(blocks.max()) if m else 0
    # symbols from the end; 0 stands before the first symbol of a text
    cols = np.zeros((most + 1, m), rank.dtype)
    for j in range(most):
        live = blocks > j
        cols[j, live] = rank[tail[live] - step * (j + 1)]
    bwt = cols[0].copy()
    fresh = np.ones(m, bool)
    last = np.arange(m)  # texts of the suffixes that the last round inserted, in order
    for j in range(1, most + 1):
        order = np.argsort(bwt, kind="stable")
        order = order[np.count_nonzero(bwt == 0) :]
        place = m + np.flatnonzero(fresh[order])
        symbol = cols[j - 1, last]
        last = last[np.argsort(symbol, kind="stable")][np.count_nonzero(symbol == 0) :]
        size = len(bwt) + len(last)
        old = np.ones(size, bool)
        old[place] = False
        new = np.empty(size, rank.dtype)
        new[old] = bwt
        new[place] = cols[j, last]
        bwt, fresh = new, ~old
    # walk every text from its end through the finished transform
    order = np.argsort(bwt, kind="stable")
    back = np.empty(len(bwt), np.int64)
    back[order] = np.arange(len(bwt)) + m - np.count_nonzero(bwt == 0)
    text, start, size = (np.empty(len(bwt), np.int64) for _ in range(3))
    row, who = np.arange(m), np.arange(m)
    for j in range(most + 1):
        text[row], start[row], size[row] = owner[who], length[owner[who]] - phase[who] - step * j, step * j
        live = blocks[who] > j
        row, who = back[row[live]], who[live]
    return text, start, size


def equal_windows(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, class) of all windows of ``width`` bytes; equal windows have one class."""
    step = 4 if width % 4 == 0 else 1
    text, start, size = suffix_order(texts, step)
    length = np.array([len(t) for t in texts], np.int64)
    whole = size >= width
    text, start = text[whole], start[whole]
    if not len(text):
        return text, start, text
    flat = _symbols(texts, step)
    at = (np.cumsum(length) - length)[text] + start
    same = np.ones(len(at), bool)
    same[0] = False
    for i in range(0, width, step):  # common prefixes of neighbours, one column at a time
        live = np.flatnonzero(same)
        same[live] = flat[at[live] + i] == flat[at[live - 1] + i]
    return text, start, np.cumsum(~same)


#: bytes of a collection for one suffix order; more than one anchor shares it up to here
COLLECTION = 1 << 16


def _resolve(width: int):
    """mapInArrow over rows (part, rank, thash?, start, raw) sorted by part: windows that start earlier elsewhere."""

    def solve(part, who, start, raw):
        out = []
        lo = 0
        edges = np.flatnonzero(np.concatenate([part[1:] != part[:-1], [True]])) + 1
        size = np.cumsum([len(r) for r in raw])
        while lo < len(raw):
            base = size[lo - 1] if lo else 0
            fit = edges[(edges > lo) & (size[edges - 1] - base <= COLLECTION)]
            hi = int(fit[-1]) if len(fit) else int(edges[np.searchsorted(edges, lo, "right")])
            text, at, cls = equal_windows(raw[lo:hi], width)
            if len(text):
                doc, pos = who[lo:hi][text], start[lo:hi][text] + at
                o = np.lexsort((pos, doc, cls))
                later = np.zeros(len(o), bool)
                later[1:] = (cls[o][1:] == cls[o][:-1]) & ((doc[o][1:] != doc[o][:-1]) | (pos[o][1:] != pos[o][:-1]))
                o = o[later]
                keep = np.unique(np.stack([doc[o], pos[o]]), axis=1)
                out.append(keep)
            lo = hi
        return np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)

    def runs(found, names):
        """Windows as runs (doc_id, thash, start, n)."""
        if not found.shape[1]:
            return None
        d, p = found
        o = np.lexsort((p, d))
        d, p = d[o], p[o]
        new = np.concatenate([[True], (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1)])
        cut = np.flatnonzero(new)
        n = np.diff(np.append(cut, len(d)))
        pick = d[cut]
        return pa.RecordBatch.from_arrays([names[0].take(pa.array(pick)), names[1].take(pa.array(pick)), pa.array(p[cut].astype(np.int32)), pa.array(n.astype(np.int32))], ["doc_id", "thash", "start", "n"])

    @W.lean
    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table])
            part = table.column(0).to_numpy()
            if not len(part):
                continue
            cut = int(np.searchsorted(part, part[-1], "left"))
            held = table.slice(cut)
            if cut and (got := whole(table.slice(0, cut))) is not None:
                yield got
        if held is not None and len(held) and (got := whole(held)) is not None:
            yield got

    def whole(table):
        table = table.combine_chunks()
        # ranks of (doc_id, thash): the order in which texts count, a null id first
        frame = pa.table({"d": table.column(1), "h": table.column(2), "i": pa.array(np.arange(len(table)))})
        order = pc.sort_indices(frame, sort_keys=[("d", "ascending"), ("h", "ascending")], null_placement="at_start").to_numpy()
        d, h = frame.column("d").combine_chunks().take(pa.array(order)), frame.column("h").combine_chunks().take(pa.array(order))
        n = len(order)
        if n > 1:
            same_d = pc.fill_null(pc.equal(d.slice(1), d.slice(0, n - 1)), False).to_numpy(zero_copy_only=False) | (d.slice(1).is_null().to_numpy(zero_copy_only=False) & d.slice(0, n - 1).is_null().to_numpy(zero_copy_only=False))
            same = same_d & pc.equal(h.slice(1), h.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        else:
            same = np.zeros(0, bool)
        rank = np.cumsum(np.concatenate([[True], ~same])) - 1
        who = np.empty(n, np.int64)
        who[order] = rank
        firsts = np.flatnonzero(np.concatenate([[True], ~same]))
        names = (d.take(pa.array(firsts)), h.take(pa.array(firsts)))
        raw = [x.as_py() for x in table.column(4)]
        return runs(solve(table.column(0).to_numpy(), who, table.column(3).to_numpy().astype(np.int64), raw), names)

    return run


def _packed(base: DataFrame) -> DataFrame:
    """(doc_id, thash, text) with each text compressed, for joins that shuffle whole texts."""

    @W.lean
    def run(batches):
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = [None if t is None else pack.compress(t.encode()) for t in (x.as_py() for x in batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], ["doc_id", "thash", "text"])

    return base.mapInArrow(run, f"doc_id {base.schema['doc_id'].dataType.simpleString()}, thash long, text binary")


def _texts(column: pa.Array):
    """The bytes of each text, compressed or not; a null is empty."""
    unpack = zstandard.ZstdDecompressor() if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else None
    for x in column:
        text = x.as_py()
        yield b"" if text is None else unpack.decompress(text) if unpack else text.encode()


def _fetch(width: int):
    """Contents of wanted segments: (doc_id, thash, text, [anchor, start, n]) -> (anchor, doc_id, thash, start, raw)."""

    @W.lean
    def run(batches):
        for batch in batches:
            anchor, row, start, raw = [], [], [], []
            wanted = batch.column(3).to_pylist()
            for i, b in enumerate(_texts(batch.column(2))):
                for w in wanted[i]:
                    anchor.append(w["anchor"])
                    row.append(i)
                    start.append(w["start"])
                    raw.append(b[w["start"] : w["start"] + w["n"] + width - 1])
            pick = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), batch.column(0).take(pick), batch.column(1).take(pick), pa.array(start, pa.int32()), pa.array(raw, pa.binary())], RAW)

    return run


RAW = ["anchor", "doc_id", "thash", "start", "raw"]


def _finer(width: int, k: int):
    """Segments of contents by wider anchors, as rows of RAW again; at ``k`` = width a segment is one window, known by a digest."""

    @W.lean
    def run(batches):
        for batch in batches:
            anchor, row, start, raw = [], [], [], []
            first = batch.column(3).to_numpy()
            for i, content in enumerate(batch.column(4)):
                x = content.as_py()
                a, _, cut, n = anchors(np.frombuffer(x, np.uint8), width, k)
                anchor.append(a)
                row.append(np.full(len(a), i))
                start.append(cut + first[i])
                if k < width:
                    raw += [x[s : s + m + width - 1] for s, m in zip(cut.tolist(), n.tolist(), strict=True)]
                else:
                    raw += [hashlib.blake2b(x[s : s + width], digest_size=16).digest() for s in cut.tolist()]
            if not raw:
                continue
            pick = pa.array(np.concatenate(row))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(anchor)), batch.column(1).take(pick), batch.column(2).take(pick), pa.array(np.concatenate(start).astype(np.int32)), pa.array(raw, pa.binary())], RAW)

    return run


def _later_places(rows: DataFrame, n) -> tuple[DataFrame, DataFrame]:
    """(first row of each equal anchor and content, runs of the other ones).

    Groups are combined before the shuffle, and a group of many rows is split in the join back.
    """
    first = rows.groupBy("anchor", "raw").agg(F.min(F.struct("doc_id", "thash", "start")).alias("first"))
    first = materialize(first.select(F.col("anchor").alias("a"), F.col("raw").alias("r"), "first.*"), "first-places")
    first = first.select("a", "r", F.col("doc_id").alias("d"), F.col("thash").alias("h"), F.col("start").alias("s"))
    met = rows.join(first, (rows["anchor"] == first["a"]) & (rows["raw"] == first["r"]))
    # rows that repeat id and text are the same place again
    later = met.where(~(F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("thash") == F.col("h")) & (F.col("start") == F.col("s"))))
    return first.select(F.col("a").alias("anchor"), F.col("d").alias("doc_id"), F.col("h").alias("thash"), F.col("s").alias("start"), F.col("r").alias("raw")), later.select("doc_id", "thash", "start", n.alias("n"))


def _crowded(rows: DataFrame, width: int, parts: int, kind: str) -> DataFrame:
    """Runs of windows of crowded anchors' contents that start earlier elsewhere, cut by anchors of WIDE bytes, then to single windows."""
    found = None
    for k in sorted({min(WIDE, width), width}):
        finer = materialize(rows.mapInArrow(_finer(width, k), f"anchor long, doc_id {kind}, thash long, start int, raw binary"), "finer")
        heads, later = _later_places(finer, F.lit(1) if k == width else (F.octet_length("raw") - (width - 1)))
        found = later if found is None else found.unionByName(later)
        if k == width:  # windows of one anchor are equal
            return found
        size = heads.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1").withColumnRenamed("anchor", "a")
        more = materialize(heads.join(size, F.col("anchor") == F.col("a")).drop("a"), "classes")
        found = found.unionByName(_ordered(more.where(F.col("m") <= CROWD).drop("m"), width, parts, kind))
        rows = more.where(F.col("m") > CROWD).drop("m")
        if not rows.limit(1).count():
            return found


def _ordered(raw: DataFrame, width: int, parts: int, kind: str) -> DataFrame:
    """Runs of windows that start earlier, from the suffix orders of the anchors' collections."""
    return raw.repartition(parts, "anchor").sortWithinPartitions("anchor").mapInArrow(_resolve(width), f"doc_id {kind}, thash long, start int, n int")


def repeated(docs: DataFrame, width: int = 100, k: int = K, salts: int = 64, sample: int = 64) -> DataFrame:
    """(doc_id, thash, start, n): runs of windows that also start earlier, judged on the whole input.

    ``sample``: frequent anchors that are spread over ``salts`` tasks are found in one of so many
    texts; which those are changes where rows go, never what is found.
    """
    spark = docs.sparkSession
    parts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    kind = docs.schema["doc_id"].dataType.simpleString()
    base = docs.select("doc_id", F.xxhash64("text").alias("thash"), "text")
    schema = f"anchor long, content long, doc_id {kind}, thash long, start int, n int, hot boolean"
    few = base.where(F.pmod("thash", F.lit(sample)) == 0).mapInArrow(_segments(width, k, np.zeros(0, np.int64)), schema)
    freq = few.groupBy("anchor").agg(F.count("*").alias("c")).where("c >= 6")
    # the most frequent anchors of the sample, at most 4096: a bounded list
    known = np.sort(np.array([r[0] for r in freq.orderBy(F.desc("c"), "anchor").limit(4096).collect()], np.int64))
    seg = base.mapInArrow(_segments(width, k, known), schema).repartition(parts, "anchor", F.when(F.col("hot"), F.pmod("thash", F.lit(salts))))
    seg = seg.sortWithinPartitions("anchor", "content", "doc_id", "thash", "start")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
    found = materialize(seg.mapInArrow(_classes(), f"kind int, anchor long, content long, doc_id {kind}, thash long, start int, n int, crowded boolean"), "found")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")

    place = ["doc_id", "thash", "start", "n"]
    later = found.where(F.col("kind") == LATER).select(*place)
    # a class of a spread anchor has one row a salt at most
    hot = found.where(F.col("kind") == HOT).withColumn("rn", F.row_number().over(Win.partitionBy("anchor", "content").orderBy("doc_id", "thash", "start")))
    hot = materialize(hot, "hot")
    later = later.unionByName(hot.where("rn > 1").select(*place))
    classes = hot.where("rn = 1").groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1")
    more = hot.where("rn = 1").drop("crowded").join(classes, "anchor").withColumn("crowded", F.col("m") > CROWD)
    wanted = found.where(F.col("kind") == WANTED).select("anchor", *place, "crowded").unionByName(more.select("anchor", *place, "crowded"))
    wanted = materialize(wanted, "wanted")

    def contents(which: DataFrame) -> DataFrame:
        # of one text, so no more than its own segments; most texts have some, so the texts are dealt by id beside them
        per = which.groupBy(F.col("doc_id").alias("d"), F.col("thash").alias("h")).agg(F.collect_list(F.struct("anchor", "start", "n")).alias("w"))
        packed = _packed(base)
        texts = packed.join(per, packed["doc_id"].eqNullSafe(per["d"]) & (packed["thash"] == per["h"])).select("doc_id", "thash", "text", "w")
        return texts.mapInArrow(_fetch(width), f"anchor long, doc_id {kind}, thash long, start int, raw binary")

    out = later.unionByName(_ordered(contents(wanted.where("not crowded")), width, parts, kind))
    crowded = wanted.where("crowded")
    if crowded.limit(1).count():
        out = out.unionByName(_crowded(contents(crowded), width, parts, kind))
    return out


def _cut(width: int, text_out: bool):
    """(doc_id.., text, spans) -> digest columns, or the text without the covered bytes."""

    def covered(size, spans):
        mark = np.zeros(size + 1, np.int32)
        for s in spans or ():
            mark[s["start"]] += 1
            mark[min(size, s["start"] + s["n"] + width - 1)] -= 1
        return np.cumsum(mark[:-1]) > 0

    @W.lean
    def digest(batches):
        for batch in batches:
            rows = [[], [], [], []]
            for b, spans in zip(_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                gone = covered(len(b), spans) if spans else np.zeros(len(b), bool)
                kept = np.frombuffer(b, np.uint8)[~gone].tobytes() if spans else b
                rows[0].append(len(b))
                rows[1].append(len(b) - len(kept))
                rows[2].append(int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if spans else 0)
                rows[3].append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(r, pa.int64()) for r in rows[:3]), pa.array(rows[3], pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    @W.lean
    def rewrite(batches):
        for batch in batches:
            at, sp = batch.schema.get_field_index("text"), batch.schema.get_field_index("__gl_spans")
            texts = []
            for text, spans in zip(batch.column(at), batch.column(sp).to_pylist(), strict=True):
                if not spans:
                    texts.append(text.as_py())
                    continue
                b = text.as_py().encode()
                # a span that cuts through a character leaves part of it, which is dropped
                texts.append(np.frombuffer(b, np.uint8)[~covered(len(b), spans)].tobytes().decode("utf-8", "ignore"))
            cols = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns) if i != sp]
            yield pa.RecordBatch.from_arrays(cols, [n for n in batch.schema.names if n != "__gl_spans"])

    return rewrite if text_out else digest


def _merge(runs, x):
    """Runs of windows with one more, in order of start."""
    last = F.try_element_at(runs, F.lit(-1))
    end = last["start"] + last["n"]
    joined = F.struct(last["start"].alias("start"), (F.greatest(end, x["start"] + x["n"]) - last["start"]).alias("n"))
    touches = F.coalesce(x["start"] <= end, F.lit(False))
    return F.when(touches, F.concat(F.slice(runs, 1, F.size(runs) - 1), F.array(joined))).otherwise(F.concat(runs, F.array(x)))


def _with_spans(docs: DataFrame, width: int, k: int, pack: bool = False) -> DataFrame:
    """docs with __gl_spans: the runs of windows to remove, null where there are none.

    ``pack``: docs are (doc_id, text), and their texts come back compressed where the join shuffles them.
    """
    found = materialize(repeated(docs, width, k), "repeated")
    # of one text, so no more than its own windows; runs that touch become one
    per = found.groupBy("doc_id", "thash").agg(F.sort_array(F.collect_set(F.struct("start", F.col("n").alias("n")))).alias("r"))
    per = per.select(F.col("doc_id").alias("__gl_d"), F.col("thash").alias("__gl_h"), F.aggregate("r", F.array().cast("array<struct<start:int,n:int>>"), _merge).alias("__gl_spans"))
    written = materialize(per, "spans")
    per = small(written, weight="2 + size(__gl_spans)")
    if pack and per is written:
        packed = _packed(docs.select("doc_id", F.xxhash64("text").alias("thash"), "text"))
        return packed.join(per, packed["doc_id"].eqNullSafe(F.col("__gl_d")) & packed["thash"].eqNullSafe(F.col("__gl_h")), "left").drop("__gl_d", "__gl_h", "thash")
    return docs.join(per, docs["doc_id"].eqNullSafe(F.col("__gl_d")) & F.xxhash64(docs["text"]).eqNullSafe(F.col("__gl_h")), "left").drop("__gl_d", "__gl_h")


def digests(docs: DataFrame, width: int = 100, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _with_spans(docs, width, k, pack=True).select("doc_id", "text", "__gl_spans")
    return rows.mapInArrow(_cut(width, False), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove(docs: DataFrame, width: int = 100, k: int = K) -> DataFrame:
    """docs with the texts that are left."""
    rows = _with_spans(docs, width, k)
    return rows.mapInArrow(_cut(width, True), docs.schema)
