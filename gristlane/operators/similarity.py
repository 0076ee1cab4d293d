"""Hamming similarity join of 64-bit fingerprints by bands."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hamming, let
from ..session import materialize


def band_edges(n: int) -> list[tuple[int, int]]:
    """(offset, width) of n bands of 64 bits, low bits first, the first ones a bit wider."""
    out, at = [], 0
    for i in range(n):
        width = 64 // n + (i < 64 % n)
        out.append((at, width))
        at += width
    return out


def bands(value: Column, distance: int, agree: int | None = None) -> Column:
    """Array of structs (band, bits) of which two values within the distance share one at least.

    Of distance + ``agree`` bands any two such values agree on ``agree``, so a key is the bits of so many
    bands: more keys a value, each of which far fewer values share.  Three from a distance of three on.
    """
    agree = agree or (1 if distance < 3 else 3)
    cut = F.array(*[F.shiftrightunsigned(value, at).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1)) for at, width in band_edges(distance + agree)])
    chosen = F.array(*[F.array(*map(F.lit, c)) for c in combinations(range(distance + agree), agree)])
    key = lambda p: F.transform(chosen, lambda c, i: F.struct(i.alias("band"), F.xxhash64(F.transform(c, lambda j: F.get(p, j))).alias("bits")))
    return let(cut, key)


#: rows of one key from which they are cut again, and rows that are looked through at once
_CROWD, _AT_ONCE = 4096, 1 << 17


def _packed(v: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The given bits of each value side by side."""
    out = np.zeros(len(v), np.uint64)
    for i, b in enumerate(bits):
        out |= ((v >> np.uint64(b)) & np.uint64(1)) << np.uint64(i)
    return out


class _Keys:
    """Keys of values by the given bits, dealt in turn to distance + agree bands: each key is the bits of ``agree`` of these.

    Two values within the distance share one key at least, their first the one of the first bands that they agree on.
    """

    def __init__(self, bits: np.ndarray, distance: int, agree: int):
        n = distance + agree
        self.bits = [bits[i::n] for i in range(n)]
        self.chosen = list(combinations(range(n), agree))
        self.shift = max(sum(len(self.bits[i]) for i in c) for c in self.chosen)
        self.masks = [np.uint64(sum(1 << int(b) for b in band)) for band in self.bits]
        self.agreed = np.array([[sum(1 << i for i in c), (2 << c[-1]) - 1] for c in self.chosen], object if n > 62 else np.int64)

    def of(self, v: np.ndarray):
        """The keys of all values, one choice after the other: its number above the bits."""
        parts = [_packed(v, band) for band in self.bits]
        for c, bands in enumerate(self.chosen):
            key, width = np.full(len(v), c, np.uint64) << np.uint64(self.shift), 0
            for i in bands:
                key |= parts[i] << np.uint64(width)
                width += len(self.bits[i])
            yield key.view(np.int64)

    def first(self, key: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Whether values that differ in the bits x and share the key share no earlier one."""
        same = np.zeros(len(x), self.agreed.dtype)
        for i, mask in enumerate(self.masks):
            same += ((x & mask) == 0).astype(same.dtype) * (1 << i)
        own = self.agreed[key >> self.shift]
        return (same & own[:, 1]) == own[:, 0]


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of two and more equal keys."""
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    sizes = np.diff(np.append(starts, len(key)))
    return starts[sizes > 1], sizes[sizes > 1]


def _compared(v: np.ndarray, starts: np.ndarray, sizes: np.ndarray, distance: int):
    """(i, j), i < j, of all rows of one run that differ in at most so many bits, in parts."""
    few = sizes <= 64
    size = sizes[few]
    row = np.repeat(starts[few] - np.cumsum(size) + size, size) + np.arange(size.sum())
    end, step = np.repeat(starts[few] + size, size), 1
    while len(row):
        more = row + step < end
        row, end = row[more], end[more]
        i = row[np.bitwise_count(v[row] ^ v[row + step]) <= distance]
        yield i, i + step
        step += 1
    for at, n in zip(starts[~few].tolist(), sizes[~few].tolist()):
        run, block = v[at : at + n], max(1, 8 * _AT_ONCE // n)
        for low in range(0, n - 1, block):
            i, j = np.nonzero(np.bitwise_count(run[low : low + block, None] ^ run[None, low + 1 :]) <= distance)
            i, j = i[j >= i], j[j >= i]
            yield at + low + i, at + low + 1 + j


def _crowd(v: np.ndarray, distance: int):
    """(i, j) of all different values of one long run: they meet once more by keys of the bits that vary among them."""
    varied = np.bitwise_or.reduce(v) & ~np.bitwise_and.reduce(v)
    keys = _Keys(np.flatnonzero((varied >> np.arange(64, dtype=np.uint64)) & np.uint64(1)), distance, 2)
    for key in keys.of(v):
        order = np.argsort(key, kind="stable")
        at = v[order]
        for i, j in _compared(at, *_runs(key[order]), distance):
            first = keys.first(key[order[i]], at[i] ^ at[j])
            yield order[i[first]], order[j[first]]


def _keyed(distance: int, agree: int):
    """Values to rows (key, v)."""
    keys = _Keys(np.arange(64), distance, agree)

    def run(batches):
        for batch in batches:
            for key in keys.of(batch.column(0).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([pa.array(key), batch.column(0)], ["key", "v"])

    return run


def _met(distance: int, agree: int):
    """Rows (key, v) in order of the key to pairs (v, w), v < w, each under the first key that it shares.

    Of the rows only those of the last key, which may go on, wait for the next batch.
    """
    keys = _Keys(np.arange(64), distance, agree)

    def pairs(key, v):
        starts, sizes = _runs(key)
        long = sizes > _CROWD
        yield from _compared(v, starts[~long], sizes[~long], distance)
        for at, n in zip(starts[long].tolist(), sizes[long].tolist()):
            for i, j in _crowd(v[at : at + n], distance):
                yield at + i, at + j

    def found(key, v):
        for i, j in pairs(key, v):
            first = keys.first(key[i], v[i] ^ v[j])
            a, b = v[i[first]].view(np.int64), v[j[first]].view(np.int64)
            yield np.stack([np.minimum(a, b), np.maximum(a, b)])

    def parts(batches):
        held, rows = [], 0
        for batch in batches:
            if not len(batch):
                continue
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)))
            rows += len(batch)
            if rows >= _AT_ONCE and held[0][0][0] != held[-1][0][-1]:
                key, v = (np.concatenate(c) for c in zip(*held))
                end = int(np.searchsorted(key, key[-1]))
                yield from found(key[:end], v[:end])
                held, rows = [(key[end:], v[end:])], len(key) - end
        if held:
            yield from found(*(np.concatenate(c) for c in zip(*held)))

    def run(batches):
        some, n = [], 0
        for part in parts(batches):
            some.append(part)
            n += part.shape[1]
            if n >= _AT_ONCE or len(some) >= _AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(some, 1)], ["v", "w"])
                some, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(some, 1)], ["v", "w"])

    return run


def _near(rows: DataFrame, distance: int) -> tuple[DataFrame, DataFrame]:
    """Different values v of the rows (v, k) with their number n and smallest key, and pairs (v, w), v < w, of near ones.

    The more values, the more bands a key takes: fewer values share one, but there are more keys.
    """
    values = materialize(rows.groupBy("v").agg(F.count("*").alias("n"), F.min("k").alias("least")), "values")
    if not distance:
        return values, values.select("v", F.col("v").alias("w")).where("false")
    n = values.count()
    agree = 1 if n < 1 << 19 else 2 if n < 1 << 24 else 3
    keyed = values.select("v").mapInArrow(_keyed(distance, agree), "key long, v long")
    return values, keyed.repartition("key").sortWithinPartitions("key").mapInArrow(_met(distance, agree), "v long, w long")


def hamming_join(df: DataFrame, key: str, value: str, distance: int) -> DataFrame:
    """(left, right, distance) of keys, left < right, whose values differ in at most so many bits.

    Equal values are one entry in the banded join and come back through their members, so a large
    group of equal values costs a row there.  Their pairs are listed, which is the operator's result.
    """
    rows = df.select(F.col(key).alias("k"), F.col(value).alias("v")).where("k is not null and v is not null")
    values, near = _near(rows, distance)
    near = near.union(values.where("n > 1").select("v", F.col("v").alias("w")))
    l, r = rows.select(F.col("k").alias("l"), F.col("v")), rows.select(F.col("k").alias("r"), F.col("v").alias("w"))
    pairs = near.join(l, "v").join(r, "w").where((F.col("v") != F.col("w")) | (F.col("l") < F.col("r")))
    return pairs.select(F.least("l", "r").alias("left"), F.greatest("l", "r").alias("right"), hamming(F.col("v"), F.col("w")).alias("distance"))


def hamming_links(df: DataFrame, key: str, value: str, distance: int) -> DataFrame:
    """(left, right) that join all keys which the pairs of ``hamming_join`` join, without listing those.

    Each key is linked to the smallest one of its value, and that to the smallest ones of near values.
    """
    rows = df.select(F.col(key).alias("k"), F.col(value).alias("v")).where("k is not null and v is not null")
    values, near = _near(rows, distance)
    l, r = values.select("v", F.col("least").alias("left")), values.select(F.col("v").alias("w"), F.col("least").alias("right"))
    members = rows.join(values.where("n > 1"), "v").where("k <> least").select(F.col("least").alias("left"), F.col("k").alias("right"))
    return near.join(l, "v").join(r, "w").select("left", "right").union(members)


def near_members(probe: DataFrame, reference: DataFrame, key: str, value: str, distance: int, listed: int = 8) -> DataFrame:
    """key, nearest distance, number of matches and the first ``listed`` matching keys of probe rows near a reference row."""
    p = probe.select(F.col(key).alias("k"), F.col(value).alias("v"), F.explode(bands(F.col(value), distance)).alias("x")).select("k", "v", "x.band", "x.bits")
    r = reference.select(F.col(key).alias("m"), F.col(value).alias("w"), F.explode(bands(F.col(value), distance)).alias("x")).select("m", "w", "x.band", "x.bits")
    near = p.join(r, ["band", "bits"]).where(hamming(F.col("v"), F.col("w")) <= distance).select("k", "m", hamming(F.col("v"), F.col("w")).alias("d")).distinct()
    from .sampling import ranked

    first = ranked(near, ["k"], "d", "m", column="rn").where(F.col("rn") <= listed)
    agg = near.groupBy("k").agg(F.min("d").alias("nearest"), F.count("*").alias("matches"))
    shown = first.groupBy("k").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rn", F.col("m").cast("string").alias("m")))), lambda x: x["m"]), ",").alias("listed"))
    return agg.join(shown, "k").withColumnRenamed("k", key)
