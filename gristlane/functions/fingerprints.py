"""Fingerprints and quality of grey images: rows hold pixels as an array, whole Arrow batches at a time.

Decoding is left to the caller (``operators.inference`` takes a decoder); null or short pixels give null.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Least size of a frame, and the share of its pixels at which light is extreme.
LEAST_SIZE = (160, 120)
DARK, BRIGHT, EXTREME = 5, 250, 0.995


def shrink(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean of the area that each pixel of the smaller image covers."""

    def weights(old: int, new: int) -> np.ndarray:
        edge = np.arange(new + 1) * (old / new)
        at = np.arange(old)
        return np.clip(np.minimum(edge[1:, None], at + 1) - np.maximum(edge[:-1, None], at), 0, None) * (new / old)

    return weights(image.shape[0], height) @ image @ weights(image.shape[1], width).T


def pack(bits: np.ndarray) -> int:
    """64 bits, the first one highest, as a signed number."""
    value = int("".join("1" if b else "0" for b in bits.ravel()), 2)
    return value - (1 << 64) if value >> 63 else value


def perceptual(image: np.ndarray) -> int:
    """Which of the 8 x 8 lowest frequencies of the 32 x 32 image lie above their median (the mean's own bit is 0)."""
    small = shrink(image.astype(np.float64), 32, 32)
    n = np.arange(32)
    basis = np.cos(np.pi * (2 * n + 1) * n[:8, None] / 64) * np.sqrt(2 / 32)
    basis[0] /= np.sqrt(2)
    low = (basis @ small @ basis.T).ravel()
    bits = low > np.median(low[1:])
    bits[0] = False
    return pack(bits)


def difference(image: np.ndarray) -> int:
    """Which pixels of the 9 x 8 image are brighter than the one before."""
    small = np.rint(shrink(image.astype(np.float64), 8, 9))
    return pack(small[:, 1:] > small[:, :-1])


def _each(pixels: pd.Series, width: pd.Series, height: pd.Series, what):
    for p, w, h in zip(pixels, width, height, strict=True):
        fine = p is not None and not pd.isna(w) and not pd.isna(h) and w > 0 and h > 0 and len(p) == int(w) * int(h)
        yield what(np.asarray(p, np.float64).reshape(int(h), int(w))) if fine else None


def phash(pixels: Column, width: Column, height: Column) -> Column:
    """Perceptual hash of 64 bits."""
    return F.pandas_udf(lambda p, w, h: pd.Series(list(_each(p, w, h, perceptual)), dtype="Int64"), "long")(pixels, width, height)


def dhash(pixels: Column, width: Column, height: Column) -> Column:
    """Difference hash of 64 bits."""
    return F.pandas_udf(lambda p, w, h: pd.Series(list(_each(p, w, h, difference)), dtype="Int64"), "long")(pixels, width, height)


def signature(pixels: Column, width: Column, height: Column) -> Column:
    """Perceptual hashes of the four right-angled rotations, sorted as unsigned numbers."""
    turned = lambda image: sorted((perceptual(np.rot90(image, k)) for k in range(4)), key=lambda v: v & (2**64 - 1))
    return F.pandas_udf(lambda p, w, h: pd.Series(list(_each(p, w, h, turned))), "array<long>")(pixels, width, height)


def frame_reasons(pixels: Column, width: Column, height: Column) -> Column:
    """What speaks against a frame, sorted (names are fixed values); in the JVM, as counts do."""
    n = F.size(pixels)
    share = lambda test: F.size(F.filter(pixels, test)) / n
    unreadable = F.coalesce((n == 0) | (n != width * height), F.lit(True))
    reasons = F.array_compact(F.array(F.when(share(lambda v: v >= BRIGHT) >= EXTREME, "image_extreme_overexposure"), F.when(share(lambda v: v <= DARK) >= EXTREME, "image_extreme_underexposure"), F.when((width < LEAST_SIZE[0]) | (height < LEAST_SIZE[1]), "image_resolution_below_minimum")))
    return F.when(unreadable, F.array(F.lit("image_unreadable"))).otherwise(reasons)
