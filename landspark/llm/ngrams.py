"""Hashed character n-grams as numpy arrays, for the classifiers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters of a text that are handled at once; pieces overlap, so no n-gram is lost.
PIECE = 1_000_000
_PRIMES = [np.uint64(p) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_letters: list[np.ndarray] = []


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a record is kept from learning: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if not _letters:
        _letters.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _letters[0]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def folded(text: str) -> np.ndarray:
    """Lower-case letters, with one space for each run of anything else and around all."""
    points = code_points(f" {text.lower()} ")
    points = np.where(letters()[points], points, 32)
    return points[np.concatenate([[True], (points[1:] != 32) | (points[:-1] != 32)])]


def grams(points: np.ndarray, sizes: tuple[int, ...], buckets: int) -> Iterator[np.ndarray]:
    """The bucket of every n-gram, piece by piece; ``buckets`` is a power of two."""
    over = max(sizes) - 1
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    for at in range(0, max(1, len(points) - over), PIECE):
        own = points[at : at + PIECE + over].astype("<u8")
        for n in sizes:
            # the last piece takes all n-grams that are left, others those that begin in it
            count = len(own) - n + 1 if at + PIECE >= len(points) - over else PIECE
            if count > 0:
                h = np.full(count, np.uint64(n))
                for k in range(n):
                    h = (h ^ own[k : k + count]) * _PRIMES[k]
                    h ^= h >> np.uint64(29)
                yield ((h * _PRIMES[3]) >> shift).astype("i8")
