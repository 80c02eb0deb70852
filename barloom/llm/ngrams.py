"""Hashed character n-gram counts and TF-IDF vectors in numpy, for use inside tasks."""

from __future__ import annotations

from functools import cache

import numpy as np

DIMENSIONS = 4096
SLICE = 1 << 22
ODD = tuple(np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D))


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.array([chr(point).isalpha() for point in range(0x110000)])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def letter_runs(text: str) -> np.ndarray:
    """Lower-case letters, with one space for each run of other characters."""
    points = code_points(f" {text.lower()} ")
    is_letter = letters()[points]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    keep[0] = True
    return np.where(is_letter, points, np.uint32(32))[keep]


def gram_counts(points: np.ndarray, sizes: tuple[int, ...], dimensions: int) -> np.ndarray:
    """Counts of all n-grams of the given sizes, hashed to a fixed number of places."""
    total = np.zeros(dimensions, dtype=np.int64)
    for size in sizes:
        for start in range(0, max(0, len(points) - size + 1), SLICE):
            part = points[start : start + SLICE + size - 1]
            count = len(part) - size + 1
            value = np.full(count, size, dtype=np.uint32)
            for k in range(size):
                value = (value ^ part[k : k + count]) * ODD[k % 3]
                value ^= value >> np.uint32(15)
            total += np.bincount(value % np.uint32(dimensions), minlength=dimensions)
    return total


def packed(counts: np.ndarray) -> bytes:
    """Places and counts that are not zero."""
    places = np.flatnonzero(counts)
    return np.stack([places, counts[places]]).astype("<i8").tobytes()


def unpacked(rows: list[bytes], dimensions: int) -> np.ndarray:
    matrix = np.zeros((len(rows), dimensions), dtype=np.float32)
    for row, data in zip(matrix, rows):
        places, counts = np.frombuffer(data, "<i8").reshape(2, -1)
        row[places] = counts
    return matrix


def inverse_frequency(counts: np.ndarray) -> np.ndarray:
    """Smoothed inverse document frequency of each place."""
    present = (counts > 0).sum(axis=0)
    return (np.log((1 + len(counts)) / (1 + present)) + 1).astype(np.float32)


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of logarithmic frequency times weight, of length one; zero rows stay zero."""
    vectors = np.log1p(counts, dtype=np.float32) * weights
    return normalised(vectors)


def normalised(vectors: np.ndarray) -> np.ndarray:
    length = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    return np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
