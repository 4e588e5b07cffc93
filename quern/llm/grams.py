"""Vectorised fingerprints of word sequences, for Arrow kernels."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa

R = np.uint64(0x9E3779B97F4A7C15)  # odd, hence invertible modulo 2**64
MIX = np.uint64(0xBF58476D1CE4E5B9)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * MIX
    return h ^ (h >> np.uint64(27))


def word_hashes(flat: pa.Array) -> np.ndarray:
    """uint64 of each word; each distinct word of the batch is hashed once, alike in every process."""
    coded = flat.dictionary_encode()
    table = pd.util.hash_array(np.array(coded.dictionary.to_pylist(), dtype=object), categorize=False)
    return table[coded.indices.to_numpy(zero_copy_only=False)] if len(table) else np.zeros(0, np.uint64)


def offsets(lists: pa.Array) -> np.ndarray:
    """Element offsets of a list array within its flattened values; nulls are empty."""
    sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    return np.concatenate([[0], np.cumsum(sizes)])


def powers(n: int) -> np.ndarray:
    out = np.ones(n + 1, np.uint64)
    np.multiply.accumulate(np.full(n, R), out=out[1:])
    return out


def spans(h: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Fingerprints of h[start:end]: a polynomial in R, from prefix sums; equal sequences are equal wherever they stand."""
    p = powers(len(h))
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * p[:-1], dtype=np.uint64)])
    inverse = np.uint64(pow(int(R), -1, 2**64))
    back = np.ones(len(h) + 1, np.uint64)
    np.multiply.accumulate(np.full(len(h), inverse), out=back[1:])
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def ngrams(h: np.ndarray, off: np.ndarray, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all q consecutive words within each text, and the offsets of the texts in them."""
    counts = np.maximum(np.diff(off) - q + 1, 0)
    out = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(out[-1]) - out[:-1][text] + off[:-1][text]
    f = np.zeros(len(at), np.uint64)
    for j in range(q):
        f = f * R + h[at + j]
        f ^= f >> np.uint64(29)
    return mix(f), out


def as_int64(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
