"""Hashed word shingles of texts, inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def as_strings(column: pa.Array) -> pa.Array:
    """Texts of a binary column. Null is empty; bytes that are no UTF-8 become replacement characters."""
    try:
        texts = column.cast(pa.string())
    except pa.ArrowInvalid:
        texts = pa.array([None if b is None else b.decode("utf-8", "replace") for b in column.to_pylist()], pa.string())
    return pc.fill_null(texts, "")


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts on end, and where each text starts and the last ends."""
    lists = pc.ascii_split_whitespace(as_strings(column))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    coded = words.dictionary_encode()
    unique = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, unique), np.uint64, len(unique))
    codes = coded.indices.to_numpy()[real]
    starts = np.concatenate([[0], np.cumsum(real)])[offsets - offsets[0]]
    return hashes[codes], starts


def shingles(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts on end, with repeats, and where each text starts.

    A text of fewer words has one shingle, all its words; one without words has none.
    """
    hashes, starts = word_hashes(column)
    counts = np.diff(starts)
    short = (counts > 0) & (counts < words)
    sizes = np.where(short, 1, np.maximum(counts - words + 1, 0))
    ends = np.cumsum(sizes)
    at = np.repeat(starts[:-1] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if len(ends) else 0)
    padded = np.concatenate([hashes, np.zeros(words, np.uint64)])
    out = np.zeros(len(at), np.uint64)
    used = np.repeat(np.minimum(counts, words), sizes)
    for j in range(words):
        word = np.where(j < used, padded[at + j], np.uint64(j + 1))
        out = mix(out * _STEP + word)
    return out, np.concatenate([[0], ends])
