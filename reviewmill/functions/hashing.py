"""Places of n-grams in hashed vectors, for whole Arrow arrays of texts inside tasks (M1-M3).

The places are those of MLlib's ``HashingTF``: MurmurHash3 of the term's bytes with seed 42, modulo the length of the vector.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # so the tasks need not find this package

SEED = 42
#: Bytes of text that are taken apart at a time; its terms, as numbers, take some fifty times as much.
SLICE = 1 << 20


def slices(texts: pa.Array, limit: int = SLICE) -> list[pa.Array]:
    """Consecutive parts of an array of texts of about ``limit`` bytes each, so that long texts do not fill a task's memory."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(ends // limit)) + 1).tolist(), len(texts)]
    return [texts.slice(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)


def murmur3(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """MurmurHash3 (32 bits) of each run of ``lengths`` bytes of ``data`` (uint8) from ``starts``."""
    padded = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.uint32)
    four = padded[:-3] | padded[1:-2] << np.uint32(8) | padded[2:-1] << np.uint32(16) | padded[3:] << np.uint32(24)
    h = np.full(len(starts), SEED, np.uint32)
    blocks = lengths // 4
    active = np.arange(len(starts))
    for n in range(int(blocks.max(initial=0))):
        active = active[blocks[active] > n]
        x = h[active] ^ _mixed(four[starts[active] + 4 * n])
        h[active] = (x << np.uint32(13) | x >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint32)[lengths % 4]
    h ^= _mixed(four[starts + 4 * blocks] & rest)
    h ^= lengths.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    return h ^ h >> np.uint32(16)


def text_places(texts: pa.Array, stop_words: pa.Array, sizes: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every n-gram of words that are no stop words, n-gram sizes one behind the other.

    Texts are words with one blank between them. ``sizes`` holds each n with the length of its vector. An n-gram is a run of bytes of
    the kept words, written with one blank between them, so no term is ever built.
    """
    words = pc.split_pattern(texts.cast(pa.large_string()), " ")
    owner, flat = pc.list_parent_indices(words), pc.list_flatten(words)
    kept = pc.invert(pc.is_in(flat, value_set=stop_words.cast(pa.large_string())))
    owner, flat = owner.filter(kept).to_numpy().astype(np.int64), flat.filter(kept)
    lengths = pc.binary_length(flat).to_numpy().astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    line = pc.binary_join_element_wise(flat, *pa.array(["", " "], pa.large_string())).buffers()[2]  # each word and a blank, end to end
    data = np.frombuffer(line, np.uint8) if line else np.zeros(0, np.uint8)
    rows, places, offset = [], [], 0
    for n, size in sizes:
        first = np.arange(max(len(owner) - n + 1, 0))
        first = first[owner[first] == owner[first + n - 1]]
        found = murmur3(data, starts[first], ends[first + n - 1] - starts[first]).astype(np.int32)
        rows.append(owner[first])
        places.append(np.mod(found.astype(np.int64), size) + offset)
        offset += size
    return np.concatenate(rows), np.concatenate(places)


def count_vectors(texts: pa.Array, sizes: list[tuple[int, int]]) -> pa.Array:
    """Sparse vectors of n-gram counts, as MLlib stores them; texts are words with one blank between them, null for none."""
    total, parts, no_words = sum(size for _, size in sizes), [], pa.array([], pa.string())
    for part in slices(texts):
        rows, places = text_places(part, no_words, sizes)
        found, counts = np.unique(rows * total + places, return_counts=True)
        ends = pa.array(np.searchsorted(found, np.arange(len(part) + 1) * total), pa.int32())
        parts.append(pa.StructArray.from_arrays([
            pa.array(np.zeros(len(part), np.int8)), pa.array(np.full(len(part), total, np.int32)),
            pa.ListArray.from_arrays(ends, pa.array((found % total).astype(np.int32))),
            pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.float64)))], ["type", "size", "indices", "values"]))
    return pa.concat_arrays(parts)
