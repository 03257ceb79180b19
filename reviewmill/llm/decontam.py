"""Benchmark decontamination: short test items found inside long documents by MinHash containment search.

Method: items fall into partitions by the size of their shingle set, powers of two. For a partition of items with at most L shingles a
document is seen as windows of two neighbouring blocks of L shingles, so an item's passage lies inside one window and its
Jaccard similarity with that window stays above 0.19 however long the document is. A window that shares a MinHash
register with an item makes a candidate (bands of one row; missed with chance 0.81^64, about 1e-6), and candidates are
confirmed by the exact share of the item's shingles that the whole document contains. A register can only be
shared if the window holds the shingle that gave the item its minimum, so registers are computed for windows with
such a shingle and the others are passed over; this loses no candidate.

Items are collected in blocks of about ``BLOCK_CHARS`` characters, one pass over the documents for each block, so what travels to the
tasks is bounded for a benchmark of any size.

Defined cases: null or blank items and documents match nothing. An item with fewer words than a shingle is one shingle, and so is such a
document. Each row of ``docs`` is judged by itself, so repeated rows give repeated results; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import shingles, slices, word_codes

HASHES = 64
BLOCK_CHARS = 16_000_000

_random = np.random.default_rng(1997)
FACTOR = (_random.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
SHIFT = _random.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)
REGISTER = np.arange(HASHES, dtype=np.uint64) << np.uint64(32)


def _hashed(codes: np.ndarray) -> np.ndarray:
    return FACTOR[:, None] * (codes >> np.uint64(32)).astype(np.uint32) + SHIFT[:, None]


class Partition:
    """Items of similar size, at most ``length`` shingles, and the sorted values of their registers."""

    def __init__(self, length: int, members: list[int], sets: list[np.ndarray]):
        self.length, self.members = length, np.array(members)
        hashed = [_hashed(sets[i]) for i in members]
        values = np.stack([h.min(axis=1) for h in hashed], axis=1)
        self.least = np.concatenate([sets[i][np.unique(h.argmin(axis=1))] for i, h in zip(members, hashed, strict=True)])
        keys = (REGISTER[:, None] | values).ravel()
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners = keys[order], np.tile(self.members, HASHES)[order]

    def candidates(self, codes: np.ndarray, places: np.ndarray) -> set[int]:
        """Items that share a register with a window of ``codes`` around one of ``places``."""
        size = self.length
        blocks = np.unique(places // size)
        found: set[int] = set()
        for first in np.unique(np.concatenate([np.maximum(blocks - 1, 0), blocks])).tolist():
            window = REGISTER | _hashed(codes[first * size:(first + 2) * size]).min(axis=1)
            low, high = np.searchsorted(self.keys, window, "left"), np.searchsorted(self.keys, window, "right")
            for h in np.flatnonzero(high > low):
                found.update(self.owners[low[h]:high[h]].tolist())
        return found


class Index:
    """All items of a block, partitioned by set size."""

    def __init__(self, items: list[tuple[int, str | None]], width: int):
        sets = [np.unique(codes) for codes in shingles(*word_codes([text for _, text in items]), width)]
        kept = [n for n, codes in enumerate(sets) if len(codes)]
        self.ids, self.sets = [items[n][0] for n in kept], [sets[n] for n in kept]
        by_size: dict[int, list[int]] = {}
        for i, codes in enumerate(self.sets):
            by_size.setdefault(1 << max(2, (len(codes) - 1).bit_length()), []).append(i)
        self.partitions = [Partition(size, members, self.sets) for size, members in sorted(by_size.items())]
        self.least = np.unique(np.concatenate([p.least for p in self.partitions])) if kept else np.empty(0, np.uint64)
        self.shift = np.uint64(64 - min(24, max(12, (64 * len(self.least)).bit_length())))
        self.flags = np.zeros(1 << (64 - int(self.shift)), bool)
        self.flags[self.least >> self.shift] = True

    def places(self, codes: np.ndarray) -> np.ndarray:
        """Where in ``codes`` a shingle stands that gave an item a minimum."""
        near = np.flatnonzero(self.flags[codes >> self.shift])
        at = np.searchsorted(self.least, codes[near])
        return near[self.least[np.minimum(at, len(self.least) - 1)] == codes[near]] if len(near) else near

    def search(self, codes: np.ndarray, share: float) -> list[tuple[int, int, int]]:
        """(item, shingles found, shingles of the item) for items of which ``codes`` holds at least ``share``."""
        places = self.places(codes)
        if not len(places):
            return []
        out = []
        for i in sorted(set().union(*(partition.candidates(codes, places) for partition in self.partitions))):
            found = int(np.isin(self.sets[i], codes).sum())
            if found >= share * len(self.sets[i]) - 1e-9:
                out.append((self.ids[i], found, len(self.sets[i])))
        return out


def contained(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
    width: int = 5, share: float = 0.8,
) -> DataFrame:
    """(doc_id, item_id, found, n_shingles, containment) for every document that holds ``share`` of an item's shingles."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    wanted = items.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("body")).filter("body is not null")
    size = wanted.agg(F.sum(F.length("body") + 64)).first()[0] or 0
    blocks = int(-(-size // BLOCK_CHARS)) or 1

    def searcher(block: int):
        part = [(r.item, r.body) for r in wanted.filter(F.pmod(F.xxhash64("item", "body"), F.lit(blocks)) == block).collect()]
        state: dict[str, Index] = {}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            if not state:
                state["index"] = Index(part, width)
            for piece in slices(batches):
                keys, hits = [], []
                sets = shingles(*word_codes(piece.column(1).to_pylist()), width)
                for key_value, codes in zip(piece.column(0).to_pylist(), sets, strict=True):
                    for hit in state["index"].search(codes, share):
                        keys.append(key_value)
                        hits.append(hit)
                columns = [pa.array(keys, pa.int64())] + [pa.array([h[k] for h in hits], pa.int64()) for k in range(3)]
                columns.append(pa.array([h[1] / h[2] for h in hits], pa.float64()))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "found", "n_shingles", "containment"])

        return run

    schema = "doc_id long, item_id long, found long, n_shingles long, containment double"
    return reduce(DataFrame.union, [rows.mapInArrow(searcher(block), schema) for block in range(blocks)])
