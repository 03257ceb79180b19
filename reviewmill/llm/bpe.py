"""Byte-level BPE: encoding and decoding with a published rank file.

Method: every pretoken owns a segment tree over its byte positions. A leaf holds ``rank * width + position`` of the pair
that starts there, so the root is the leftmost pair of lowest rank. A merge changes at most three leaves (the merged
position, its live predecessor, the swallowed position) and walks their paths to the root, O(log n) each. The trees of
many pretokens of similar length lie in one array and take their merges in step.

Defined cases: a null text counts as empty; an empty text has no ids; texts of any length are encoded whole; lone
surrogates cannot occur in Spark strings. Decoding returns bytes; ids outside the vocabulary raise an error. Further columns
pass through; one that carries the name of the result gives way to it.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from reviewmill.llm.common import add_columns

NONE = np.int64(1) << np.int64(60)


class Ranks:
    """Vocabulary with a hash table of every mergeable pair of ids."""

    def __init__(self, content: bytes):
        pairs = (line.split() for line in content.splitlines() if line.strip())
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        sizes, ordered = np.zeros(max(self.ids.values()) + 1, np.int64), sorted(self.ids.items(), key=lambda pair: pair[1])
        for token, rank in ordered:
            sizes[rank] = len(token)
        #: Where the bytes of each id start in all tokens' bytes, how many there are (0: no such id), and those bytes.
        self.spelled = np.cumsum(sizes) - sizes, sizes, np.frombuffer(b"".join(token for token, _ in ordered), np.uint8)
        self.single = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        keys, ranks = [], []
        for token, rank in self.ids.items():
            for cut in range(1, len(token)):
                left, right = self.ids.get(token[:cut]), self.ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ranks.append(rank)
        self._fill(np.array(keys, np.int64), np.array(ranks, np.int64))

    def _fill(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        """Open addressing with linear probing, at most a quarter full."""
        self.bits = max(4, int(len(keys) * 4).bit_length())
        size = 1 << self.bits
        self.keys, self.ranks = np.full(size, -1, np.int64), np.full(size, NONE, np.int64)
        slots, left, self.probes = self._slot(keys), np.arange(len(keys)), 0
        while len(left):
            free = self.keys[slots[left]] == -1
            put, first = np.unique(slots[left[free]], return_index=True)
            chosen = left[free][first]
            self.keys[put], self.ranks[put] = keys[chosen], ranks[chosen]
            left = np.setdiff1d(left, chosen)
            slots[left] = (slots[left] + 1) & (size - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of neighbours, NONE where they cannot merge."""
        keys = left << 32 | right
        slots = self._slot(keys)
        found = self.keys[slots]
        out = np.where(found == keys, self.ranks[slots], NONE)
        open_ = np.flatnonzero((found != keys) & (found != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.ranks[slots[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out


@lru_cache(maxsize=4)
def load(content: bytes) -> Ranks:
    return Ranks(content)


def _merge_group(words: list[bytes], width: int, ranks: Ranks) -> list[bytes]:
    """Ids (as int32 bytes) of words of more than width / 2 and at most ``width`` bytes, ``width`` a power of two."""
    n = len(words)
    sizes = np.fromiter(map(len, words), np.int64, n)
    column = np.arange(width)
    inside = column < sizes[:, None]
    ids = np.zeros((n, width), np.int64)
    ids[inside] = ranks.single[np.frombuffer(b"".join(words), np.uint8)]
    tree = np.full((n, 2 * width), NONE, np.int64)
    paired = np.zeros((n, width), bool)
    paired[:, :-1] = inside[:, 1:]
    row, at = np.nonzero(paired)
    first = ranks.pair(ids[row, at], ids[row, at + 1])
    tree[row, width + at] = np.where(first < NONE, first * width + at, NONE)
    level = width
    while level > 1:
        np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2], out=tree[:, level // 2:level])
        level //= 2
    after = np.broadcast_to(column + 1, (n, width)).copy()
    before = np.broadcast_to(column - 1, (n, width)).copy()
    flat, ids_, after_, before_ = tree.reshape(-1), ids.reshape(-1), after.reshape(-1), before.reshape(-1)
    alive = inside.copy().reshape(-1)
    rows = np.flatnonzero(tree[:, 1] < NONE)
    while len(rows):
        root = flat[rows * 2 * width + 1]
        pos, rank = root % width, root // width
        base = rows * width
        gone = after_[base + pos]
        follower = after_[base + gone]
        ids_[base + pos] = rank
        alive[base + gone] = False
        after_[base + pos] = follower
        has_next = follower < sizes[rows]
        before_[(base + follower)[has_next]] = pos[has_next]
        previous = before_[base + pos]
        has_previous = previous >= 0
        tops = rows * 2 * width
        flat[tops + width + gone] = NONE
        value = np.full(len(rows), NONE, np.int64)
        right = ranks.pair(rank[has_next], ids_[(base + follower)[has_next]])
        value[has_next] = np.where(right < NONE, right * width + pos[has_next], NONE)
        flat[tops + width + pos] = value
        left_at = previous[has_previous]
        left = ranks.pair(ids_[base[has_previous] + left_at], rank[has_previous])
        flat[tops[has_previous] + width + left_at] = np.where(left < NONE, left * width + left_at, NONE)
        node_a, node_b = width + pos, width + gone
        node_c = np.where(has_previous, width + previous, width + pos)
        while node_a[0] > 1:
            for node in (node_a, node_b, node_c):
                node >>= 1
            for node in (node_a, node_b, node_c):
                child = tops + 2 * node
                flat[tops + node] = np.minimum(flat[child], flat[child + 1])
        rows = rows[flat[tops + 1] < NONE]
    alive = alive.reshape(n, width)
    left = ids[alive].astype(np.int32).tobytes()
    ends = (4 * np.cumsum(alive.sum(axis=1))).tolist()
    return [left[start:end] for start, end in zip([0, *ends], ends, strict=False)]


def encode_words(words: list[bytes], ranks: Ranks, cells: int = 1 << 18) -> list[bytes]:
    """Ids of every word, as the bytes of an int32 array. ``cells`` bounds the array positions that are worked on together."""
    out: list[bytes] = [b""] * len(words)
    by_width: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        by_width.setdefault(1 << max(1, (len(word) - 1).bit_length()), []).append(i)
    for width, members in by_width.items():
        step = max(1, cells // width)
        for start in range(0, len(members), step):
            part = members[start:start + step]
            for i, ids in zip(part, _merge_group([words[i] for i in part], width, ranks), strict=True):
                out[i] = ids
    return out


class Remembered(dict):
    """A dictionary of two generations: when the younger is full it becomes the older, and entries in use come back."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def missing(self, keys: set[str]) -> list[str]:
        """Keys that neither generation knows; the others are in the younger one afterwards."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()
        new = []
        for key in keys.difference(self):
            value = self.older.get(key)
            if value is None:
                new.append(key)
            else:
                self[key] = value
        return new


class Encoder:
    """Encodes texts; remembers the ids of frequent pieces in dictionaries of bounded size."""

    def __init__(self, ranks: Ranks, pattern: str, limit: int = 200_000):
        import regex

        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.blanks = regex.compile(r"\s\s").search
        self.words, self.pieces = Remembered(limit), Remembered(limit)

    def _pieces(self, text: str) -> list[str]:
        """Cut before every single blank, a border of the pattern's matches wherever no two blanks meet."""
        return [text] if self.blanks(text) else text.replace(" ", "\0 ").split("\0") if "\0" not in text else [text]

    def _learn(self, pieces: set[str]) -> None:
        split = self.split
        cut = {piece: split(piece) for piece in self.pieces.missing(pieces)}
        words = self.words
        new = words.missing(set().union(*cut.values()))
        words.update(zip(new, encode_words([word.encode("utf-8") for word in new], self.ranks), strict=True))
        self.pieces.update({piece: words[parts[0]] if len(parts) == 1 else b"".join([words[x] for x in parts]) for piece, parts in cut.items()})

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as the bytes of an int32 array."""
        parts = [self._pieces(text) if text else [] for text in texts]
        self._learn(set().union(*parts))
        known = self.pieces
        out = [b"".join([known[piece] for piece in part]) for part in parts]
        for part in parts:  # whole texts are not worth remembering
            if len(part) == 1 and len(part[0]) > 64:
                known.pop(part[0], None)
        return out


def encode(df: DataFrame, rank_file: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace column ``text`` by ``ids`` (array of int): each match of ``pattern`` is merged separately.

    The rank file (below a megabyte for 50,000 tokens) is read by the driver and travels with the task.
    """
    with open(rank_file, "rb") as file:
        content = file.read()
    state: dict[str, Encoder] = {}

    def compute(columns: list[list]) -> list:
        if "encoder" not in state:
            state["encoder"] = Encoder(load(content), pattern)
        coded = state["encoder"].encode(columns[0])
        offsets = np.zeros(len(coded) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
        values = np.frombuffer(b"".join(coded), np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))]

    rest = [name for name in df.columns if name != text]
    made = add_columns(df, [text], f"`{ids}` array<int>", compute, rows=1024)
    return made.select(*[f"`{name}`" for name in rest if name.lower() != ids.lower()], f"`{ids}`")


def decode(df: DataFrame, rank_file: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Append ``out`` (binary): the bytes of the tokens in ``ids``; a null list counts as empty."""
    with open(rank_file, "rb") as file:
        content = file.read()

    def compute(columns: list[pa.Array]) -> list:
        starts, sizes, letters = load(content).spelled
        rows = columns[0]
        counts = np.nan_to_num(pc.list_value_length(rows).to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = rows.flatten().to_numpy(zero_copy_only=False)
        if len(flat) and not (flat.min() >= 0 and flat.max() < len(sizes) and sizes[flat].min()):
            raise ValueError("an id is outside the vocabulary")
        long = sizes[flat]
        ends = np.cumsum(long)
        from_ = np.repeat(starts[flat] - (ends - long), long) + np.arange(ends[-1] if len(ends) else 0)
        borders = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
        buffers = [None, pa.py_buffer(borders.tobytes()), pa.py_buffer(letters[from_].tobytes())]
        return [pa.BinaryArray.from_buffers(pa.binary(), len(rows), buffers)]

    return add_columns(df, [ids], f"`{out}` binary", compute, as_arrow=True)
