"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows taken out of an Arrow batch at once, so that Python holds few texts as objects.
SLICE_ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into pieces of at most ``rows`` rows, without copying."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def free_name(taken: Iterable[str], wanted: str) -> str:
    """``wanted``, or the first of wanted_1, wanted_2, … that no column carries (case ignored)."""
    used = {name.lower() for name in taken}
    if wanted.lower() not in used:
        return wanted
    return next(f"{wanted}_{n}" for n in count(1) if f"{wanted}_{n}".lower() not in used)


def add_columns(
    df: DataFrame, inputs: list[str], fields: str, compute: Callable[[list], list], rows: int = SLICE_ROWS, as_arrow: bool = False,
) -> DataFrame:
    """Append columns that ``compute`` derives from slices of the ``inputs`` columns.

    ``fields`` is a DDL string. ``compute`` gets one Python list (or Arrow array) per input column and returns one Arrow
    array or list per field. Columns of ``df`` that already carry a new name give way to it.
    """
    added = StructType.fromDDL(fields)
    kept = [name for name in df.columns if name.lower() not in {f.name.lower() for f in added}]
    carried = kept + [name for name in inputs if name not in kept]
    schema = StructType([df.schema[name] for name in kept] + list(added))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        for piece in slices(batches, rows):
            given = [piece.column(carried.index(name)) for name in inputs]
            made = compute(given if as_arrow else [column.to_pylist() for column in given])
            columns = [piece.column(i).cast(target.field(i).type) for i in range(len(kept))]
            for position, values in enumerate(made, len(kept)):
                kind = target.field(position).type
                columns.append(values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind))
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    return df.select(*[F.col(f"`{name}`") for name in carried]).mapInArrow(run, schema)


def mix64(values: np.ndarray) -> np.ndarray:
    """Invertible 64-bit finaliser (the constants are the published ones of splitmix64)."""
    with np.errstate(over="ignore"):
        z = values ^ (values >> np.uint64(30))
        z = z * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(27)
        z = z * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


#: The six ASCII blanks part words; every other byte belongs to a word.
IN_WORD = np.ones(256, bool)
IN_WORD[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
FIRST_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
#: Words of more bytes than this are hashed one by one.
LONG_WORD = 32


def word_codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the words of all texts in a row, and the number of words of each text.

    Words are maximal runs outside the ASCII blanks, A-Z lower-cased; a null text has none. Eight bytes of all words are
    taken in at a time.
    """
    import xxhash

    raw = [text.encode("utf-8").lower() if text else b"" for text in texts]
    joined = b"\n".join(raw)
    inside = np.zeros(len(joined) + 2, bool)
    np.take(IN_WORD, np.frombuffer(joined, np.uint8), out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    padded = joined + bytes(8)
    blocks = np.ndarray((len(joined) + 1,), "<u8", padded, strides=(1,))
    codes = sizes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    at, left, rows = starts, sizes, slice(None)
    for _ in range(LONG_WORD // 8):
        codes[rows] = mix64(codes[rows] ^ (blocks[at] & FIRST_BYTES[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        rows = more if isinstance(rows, slice) else rows[more]
        at, left = at[more] + 8, left[more] - 8
        if not len(rows):
            break
    for n in rows if not isinstance(rows, slice) else ():
        codes[n] = xxhash.xxh3_64_intdigest(joined[starts[n]:starts[n] + sizes[n]])
    ends = np.cumsum([len(x) + 1 for x in raw])
    return codes, np.diff(np.searchsorted(starts, ends), prepend=0)


_random = np.random.default_rng(64)
_MULTIPLIERS = _random.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(codes: np.ndarray, counts: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the digests of all its runs of ``width`` words, in order; one of all its words if there are fewer."""
    with np.errstate(over="ignore"):
        runs = max(0, len(codes) - width + 1)
        total = np.full(runs, np.uint64(width) * np.uint64(0xD6E8FEB86659FD93))
        for k in range(width):
            total += codes[k:k + runs] * _MULTIPLIERS[k]
        total = mix64(total)
        out, start = [], 0
        for n in counts.tolist():
            if n >= width:
                out.append(total[start:start + n - width + 1])
            elif n:
                short = np.uint64(n) * np.uint64(0xD6E8FEB86659FD93) + (codes[start:start + n] * _MULTIPLIERS[:n]).sum(dtype=np.uint64)
                out.append(mix64(np.array([short], np.uint64)))
            else:
                out.append(codes[:0])
            start += n
        return out
