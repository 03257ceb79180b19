"""Substring deduplication by hashed units: passages that repeat across documents stay once.

Method: a text is cut into lines and, within lines, into sentences (after a full stop, question or exclamation mark, and before a
capital that follows a word without one, so a passage pasted into a sentence starts a unit of its own). A piece of fewer than
``MIN_UNIT`` words joins the next piece of its line. Long units are cut again where the words themselves say so, at local minima of
word digests, so that a passage of one long sentence, in capitals or joined to a short piece yields the same units from its first
such word on, wherever it starts. Units are normalised (A-Z lower-cased, blanks collapsed) and hashed;
digests are grouped over all documents. The occurrence in the smallest doc_id, there the first, is kept. All others are
marked, and every run of marked neighbours that holds at least ``min_words`` words (25 by default) is cut out. In scripts without
blanks between words, letters are counted. Shorter runs stay, as greetings, licence
lines and other stock phrases repeat in clean documents. Offsets always refer to the original text, in code points.

A text is cut into units once. Their offsets, sizes and digests are stored; marks and runs are found on those narrow rows, and the
texts then meet nothing but the spans to remove, which Spark's own functions cut out.

Defined cases: a null text stays null with no spans, an empty one stays empty. Rows that share a doc_id count as one document, so
they do not repeat each other. Rows without doc_id are returned unchanged and take part in nothing. A text that repeats
wholly becomes empty. Further columns pass through; ``removed`` and ``kept`` give way to the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.names import free_names
from reviewmill.llm.common import slices
from reviewmill.session import publish

MIN_UNIT, MIN_RUN = 4, 25
#: A word ends a unit inside a long one if its digest is the least among so many words on either side.
REACH = 4

#: Where a piece may end: blanks after the end of a sentence, before a capital, or with a line break in them.
BORDER = re.compile(r"(?<=[.!?])\s+|(?<=[。！？])\s*|[ \t]*\n\s*|[ \t]+(?=[A-ZÀ-ÖØ-Þ])")
ENDS = frozenset(".!?。！？")
#: Letters of scripts without blanks between words (Thai to Khmer, kana, Han); each counts as a word.
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
SIGN = re.compile(f"[{UNSPACED}]")
COUNTED = re.compile(f"[{UNSPACED}]|[^ \\t\\n\\r\\x0b\\x0c{UNSPACED}]+")
WORD = re.compile(r"[^ \t\n\r\x0b\x0c]+")


def units(text: str) -> list[tuple[int, int, int, int]]:
    """(start, end, words, digest) of every unit, in order; blanks between units belong to none."""
    import xxhash

    digest = xxhash.xxh3_64_intdigest
    out: list[tuple[int, int, int, int]] = []
    open_start, open_words, line_first = 0, [], 0

    unspaced = SIGN.search(text) is not None

    def size(start: int, end: int, words: int) -> int:
        return len(COUNTED.findall(text, start, end)) if unspaced else words

    def close(start: int, end: int, words: list[bytes]) -> None:
        done = 0
        if len(words) > 2 * REACH + 1:
            codes, spans = [crc32(word) for word in words], None
            for n in range(REACH, len(words) - REACH - 1):
                if codes[n] == min(codes[n - REACH:n + REACH + 1]) and codes[n] not in codes[n - REACH:n]:
                    spans = spans or [m.span() for m in WORD.finditer(text, start, end)]
                    out.append((start, spans[n][1], size(start, spans[n][1], n + 1 - done), digest(b" ".join(words[done:n + 1])) - 2**63))
                    start, done = spans[n + 1][0], n + 1
        out.append((start, end, size(start, end, len(words) - done), digest(b" ".join(words[done:])) - 2**63))

    def word_start(begin: int, end: int) -> int:
        return max(text.rfind(" ", begin, end), text.rfind("\t", begin, end), begin - 1) + 1

    borders, position = [], 0
    for m in BORDER.finditer(text):
        end, line_end = m.start(), "\n" in m[0]
        # A capital is a border only after a word without one: in title case and capitals every blank would be.
        if line_end or text[end - 1:end] in ENDS or not text[word_start(position, end)].isupper():
            borders.append((end, m.end(), line_end))
        position = m.end()
    borders.append((len(text), len(text), True))
    position = 0
    for end, following, line_end in borders:
        words = text[position:end].encode().lower().split()
        if words:
            if not open_words:
                open_start = position
            open_words += words
            if size(open_start, end, len(open_words)) >= MIN_UNIT:
                close(open_start, end, open_words)
                open_words = []
            elif line_end and len(out) > line_first:  # the short rest of a line joins its last unit
                start = out.pop()[0]
                close(start, end, text[start:end].encode().lower().split())
                open_words = []
        if line_end:
            if open_words:
                close(open_start, end, open_words)
                open_words = []
            line_first = len(out)
        position = following
    return out


def _units(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, version, starts, words, digests, own, size): the units of a text in order, and its length in code points.

    ``version`` tells texts of one key apart; ``own`` has the places of units that the same text holds further up.
    """
    schema = "key long, version long, starts array<int>, words array<int>, digests array<long>, own array<int>, size int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
        for piece in slices(batches):
            rows: list[list] = [[], [], [], [], []]
            for value in piece.column(2).to_pylist():
                found, seen, own = units(value) if value else [], set(), []
                for n, unit in enumerate(found):
                    if unit[3] in seen:
                        own.append(n)
                    seen.add(unit[3])
                for column, item in zip(rows, ([u[0] for u in found], [u[2] for u in found], [u[3] for u in found], own, len(value or "")), strict=True):
                    column.append(item)
            arrays = [pa.array(column, kind) for column, kind in zip(rows, (ints, ints, longs, ints, pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), *arrays],
                                             names=["key", "version", "starts", "words", "digests", "own", "size"])

    rows = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.xxhash64(text).alias("version"), F.col(text))
    return rows.mapInArrow(run, schema)


def removable(starts: list[int], words: list[int], flagged: set[int], size: int, min_words: int) -> list[tuple[int, int]]:
    """The spans of runs of flagged units that hold at least ``min_words`` words; a span ends where the next unit starts."""
    out, n = [], 0
    while n < len(starts):
        stop = n
        while stop < len(starts) and stop in flagged:
            stop += 1
        if stop > n and sum(words[n:stop]) >= min_words:
            out.append((starts[n], starts[stop] if stop < len(starts) else size))
        n = max(stop, n + 1)
    return out


SPANS = "array<struct<begin:int,until:int>>"


def _cuts(stored: DataFrame, marks: DataFrame, min_words: int) -> DataFrame:
    """(key, version, removed) of the texts that lose something."""
    touched = stored.drop("digests").join(marks, ["key", "version"], "left").filter("size(own) > 0 OR marked IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("begin", pa.int32()), ("until", pa.int32())]))
        for piece in slices(batches):
            found = [[{"begin": a, "until": b} for a, b in removable(r["starts"], r["words"], {*r["own"], *(r["marked"] or ())}, r["size"], min_words)]
                     for r in piece.select(["starts", "words", "own", "marked", "size"]).to_pylist()]
            yield pa.RecordBatch.from_arrays([piece.column("key"), piece.column("version"), pa.array(found, kind)], names=["key", "version", "removed"])

    spans = touched.mapInArrow(run, f"key long, version long, removed {SPANS}").filter(F.size("removed") > 0)
    return spans.groupBy("key", "version").agg(F.any_value("removed").alias("removed"))  # equal rows have equal spans


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_RUN) -> DataFrame:
    """``docs`` with shortened texts, and the spans ``removed`` and ``kept`` as (begin, until) offsets of the original."""
    stored = publish(_units(docs, key, text), "units")
    spread = stored.select("key", "version", F.posexplode("digests").alias("n", "digest"))
    repeated = spread.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).filter("first != last").drop("last")
    repeated = publish(repeated, "repeated")  # stored, so that the join can split a digest that a third of all units share
    marks = spread.join(repeated, "digest").filter("key != first").groupBy("key", "version").agg(F.collect_list("n").alias("marked"))
    cuts = publish(_cuts(stored, marks, min_words), "cuts")
    key_name, version, spans = free_names([*docs.columns, "removed", "kept"], "key", "version", "spans")
    cuts = cuts.select(F.col("key").alias(key_name), F.col("version").alias(version), F.col("removed").alias(spans))
    rows = docs.withColumn(key_name, F.col(key).cast("long")).withColumn(version, F.xxhash64(text)).join(cuts, [key_name, version], "left")
    gone = F.coalesce(F.col(spans), F.array().cast(SPANS))
    begins, ends = F.concat(F.array(F.lit(0)), gone["until"]), F.concat(gone["begin"], F.array(F.coalesce(F.length(text), F.lit(0))))
    between = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("begin"), b.alias("until")))
    kept = F.filter(between, lambda s: s["until"] > s["begin"])
    shorter = F.array_join(F.transform(kept, lambda s: F.substring(text, s["begin"] + 1, s["until"] - s["begin"])), "")
    names = [name for name in docs.columns if name.lower() not in ("removed", "kept")]
    left = F.when(F.col(spans).isNull(), F.col(text)).otherwise(shorter)
    return rows.select(*[left.alias(text) if name == text else F.col(f"`{name}`") for name in names], gone.alias("removed"), kept.alias("kept"))
