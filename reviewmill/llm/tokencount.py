"""Token counts by field or section: whole documents are encoded once, and tokens are attributed by their offsets.

Method: the ids of a document give the byte span of every token; an interval join of these spans with the spans of the
sections, both in ascending order, splits every token's bytes among the sections it meets. Allocation rule: a token
belongs, whole, to the section that holds most of its bytes, to the first of them where several hold equally many; a token that
meets no section, such as the line break between two lines, belongs to none. So the counts of all sections and of none add up to
the tokens of the document.

Sections are an array column of (section, begin, until) with offsets in code points, in ascending order and without overlap;
``lines`` and ``fields`` make such columns. Defined cases: a null text counts as empty; null or empty sections give no section, all tokens
then belong to none; empty sections get zero tokens; spans outside the text are cut to it. Repeated rows get equal
results; further columns pass through, clashing names give way to the result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm import bpe
from reviewmill.llm.common import add_columns

SPANS = "array<struct<section:int,begin:int,until:int>>"
COUNTS = "array<struct<section:int,n_tokens:int,n_crossing:int,n_bytes:int>>"


def lines(df: DataFrame, text: str = "text", out: str = "sections") -> DataFrame:
    """Append the spans of the lines of ``text``, numbered from 0; the breaks between them belong to none."""

    def compute(columns: list[list]) -> list:
        rows = []
        for value in columns[0]:
            spans, start = [], 0
            for n, line in enumerate(value.split("\n") if value else ()):
                spans.append({"section": n, "begin": start, "until": start + len(line)})
                start += len(line) + 1
            rows.append(spans)
        return [rows]

    return add_columns(df, [text], f"`{out}` {SPANS}", compute)


def fields(parts: list[Column], separator: str = "\n") -> tuple[Column, Column]:
    """(text, sections): the strings ``parts`` joined into one document, and the span of each; a null part is empty."""
    parts = [F.coalesce(part.cast("string"), F.lit("")) for part in parts]
    begin, spans = F.lit(0), []
    for n, part in enumerate(parts):
        until = begin + F.char_length(part)
        spans.append(F.struct(F.lit(n).alias("section"), begin.alias("begin"), until.alias("until")))
        begin = until + len(separator)
    return F.concat_ws(separator, *parts), F.array(*spans)


def allot(ends: np.ndarray, begins: np.ndarray, untils: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Section (index, or -1) of each token, and whether the token crosses a border of it; all positions are bytes.

    ``ends`` are the ascending ends of the tokens, each of which starts where the one before ends.
    """
    owner, most = np.full(len(ends), -1), np.zeros(len(ends), np.int64)
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    first, last = np.searchsorted(ends, begins, "right"), np.searchsorted(starts, untils, "left")
    counts = np.maximum(0, np.where(untils > begins, last - first, 0))
    section = np.repeat(np.arange(len(begins)), counts)
    token = np.arange(len(section)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(first, counts)
    shared = np.minimum(ends[token], untils[section]) - np.maximum(starts[token], begins[section])
    np.maximum.at(most, token, shared)
    for_this = np.flatnonzero(shared == most[token])[::-1]  # the first section is written last
    owner[token[for_this]] = section[for_this]
    return owner, (owner >= 0) & (most < ends - starts)


def attribute(
    df: DataFrame, rank_file: str, pattern: str, text: str = "text", sections: str = "sections", out: str = "counts", total: str = "n_tokens",
) -> DataFrame:
    """Replace ``sections`` by ``out``, an entry for each section and one with a null section for the tokens of none, and append ``total``."""
    with open(rank_file, "rb") as file:
        content = file.read()
    state: dict[str, bpe.Encoder] = {}

    def compute(columns: list[list]) -> list:
        if "encoder" not in state:
            state["encoder"] = bpe.Encoder(bpe.load(content), pattern)
        sizes = bpe.load(content).spelled[1]
        rows, totals = [], []
        for value, spans, ids in zip(*columns, state["encoder"].encode(columns[0]), strict=True):
            raw = np.frombuffer((value or "").encode(), np.uint8)
            at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # byte position of every code point
            ends = np.cumsum(sizes[np.frombuffer(ids, np.int32)])
            spans = spans or []
            begins, untils = (at[np.clip(np.array([s[k] for s in spans], np.int64), 0, len(at) - 1)] for k in ("begin", "until"))
            owner, crossing = allot(ends, begins, untils)
            counts, crossed = (np.bincount(x + 1, minlength=len(spans) + 1) for x in (owner, owner[crossing]))
            made = [{"section": s["section"], "n_tokens": int(c), "n_crossing": int(x), "n_bytes": max(0, int(b))}
                    for s, c, x, b in zip(spans, counts[1:], crossed[1:], untils - begins, strict=True)]
            made.append({"section": None, "n_tokens": int(counts[0]), "n_crossing": 0,
                         "n_bytes": len(raw) - sum(entry["n_bytes"] for entry in made)})
            rows.append(made)
            totals.append(len(ends))
        return [rows, totals]

    counted = add_columns(df, [text, sections], f"`{out}` {COUNTS}, `{total}` bigint", compute, rows=1024)
    return counted.drop(sections) if sections.lower() != out.lower() else counted
