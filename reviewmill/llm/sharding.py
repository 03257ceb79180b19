"""Shards of nearly equal size by minimax contiguous partition: the largest shard is as small as any contiguous cut allows.

Method: rows with equal texts form an atomic group, of the size of all its rows. Groups larger than a fair share of what is left
(at most one for each shard) get shards of their own. The others are ordered by their smallest id and get running totals; a binary
search finds the smallest capacity with which greedy filling needs no more shards than there are, and the cuts are put there.
Inside that capacity each cut goes to the group border nearest to an equal share of the rest, as far as the rest still fits, so
the last shards are not left small.

The running totals stay in Spark. The driver sees runs of neighbouring groups, at most about ``POINTS`` at a time: filling with
borders of runs only gives a capacity that suffices, filling as if a run could be cut anywhere one that is needed. Where the two
differ, the runs that a cut of either may fall in are read again in finer runs, until both agree; so the capacity is exact for any
number of groups.

Defined cases: a null text is an empty one and adds the overhead alone. Rows without id come first in their shard. Repeated rows
are rows of their own. With fewer groups than shards some shards stay empty; an empty table has no rows. Further columns of the
input are not read.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.operators import running
from reviewmill.session import publish

#: Runs of groups that the driver holds for one round of the search.
POINTS = 1 << 16


def text_digest(text: str = "text") -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """(key, size, text_crc32, digest) of every row: UTF-8 bytes and ``overhead``, unsigned CRC-32 and SHA-256 of the text."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("key"), (F.octet_length(whole) + overhead).cast("bigint").alias("size"),
                       F.crc32(whole.cast("binary")).alias("text_crc32"), text_digest(text).alias("digest"))


class Runs:
    """Runs of ordered groups between known borders, and greedy filling with them."""

    def __init__(self, total: int):
        self.total, self.starts, self.single = total, np.zeros(1, np.int64), np.zeros(1, bool)

    def refine(self, found: list[tuple[int, int]]) -> None:
        """Take in (start, groups) of finer runs; they cover whole runs of before, from start to start. Single groups stay so."""
        known = dict(zip(self.starts.tolist(), self.single.tolist(), strict=True))
        known.update([(start, groups == 1 or known.get(start, False)) for start, groups in found])
        self.starts = np.array(sorted(known), np.int64)
        self.single = np.array([known[s] for s in self.starts.tolist()], bool)

    def at(self, position: int) -> int:
        return int(np.searchsorted(self.starts, position, "right")) - 1

    def reach(self, start: int, capacity: int, anywhere: bool) -> int:
        """Where a shard that begins at ``start`` ends at the latest; ``anywhere``: as if runs of several groups could be cut anywhere."""
        limit = start + capacity
        if limit >= self.total:
            return self.total
        run = self.at(limit)
        return limit if anywhere and not self.single[run] else int(self.starts[run])

    def fits(self, start: int, shards: int, capacity: int, anywhere: bool = False) -> bool:
        for _ in range(shards):
            if start >= self.total:
                return True
            end = self.reach(start, capacity, anywhere)
            if end <= start:
                return False
            start = end
        return start >= self.total

    def capacity(self, shards: int, anywhere: bool) -> int:
        """The smallest capacity with which everything fits, by binary search."""
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.fits(0, shards, middle, anywhere):
                high = middle
            else:
                low = middle + 1
        return low

    def unsure(self, shards: int, low: int, high: int) -> list[tuple[int, int]]:
        """Stretches, one a cut at most, of runs that a cut of greedy filling with a capacity from ``low`` to ``high`` may fall in.

        Stretches begin and end with runs of several groups; where all runs are single groups, there is nothing to find out.
        """
        first = last = 0
        ends = np.append(self.starts[1:], self.total)
        out: list[tuple[int, int]] = []
        for _ in range(shards):
            if first + low >= self.total:
                break
            begin, until = self.at(first + low), self.at(min(last + high, self.total - 1)) + 1
            open_runs = begin + np.flatnonzero(~self.single[begin:until])
            if len(open_runs):
                stretch = int(self.starts[open_runs[0]]), int(ends[open_runs[-1]])
                if out and stretch[0] <= out[-1][1]:
                    stretch = out.pop()[0], stretch[1]
                out.append(stretch)
            first, last = max(first, self.reach(first, low, False)), self.reach(last, high, True)
        return out

    def cuts(self, shards: int, capacity: int) -> list[int]:
        """Starts of all shards but the first, none beyond ``capacity``, each as near to an equal share of the rest as that allows."""
        out, start = [], 0
        for left in range(shards, 1, -1):
            if start >= self.total:
                break
            low, high = self.at(start) + 1, self.at(min(start + capacity, self.total))
            if start + capacity >= self.total:
                high = len(self.starts)  # the end of everything
            border = np.append(self.starts, self.total)
            wanted = start + (self.total - start) / left
            pick = int(np.clip(np.searchsorted(border, wanted), low, high))
            if pick > low and wanted - border[pick - 1] <= border[pick] - wanted:
                pick -= 1
            if not self.fits(int(border[pick]), left - 1, capacity):
                bad, pick = pick, high
                while pick - bad > 1:
                    middle = (bad + pick) // 2
                    bad, pick = (bad, middle) if self.fits(int(border[middle]), left - 1, capacity) else (middle, pick)
            start = int(border[pick])
            out.append(start)
        return out


def _runs(ends: DataFrame, width: int, windows: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(start, groups) of the runs of groups that begin in the same ``width`` places of the same window."""
    inside = [F.col("before").between(a, b - 1) for a, b in windows]
    window = F.coalesce(*[F.when(c, F.lit(n)) for n, c in enumerate(inside)])
    found = ends.filter(reduce(Column.__or__, inside)).groupBy(window.alias("window"), F.floor(F.col("before") / width).alias("run")).agg(
        F.min("before").alias("start"), F.count(F.lit(1)).alias("groups"))
    return [(r.start, r.groups) for r in found.select("start", "groups").collect()]  # at most about POINTS rows


def find_cuts(ends: DataFrame, total: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity for (before, bytes) of ordered groups, and where shards begin."""
    runs, windows, width = Runs(total), [(0, total)], 4 * total
    while True:
        # Runs get at least four times shorter in each round; those of one place cannot be cut.
        width = max(1, min(width // 4, sum(b - a for a, b in windows) // POINTS))
        runs.refine([(start, 1 if width == 1 else groups) for start, groups in _runs(ends, width, windows)])
        needed, enough = runs.capacity(shards, True), runs.capacity(shards, False)
        windows = runs.unsure(shards, needed, enough) if needed < enough else []
        if not windows:
            return enough, runs.cuts(shards, enough)


def place_groups(groups: DataFrame, shards: int) -> DataFrame:
    """(digest, shard) of (digest, first, bytes): which shard each group goes to."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    largest = groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect()
    alone: list[bytes] = []
    for row in largest:
        if row.bytes * (shards - len(alone)) <= total:
            break
        alone.append(bytes(row.digest))
        total -= row.bytes
    rest = groups
    own = F.lit(None).cast("int")
    for n, digest in enumerate(alone):
        own = F.when(F.col("digest") == F.lit(digest), n).otherwise(own)
    if alone:
        rest = groups.filter(own.isNull())
    if not total:
        return groups.select("digest", own.alias("shard"))
    order = [F.col("first").asc_nulls_first(), F.col("digest")]
    ends = publish(running.totals_before(rest, order, {"before": F.col("bytes")}).select("digest", "bytes", "before"), "group-ends")
    _, cuts = find_cuts(ends, total, shards - len(alone))
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("before") >= cut).cast("int")
    placed = ends.select("digest", shard.cast("int").alias("shard"))
    return placed.unionByName(groups.filter(own.isNotNull()).select("digest", own.alias("shard"))) if alone else placed


def group_shards(rows: DataFrame, shards: int) -> DataFrame:
    """(digest, shard) of measured rows."""
    groups = rows.groupBy("digest").agg(F.min("key").alias("first"), F.sum("size").alias("bytes"))
    return place_groups(publish(groups, "text-groups"), shards)


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """(key, size, text_crc32, shard, slot) of every row; slots count from 0 in each shard, in order of the key."""
    rows = publish(measure(docs, key, text, overhead), "measured")
    placed = rows.join(group_shards(rows, shards), "digest").withColumn("copy", F.monotonically_increasing_id())
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("copy")]
    slots = running.numbered(placed, order, "slot", per=["shard"])
    return slots.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot")


def write(docs: DataFrame, path: str, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 16) -> None:
    """Write the rows below ``path``/shard=N, ordered by key; a large shard is written by several tasks."""
    rows = publish(measure(docs, key, text, overhead), "measured")
    joined = docs.withColumn("digest", text_digest(text)).join(group_shards(rows, shards), "digest").drop("digest")
    joined.repartitionByRange("shard", key).sortWithinPartitions("shard", key).write.partitionBy("shard").parquet(path)
