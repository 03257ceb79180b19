"""Indexes for pages far into an order (T5, Q9) and for substring search (P11, Q9) over tables too large to sort or scan each time.

Both store the rows once, in ranges of an order, one folder a range, and beside them a small table of one row a range.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from reviewmill import session
from reviewmill.functions import rules
from reviewmill.functions.names import free_names
from reviewmill.operators import running


@dataclass
class Ranges:
    """Rows stored by ranges of an order; ``part`` is the folder of a range, ``row`` ascends with the order."""

    rows: DataFrame
    part: str
    row: str
    columns: list[str]

    def read(self, parts: list[int]) -> DataFrame:
        """The rows of some ranges; no other folder is opened."""
        return self.rows.filter(F.col(self.part).isin(parts)) if parts else self.rows.limit(0)


def store_ranges(df: DataFrame, order: list[Column], label: str, number: int | None = None) -> Ranges:
    """``number`` ranges, or as many as Spark makes by their size."""
    part, row = free_names(df.columns, "part", "row")
    ranged = (df.repartitionByRange(number, *order) if number else df.repartitionByRange(*order)).sortWithinPartitions(*order)
    placed = ranged.withColumns({part: F.spark_partition_id(), row: F.monotonically_increasing_id()})
    path = session.scratch_path(df.sparkSession, label)
    placed.write.partitionBy(part).parquet(path)
    schema = StructType([*df.schema, StructField(row, LongType()), StructField(part, IntegerType())])
    return Ranges(df.sparkSession.read.schema(schema).parquet(path), part, row, df.columns)


# --- pages --------------------------------------------------------------------------------------

@dataclass
class PageIndex:
    """Ranges of an order and, for each, how many rows come before it: (part, n, before)."""

    ranges: Ranges
    counts: DataFrame

    def page(self, number: int = 1, size: int = 20) -> DataFrame:
        """One page: whatever its number, the ranges that it lies in are read and no others."""
        skip, ranges = (number - 1) * size, self.ranges
        hit = self.counts.filter((F.col("before") < skip + size) & (F.col("before") + F.col("n") > skip)).collect()  # ``size`` ranges at most
        rows = ranges.read([r["part"] for r in hit]).orderBy(ranges.row)
        gone = skip - min((r["before"] for r in hit), default=skip)
        return (rows.offset(gone) if gone else rows).limit(size).select(*[F.col(f"`{c}`") for c in ranges.columns])


def page_index(df: DataFrame, order: list[Column], number: int | None = None) -> PageIndex:
    """Index of a table for pages in one order, which must tell all rows apart; ``number`` ranges, or as many as Spark makes."""
    ranges = store_ranges(df, order, "page-index", number)
    counts = ranges.rows.groupBy(F.col(ranges.part).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = running.totals_before(counts, [F.col("part")], {"before": F.col("n")})
    return PageIndex(ranges, session.publish(before, "page-counts"))


# --- substrings -----------------------------------------------------------------------------------

#: Bits of the filter of one range, as Spark's bitmap functions make them: 4 KB.
FILTER_BITS = 32768
GRAM = 3


def _slot(gram: Column) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(FILTER_BITS))


@dataclass
class SearchIndex:
    """Ranges of a table and, for each, which runs of three letters its texts hold: (part, bits)."""

    ranges: Ranges
    filters: DataFrame
    texts: list[str]

    def parts(self, term: str) -> list[int]:
        """The ranges that may hold the term; all of them if it has fewer than three letters."""
        grams = sorted({term.lower()[n:n + GRAM] for n in range(len(term) - GRAM + 1)})
        found = self.filters
        for gram in grams:
            slot = _slot(F.lit(gram))
            byte = F.conv(F.hex(F.substring("bits", F.floor(slot / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            found = found.filter(byte.bitwiseAND(F.pow(F.lit(2), slot % 8).cast("int")) != 0)
        return sorted(r["part"] for r in found.select("part").collect())  # numbers of ranges

    def search(self, term: str) -> DataFrame:
        """Rows of which a text contains the term, case ignored: the same as a scan, from the ranges that may hold it."""
        ranges = self.ranges
        return ranges.read(self.parts(term)).filter(rules.matches_any(self.texts, term)).select(*[F.col(f"`{c}`") for c in ranges.columns])


def search_index(df: DataFrame, texts: list[str], order: list[Column], number: int | None = None) -> SearchIndex:
    """Index of some text columns. Rows that lie together in ``order`` share a filter, so an order that keeps like texts together sharpens it."""
    ranges = store_ranges(df, order, "search-index", number)
    body = F.lower(F.concat_ws("\n", *[F.col(f"`{t}`") for t in texts]))
    # An empty match ahead of each run takes the runs out in one pass over the text.
    grams = F.regexp_extract_all("body", F.lit(rf"(?s)(?=(.{{{GRAM}}}))"), F.lit(1))
    bits = ranges.rows.select(F.col(ranges.part).alias("part"), body.alias("body")).select("part", F.explode_outer(grams).alias("gram"))
    # A hash aggregate leaves each range FILTER_BITS rows at most a task; the bitmap is a sorted aggregate, which would order all runs.
    slots = bits.select("part", F.when(F.col("gram").isNotNull(), _slot(F.col("gram"))).alias("slot")).distinct()
    filters = slots.groupBy("part").agg(F.bitmap_construct_agg("slot").alias("bits"))
    return SearchIndex(ranges, session.publish(filters, "search-filters"), texts)
