"""Near-duplicate documents by SetSketch registers, bands and exact confirmation.

Method: a document is the set of its word shingles. Each of ``REGISTERS`` hash functions gives the least value over the set;
read as an exponential variable of rate ``RATE`` it is stored as the truncated exponent ``1 - log(BASE, minimum)``. The
registers of a union are the maxima of the registers, and two registers agree with about the Jaccard similarity. Bands of
registers propose pairs, a likelihood over the registers that are larger, smaller and equal estimates their
similarity, and pairs in reach of the threshold are confirmed on the full sets.

Every step works on one representative of each class of equal word sequences, so a group of a million copies costs one row
per task. Buckets of a band propose a star around a centre (linear in the bucket). What a star cannot settle,
documents of a bucket outside the component that holds most of it, is then compared with the whole bucket: both
are packed into blocks of about ``BLOCK`` documents, a pair of blocks is one row, its sets are intersected exactly, and only links
that join two components come out. A pair is looked at in its first common band only.
At similarity 0.85 a pair shares no band with probability (1 - 0.85^4)^18 < 2e-6, at 0.8 with 8e-5.

Defined cases: a null or blank text has the empty set, forms its own component and is kept. A text with fewer words than a shingle
is one shingle. Rows that share a doc_id are one document; rows without doc_id link with nothing, their component
is null and they are kept. Ties go to the smallest doc_id. An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import shingles, slices, word_codes
from reviewmill.session import publish

BANDS, ROWS = 18, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_535
#: Standard errors of the estimate by which a pair may miss the threshold and still be confirmed on its sets.
MARGIN = 6
BLOCK = 256
#: Bits of the filter of wanted documents, a quarter of a megabyte for any number of them.
FILTER_BITS = 1 << 21

_random = np.random.default_rng(2021)
FACTOR = (_random.integers(0, 2**32, REGISTERS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
SHIFT = _random.integers(0, 2**32, REGISTERS, dtype=np.uint64).astype(np.uint32)


def registers(codes: np.ndarray, block: int = 4096) -> np.ndarray:
    """SetSketch of a set of 64-bit digests; the sketch of a union is the elementwise maximum."""
    least = np.full(REGISTERS, np.uint32(0xFFFFFFFF))
    short = (codes >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(short), block):
        hashed = FACTOR[:, None] * short[start:start + block] + SHIFT[:, None]
        np.minimum(least, hashed.min(axis=1), out=least)
    waiting = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(waiting) / np.log(BASE)), 0, TOP).astype(">u2")


def estimate(first: np.ndarray, second: np.ndarray, n_first: np.ndarray, n_second: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of pairs of sketches (rows) whose set sizes are known."""
    larger, smaller = (first > second).sum(axis=1), (first < second).sum(axis=1)
    equal = first.shape[1] - larger - smaller
    u = n_first / (n_first + n_second)
    v = 1 - u

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def fit(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        tiny = 1e-12
        return larger * np.log(up + tiny) + smaller * np.log(down + tiny) + equal * np.log(np.maximum(1 - up - down, 0) + tiny)

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood has one peak
        left, right = low + (high - low) / 3, high - (high - low) / 3
        better = fit(left) < fit(right)
        low, high = np.where(better, left, low), np.where(better, high, right)
    return (low + high) / 2


def sketch(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3) -> DataFrame:
    """(key, class_a, class_b, n_shingles, registers): the two class columns digest the sequence of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for piece in slices(batches):
            words, counts = word_codes(piece.column(1).to_pylist())
            ends = np.cumsum(counts).tolist()
            high, low, sizes, sketches = [], [], [], []
            for codes, n, end in zip(shingles(words, counts, width), counts.tolist(), ends, strict=True):
                if not n:
                    high.append(None), low.append(None), sizes.append(0), sketches.append(None)
                    continue
                codes = np.unique(codes)
                digest = xxhash.xxh3_128_digest(words[end - n:end].tobytes())
                high.append(int.from_bytes(digest[:8], "big", signed=True))
                low.append(int.from_bytes(digest[8:], "big", signed=True))
                sizes.append(len(codes))
                sketches.append(registers(codes).tobytes())
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).cast(pa.int64()), pa.array(high, pa.int64()), pa.array(low, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sketches, pa.binary())], names=["doc_id", "class_a", "class_b", "n_shingles", "registers"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, class_a long, class_b long, n_shingles long, registers binary")


def _buckets() -> Column:
    """One number for each band: its digest of the band's registers."""
    size = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(b), F.substring("registers", 1 + size * b, size)) for b in range(BANDS)])


def _stars(members: DataFrame) -> DataFrame:
    """(a, b), a < b: every member of a bucket with the bucket's centre, a member drawn by digest."""
    mask = F.xxhash64("bucket")
    centres = (
        members.groupBy("bucket").agg(F.min(F.col("id").bitwiseXOR(mask)).alias("least"), F.count("*").alias("n"))
        .filter("n > 1").select("bucket", F.col("least").bitwiseXOR(mask).alias("centre"))
    )
    joined = members.join(publish(centres, "centres"), "bucket").filter("id != centre")  # stored, so that a hot bucket can be split
    return joined.select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()


def _within_reach(pairs: DataFrame, sketches: DataFrame, share: float) -> DataFrame:
    """Pairs whose set sizes allow the threshold and whose estimate lies within MARGIN standard errors of it."""
    lowest = share - MARGIN * (share * (1 - share) / REGISTERS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 2048):
            if not piece.num_rows:
                continue
            sides = [np.frombuffer(b"".join(piece.column(c).to_pylist()), ">u2").reshape(-1, REGISTERS) for c in ("ra", "rb")]
            sizes = [piece.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("na", "nb")]
            keep = estimate(*sides, *sizes) >= lowest
            yield piece.select(["a", "b"]).filter(pa.array(keep))

    one = sketches.select(F.col("id").alias("a"), F.col("n_shingles").alias("na"), F.col("registers").alias("ra"))
    two = sketches.select(F.col("id").alias("b"), F.col("n_shingles").alias("nb"), F.col("registers").alias("rb"))
    sized = pairs.join(one, "a").join(two, "b").filter(F.least("na", "nb") >= F.greatest("na", "nb") * share - 1e-6)
    return sized.mapInArrow(run, "a long, b long")


def _filter_of(wanted: DataFrame) -> np.ndarray:
    """One bit for each slot that an id of ``wanted`` falls into; at most FILTER_BITS / 64 numbers reach the driver.

    Where ids are many the filter passes more than is wanted, and in the end everything; an exact join follows it.
    """
    slot = F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS))
    words = wanted.select((slot / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(xxhash64(id), {FILTER_BITS}) % 64 as int))").alias("bit"))
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bits[row.word] = row.bits
    return np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool)


def _sets(docs: DataFrame, wanted: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(id, codes): the sorted shingle digests of the documents in ``wanted``; texts of others are not shuffled."""
    passing = _filter_of(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            piece = piece.filter(pa.array(passing[piece.column(1).to_numpy(zero_copy_only=False)]))
            codes = [np.unique(x).tobytes() for x in shingles(*word_codes(piece.column(2).to_pylist()), width)]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(codes, pa.binary())], names=["id", "codes"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).filter("id is not null")
    slotted = rows.select("id", F.pmod(F.xxhash64("id"), F.lit(FILTER_BITS)).alias("slot"), "text")
    return slotted.mapInArrow(run, "id long, codes binary").join(wanted, "id", "left_semi")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            keep = []
            for left, right in zip(piece.column("ca").to_pylist(), piece.column("cb").to_pylist(), strict=True):
                first, second = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                shared = len(np.intersect1d(first, second, assume_unique=True))
                keep.append(100 * shared >= percent * (len(first) + len(second) - shared))
            yield piece.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one, two = (sets.select(F.col("id").alias(k), F.col("codes").alias(c)) for k, c in (("a", "ca"), ("b", "cb")))
    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that occurs in ``edges`` (a, b).

    Alternates large and small stars: each id hands its smallest neighbour to its larger, then to its smaller neighbours.
    Rounds grow with the logarithm of the longest path; every round is stored, so a lost executor costs one round.
    """
    links = publish(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "links")
    state = None
    while state != (state := tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())):
        both = links.union(links.select("v", "u"))
        least = publish(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = publish(large, "large-star")
        least = publish(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = publish(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    roots = links.select(F.col("v").alias("id")).distinct().select("id", F.col("id").alias("component"))
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """(bucket, id, component, main, blocks) of the buckets of three or more that hold several components.

    ``main`` is the component with most members of the bucket. Buckets of two were settled by their star.
    """
    placed = members.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"))
    mixed = mixed.filter("lo != hi and n > 2").select("bucket", "n")
    rows = placed.join(publish(mixed, "mixed-buckets"), "bucket")
    counted = rows.groupBy("bucket", "n", "component").count()
    main = counted.groupBy("bucket").agg(F.max("n").alias("n"), F.max_by("component", F.col("count")).alias("main"))
    main = publish(main.select("bucket", "main", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "main")
    return placed.join(main, "bucket")


def _pack(group: pa.Table) -> pa.Table:
    """One row for a block of a bucket: ids, components, bands and sets of its documents."""
    codes = group.column("codes").to_pylist()
    bands = group.column("buckets").combine_chunks().flatten().to_numpy()
    parts = [group.column("id").to_numpy(), group.column("component").to_numpy(), bands, np.array([len(c) // 8 for c in codes], np.int64)]
    cells = {"bucket": group.column("bucket")[0].as_py()} | dict(zip(("ids", "components", "bands", "sizes"), (x.tobytes() for x in parts), strict=True))
    kinds = {"bucket": pa.int64()}
    return pa.table({name: pa.array([value], kinds.get(name, pa.binary())) for name, value in (cells | {"codes": b"".join(codes)}).items()})


PACKED = ("ids", "components", "bands", "sizes", "codes")


def _compare(row: dict, percent: int) -> list[tuple[int, int]]:
    """Links between the documents of two blocks that join two components; exact, by counting common digests."""
    (ids, comps, bands, sizes), (ids_b, comps_b, bands_b, sizes_b) = (
        [np.frombuffer(row[name + side], np.int64) for name in PACKED[:-1]] for side in ("", "_b"))
    bands, bands_b = bands.reshape(-1, BANDS), bands_b.reshape(-1, BANDS)
    _, places = np.unique(np.frombuffer(row["codes"] + row["codes_b"], np.uint64), return_inverse=True)
    starts, here = np.cumsum(sizes) - sizes, int(sizes.sum())
    other = places[here:]
    starts_b = np.cumsum(sizes_b) - sizes_b
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    out, held = [], np.zeros(int(places.max(initial=-1)) + 1, np.int64)
    for n in range(len(ids)):
        own = places[starts[n]:starts[n] + sizes[n]]
        held[own] = 1
        shared = np.add.reduceat(held[other], starts_b)
        held[own] = 0
        same = bands[n] == bands_b
        first = np.where(same.any(axis=1), bands[n][same.argmax(axis=1)], 0) == row["bucket"]
        for m in np.flatnonzero(first & (comps[n] != comps_b) & (100 * shared >= percent * (sizes[n] + sizes_b - shared))):
            one, two = root(int(comps[n])), root(int(comps_b[m]))
            if one != two:
                parent[max(one, two)] = min(one, two)
                out.append((int(ids[n]), int(ids_b[m])))
    return out


def _rest(rows: DataFrame, bands: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links of the undecided documents of mixed buckets, as many as it takes to join their components."""
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    full = rows.join(bands, "id").join(sets, "id").select("bucket", "id", "component", "buckets", "codes", block.alias("block"),
                                                         (F.col("component") != F.col("main")).alias("minor"))
    schema = "bucket long, ids binary, components binary, bands binary, sizes binary, codes binary"
    every = full.groupBy("bucket", "block").applyInArrow(_pack, schema)
    minor = full.filter("minor").groupBy("bucket", "block").applyInArrow(_pack, schema)
    pairs = minor.join(every.select("bucket", *[F.col(n).alias(f"{n}_b") for n in PACKED]), "bucket")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for pair in slices(batches, 1):
            found = _compare(pair.to_pylist()[0], percent)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


def link(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 3, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row; documents with similarity >= percent / 100 are linked."""
    share = percent / 100
    rows = publish(sketch(docs, key, text, width), "sketches")
    full = rows.filter("n_shingles > 0 and doc_id is not null")
    classes = publish(full.groupBy("class_a", "class_b").agg(F.min("doc_id").alias("id")), "classes")
    own = full.select(F.col("doc_id").alias("id"), "class_a", "class_b", "n_shingles", "registers")
    firsts = own.join(classes, ["id", "class_a", "class_b"]).dropDuplicates(["id", "class_a", "class_b"])
    sketches = publish(firsts.select("id", "n_shingles", "registers"), "representatives")
    bands = sketches.select("id", _buckets().alias("buckets"))
    members = bands.select("id", F.explode("buckets").alias("bucket"))
    tried = publish(_within_reach(_stars(members), sketches, share), "candidates")
    sets = publish(_sets(docs, tried.select(F.explode(F.array("a", "b")).alias("id")).distinct(), key, text, width), "sets")
    edges = publish(_confirm(tried, sets, percent), "edges")
    found = publish(components(edges), "components")
    mixed = publish(_mixed(members, found), "mixed")
    more_sets = publish(_sets(docs, mixed.select("id").distinct(), key, text, width), "sets")
    more = publish(_rest(mixed, bands, more_sets, percent), "edges")
    if not more.isEmpty():
        stars = found.filter("id != component").select(F.col("id").alias("a"), F.col("component").alias("b"))
        found = publish(components(stars.union(more)), "components")
    named = classes.join(found, "id", "left").select("class_a", "class_b", F.coalesce("component", "id").alias("component_id"))
    linked = full.join(named, ["class_a", "class_b"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
