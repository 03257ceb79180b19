"""Approximate nearest neighbours by cosine, with a hash-prefix forest.

Method: each tree hashes a vector to a string of ``BITS`` signs against random hyperplanes and keeps its rows as a sorted array of
those strings. A query descends every tree to the entries that share the longest prefix with its own string, and then ascends in
all trees at once, one bit at a time, until the entries met are the wanted share of the rows; those are scored exactly.

The index is cut into cells of about ``CELL_ROWS`` rows and the queries into tiles of ``TILE_QUERIES`` at most, both drawn by digest.
A task takes one cell and one tile, grows the forest of the cell and searches it for the queries block by block; the best k of each
cell are merged. So no task holds more than one cell, one tile and one block, vectors travel in the type they are stored in, a row
travels once for each tile of queries and a query once for each cell. The share is fitted for each dimension: the smallest at which ``SAMPLE_QUERIES`` queries over a sample of ``SAMPLE_ROWS`` rows
reach ``AIM`` recall against brute force; a dimension with no more rows than that is searched whole. Data without structure needs a large share, clustered data a small one. Recall rises with the
size of a cell, so the sample, smaller than a cell, errs on the safe side.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no part, neither as query nor as candidate;
nor do rows without id. Vectors of different lengths are not compared. Equal rows count once; a query never finds its own id. Ties
go to the smaller id; with fewer than k candidates all are returned. Further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import publish

TREES, BITS = 48, 32
CELL_ROWS, TILE_QUERIES, BLOCK_QUERIES = 65_536, 65_536, 256
#: Pairs of cell and tile that a small table is cut into, so that all cores take part.
LEAST_PAIRS = 24
SAMPLE_ROWS, SAMPLE_QUERIES, AIM = 4096, 256, 0.97
SHARES = (0.01, 0.02, 0.05, 0.1, 0.15, 0.2, 0.25, 0.3, 0.35, 0.4, 0.5, 0.6, 0.8, 1.0)


@lru_cache(maxsize=4)
def _planes(dimension: int) -> np.ndarray:
    return np.random.default_rng(dimension).normal(size=(dimension, TREES * BITS))


def _strings(vectors: np.ndarray) -> np.ndarray:
    """Hash strings as numbers, one row for each tree."""
    out = np.empty((TREES, len(vectors)), np.uint32)
    for start in range(0, len(vectors), 1024):
        signs = (vectors[start:start + 1024] @ _planes(vectors.shape[1]) > 0).reshape(-1, TREES, BITS)
        out[:, start:start + 1024] = np.packbits(signs, axis=2).view(">u4")[:, :, 0].T
    return out


class Forest:
    """Sorted hash strings of one cell."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, order: np.ndarray, strings: np.ndarray):
        self.ids, self.vectors, self.order, self.strings = ids, vectors, order, strings
        self.unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]

    @classmethod
    def grow(cls, ids: np.ndarray, vectors: np.ndarray) -> Forest:
        strings = _strings(vectors)
        order = np.argsort(strings, axis=1, kind="stable").astype(np.int32)
        return cls(ids, vectors, order, np.take_along_axis(strings, order, axis=1))

    def ranges(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[depth][tree][query]: the stretch of each sorted array whose strings share the first ``depth`` bits with the query."""
        wanted = _strings(queries)
        low, high = (np.empty((BITS + 1, *wanted.shape), np.int32) for _ in range(2))
        for depth in range(BITS + 1):
            rest = np.uint32((1 << (BITS - depth)) - 1)
            for tree in range(TREES):
                low[depth, tree] = np.searchsorted(self.strings[tree], wanted[tree] & ~rest, "left")
                high[depth, tree] = np.searchsorted(self.strings[tree], wanted[tree] | rest, "right")
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray, quota: int) -> np.ndarray:
        """Rows met by one query when the trees are left together at the deepest level that yields ``quota`` rows."""
        met = np.zeros(len(self.ids), bool)
        deep = np.flatnonzero((high - low).sum(axis=1) >= quota)
        for depth in range(int(deep[-1]) if len(deep) else 0, -1, -1):
            for tree in range(TREES):
                met[self.order[tree, low[depth, tree]:high[depth, tree]]] = True
            if np.count_nonzero(met) >= quota:
                break
        return np.flatnonzero(met)

    def nearest(self, own: int, query: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and cosines of the best k of ``rows``; equal vectors get equal cosines."""
        rows = rows[self.ids[rows] != own]
        if not len(rows):
            return self.ids[:0], np.empty(0)
        length = np.sqrt((query * query).sum())
        rough = self.unit[rows] @ (query / length)
        least = np.partition(rough, -k)[-k] if len(rows) > k else -2.0
        rows = rows[rough >= least - 1e-9]
        found = self.vectors[rows]
        exact = (found * query).sum(axis=1) / (np.sqrt((found * found).sum(axis=1)) * length)
        best = np.lexsort((self.ids[rows], -exact))[:k]
        return self.ids[rows[best]], exact[best]

    def search(self, owns: np.ndarray, queries: np.ndarray, share: float, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        low, high = self.ranges(queries)
        quota = min(len(self.ids), max(k + 1, int(np.ceil(share * len(self.ids)))))
        return [self.nearest(own, query, self.candidates(low[:, :, n], high[:, :, n], quota), k)
                for n, (own, query) in enumerate(zip(owns, queries, strict=True))]


def _valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v, dim, digest): the rows that take part, each once."""
    kind = "array<float>" if df.select(vector).schema[0].dataType.simpleString() == "array<float>" else "array<double>"
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast(kind).alias("v")).filter("id is not null and size(v) > 0")
    unfit = "exists(v, x -> x is null or isnan(x) or double(x) in (double('Infinity'), double('-Infinity'))) or not exists(v, x -> x != 0)"
    kept = rows.filter(~F.expr(unfit)).withColumn("dim", F.size("v")).withColumn("digest", F.xxhash64("v"))
    return kept.dropDuplicates(["id", "digest"])


def fit_share(sample: DataFrame, k: int) -> float:
    """Smallest share that reaches AIM on a sample of rows of one dimension."""
    chosen = sample.collect()  # SAMPLE_ROWS at most
    forest = Forest.grow(np.array([r.id for r in chosen]), np.array([r.v for r in chosen]))
    few = slice(0, SAMPLE_QUERIES)
    truth = [set(found.tolist()) for found, _ in forest.search(forest.ids[few], forest.vectors[few], 1.0, k)]
    for share in SHARES:
        got = [set(found.tolist()) for found, _ in forest.search(forest.ids[few], forest.vectors[few], share, k)]
        if sum(len(a & b) for a, b in zip(truth, got, strict=True)) >= AIM * sum(map(len, truth)):
            return share
    return 1.0


def fit_shares(rows: DataFrame, sizes: dict[int, int], k: int) -> dict[int, float]:
    """The share for each dimension, from its SAMPLE_ROWS rows of smallest digest; one with no more rows is searched whole."""
    return {dim: 1.0 if n <= SAMPLE_ROWS else fit_share(
        rows.filter(F.col("dim") == dim).select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS), k) for dim, n in sizes.items()}


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def pieces(rows: int, asked: int) -> tuple[int, int]:
    """Cells of the rows and tiles of the queries of one dimension."""
    cells = max(1, -(-rows // CELL_ROWS))
    return cells, max(1, -(-asked // TILE_QUERIES), min(-(-asked // BLOCK_QUERIES), -(-LEAST_PAIRS // cells)))


def _of_dimension(numbers: dict[int, int]) -> Column:
    """The number that belongs to the dimension of a row."""
    return F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col("dim")]


def _places(number: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), (number - 1).cast("int")))


def knn(df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row for which ``is_query`` (an expression of ``id``) holds."""
    rows = publish(_valid(df, key, vector), "vectors")
    answer = "query_id long, rank int, vec_id long, score double"
    sizes = {r.dim: r.n for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    queries = rows.filter(is_query)
    asked = {r.dim: r.n for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    if not asked:
        return df.sparkSession.createDataFrame([], answer)
    shares = fit_shares(rows, {dim: sizes[dim] for dim in asked}, k)
    cut = {dim: pieces(sizes[dim], n) for dim, n in asked.items()}
    cells, tiles = (_of_dimension({dim: both[n] for dim, both in cut.items()}) for n in (0, 1))
    drawn = F.xxhash64("id", "digest")
    taking = rows.filter(F.col("dim").isin(list(asked)))
    index = taking.select("dim", F.pmod(drawn, cells).cast("int").alias("cell"), _places(tiles).alias("tile"), "id", "v")
    sent = queries.select("dim", _places(cells).alias("cell"), F.pmod(drawn, tiles).cast("int").alias("tile"), "id", "v", "digest")
    found = pa.schema([("query_id", pa.int64()), ("digest", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(cell: pa.Table, tile: pa.Table) -> pa.Table:
        if not cell.num_rows or not tile.num_rows:
            return found.empty_table()
        dim = cell.column("dim")[0].as_py()
        forest = Forest.grow(cell.column("id").to_numpy(), _matrix(cell.column("v"), dim))
        out = []
        for start in range(0, tile.num_rows, BLOCK_QUERIES):
            block = tile.slice(start, BLOCK_QUERIES)
            owns, digests = (block.column(name).to_numpy() for name in ("id", "digest"))
            best = forest.search(owns, _matrix(block.column("v"), dim), shares[dim], k)
            counts = [len(x) for x, _ in best]
            columns = [np.repeat(owns, counts), np.repeat(digests, counts), np.concatenate([x for x, _ in best]), np.concatenate([x for _, x in best])]
            out.append(pa.table(columns, schema=found))
        return pa.concat_tables(out)

    pair = ("dim", "cell", "tile")
    met = index.groupBy(*pair).cogroup(sent.groupBy(*pair)).applyInArrow(search, "query_id long, digest long, vec_id long, score double")
    best = Window.partitionBy("query_id", "digest").orderBy(F.col("score").desc(), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
