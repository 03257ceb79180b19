"""A table of row versions on plain files: cheap writes, point reads of few files, full reads that leave the stored rows in place.

Below the path of a table lies one folder for each generation. ``generation=N/buckets=B`` holds the rows of the last compaction,
one version a key, as a Parquet table bucketed and sorted by a digest of the key; ``generation=N/batch=M`` the versions that came
since, sorted by that digest, with Bloom filters on it. A batch or generation counts when its success mark is there, so a write that
breaks off changes nothing, and writing it again replaces nothing but itself.

* ``upsert`` writes the rows of a batch and nothing else.
* ``read_upserted`` reduces the batches to one version a key and joins them with the buckets. The buckets are read where they lie:
  only the batches are exchanged.
* ``read_key`` reads one bucket, and of each batch the row groups whose filter may hold the key.
* ``compact`` writes the next generation. With the same number of buckets, rows go from bucket to bucket without an exchange. Older
  generations than the one before go when the new one is complete; that one stays for readers that still run.

One writer at a time: a batch written into a generation while it is compacted would be left behind.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.functions.names import free_names
from reviewmill.sources.sinks import new_id

#: Digest of the key, as stored beside the caller's columns.
KEY = "_key_digest"
#: Codec of the stored rows. The 64 letters of a digest hold four bits each, which a codec without entropy coding leaves as they are.
CODEC = "zstd"


class _Files:
    """The folders of a table."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._make = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._make(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self, folder: str, name: str, complete: bool = True) -> list[int]:
        """N of the folders name=N below ``folder``; of those with a success mark, if ``complete``."""
        root = self._make(folder)
        if not self._system.exists(root):
            return []
        found = [status.getPath().getName().partition("=") for status in self._system.listStatus(root)]
        numbers = [int(number) for kind, _, number in found if kind == name and number.isdigit()]
        return sorted(n for n in numbers if not complete or self._system.exists(self._make(f"{folder}/{name}={n}/_SUCCESS")))

    def folder(self, generation: int) -> str:
        return f"{self.path}/generation={generation}"

    def generation(self) -> int:
        """The newest complete generation; 0 before the first compaction."""
        every = self.numbers(self.path, "generation", complete=False)
        return max((n for n in every if self.numbers(self.folder(n), "buckets")), default=0)

    def buckets(self, generation: int) -> int | None:
        return max(self.numbers(self.folder(generation), "buckets"), default=None)

    def drop(self, folder: str) -> None:
        self._system.delete(self._make(folder), True)


def _with_key(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.withColumn(KEY, new_id(*keys))


def upsert(updates: DataFrame, path: str, keys: list[str], batch: int | None = None) -> int:
    """Add a batch of row versions; returns its number.

    ``batch`` is the number of a stream's batch, above zero; without one the time in microseconds is taken.
    """
    files = _Files(updates.sparkSession, path)
    number = time.time_ns() // 1000 if batch is None else batch
    rows = _with_key(updates, keys).sortWithinPartitions(KEY)
    rows.write.mode("overwrite").option("compression", CODEC).option(f"parquet.bloom.filter.enabled#{KEY}", "true").parquet(f"{files.folder(files.generation())}/batch={number}")
    return number


def _stored(spark: SparkSession, files: _Files, generation: int) -> DataFrame | None:
    """The compacted rows, as a bucketed table that only this plan knows."""
    buckets = files.buckets(generation)
    if buckets is None:
        return None
    place = f"{files.folder(generation)}/buckets={buckets}"
    name = f"upserted_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(place).schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}'")
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # the files stay


def _versions(spark: SparkSession, files: _Files, generation: int) -> DataFrame | None:
    """The rows of all complete batches, with the number of their batch."""
    folder = files.folder(generation)
    paths = [f"{folder}/batch={n}" for n in files.numbers(folder, "batch")]
    if not paths:
        return None
    return spark.read.option("basePath", folder).parquet(*paths).withColumn("batch", F.col("batch").cast("bigint"))


def _merged(stored: DataFrame | None, versions: DataFrame | None, version: str, created: str | None, tie: str | None,
            wanted: list[str] | None = None) -> DataFrame:
    """One row a key: the highest version, of equal ones the later batch, of one batch the highest tie.

    Rows travel as structs, out of which Spark prunes nothing, so columns that are neither ``wanted`` nor compared are left out first.
    """
    if wanted is not None:
        used = {name.lower() for name in (*wanted, KEY, "batch", version, created, tie) if name}
        stored, versions = (part and part.select(*[f"`{c}`" for c in part.columns if c.lower() in used]) for part in (stored, versions))
    if versions is None:
        return stored
    every = [c for c in versions.columns if c != "batch"]
    columns = [c for c in every if c != KEY]

    def order(batch: Column, row: str | None = None) -> Column:
        at = (lambda c: F.col(c)) if row is None else (lambda c: F.col(row).getField(c))
        return F.struct(at(version).alias("version"), batch.alias("batch"), *([at(tie).alias("tie")] if tie else []))

    new, new_order, first, old, code = free_names(every, "new", "new_order", "first", "old", "code")
    measures = [F.max_by(F.struct(*columns), order(F.col("batch"))).alias(new), *([F.min(created).alias(first)] if created else [])]
    if stored is not None:
        latest = versions.groupBy(KEY).agg(*measures, F.max(order(F.col("batch"))).alias(new_order))
    else:  # the digest as 32 bytes: its 64 letters would be most of what moves
        latest = versions.groupBy(F.unhex(KEY).alias(code)).agg(*measures).withColumn(KEY, F.lower(F.hex(code))).drop(code)
    if stored is None:
        joined, winner = latest, F.col(new)
    else:
        held = stored.select(KEY, F.struct(*columns).alias(old))
        joined = held.join(latest, KEY, "full_outer")
        newer = F.col(new).isNotNull() & (F.col(old).isNull() | (F.col(new_order) >= order(F.lit(0).cast("bigint"), old)))
        winner = F.when(newer, F.col(new)).otherwise(F.col(old))

    def column(name: str) -> Column:
        if name == created:
            before = [F.col(old).getField(created)] if stored is not None else []
            return (F.least(F.col(first), *before) if before else F.col(first)).alias(name)
        return winner.getField(name).alias(name)

    return joined.select(*[F.col(KEY) if c == KEY else column(c) for c in every])


def read_upserted(spark: SparkSession, path: str, version: str = "updated_at", created: str | None = "created_at",
                  tie: str | None = None, columns: list[str] | None = None) -> DataFrame:
    """The last version of every key; the first creation time survives. With ``columns``, those alone are read, moved and returned."""
    files = _Files(spark, path)
    generation = files.generation()
    found = _merged(_stored(spark, files, generation), _versions(spark, files, generation), version, created, tie, columns).drop(KEY)
    return found if columns is None else found.select(*[F.col(f"`{c}`") for c in columns])


def read_key(spark: SparkSession, path: str, key: dict[str, object], version: str = "updated_at", created: str | None = "created_at",
             tie: str | None = None) -> DataFrame:
    """The last version of one key, given as its columns and their values."""
    files = _Files(spark, path)
    generation = files.generation()
    wanted = F.col(KEY) == new_id(*[F.lit(value) for value in key.values()])
    parts = [part and part.filter(wanted) for part in (_stored(spark, files, generation), _versions(spark, files, generation))]
    return _merged(*parts, version, created, tie).drop(KEY)


def compact(spark: SparkSession, path: str, version: str = "updated_at", created: str | None = "created_at", tie: str | None = None,
            buckets: int | None = None) -> None:
    """Write the last versions as a new generation and drop those before the one read here.

    ``buckets`` is the number of buckets, that of the last generation by default, 64 at first. A bucket is written and read
    by one task, so choose it by the size of the table, about a gigabyte a bucket.
    """
    files = _Files(spark, path)
    generation = files.generation()
    number = buckets or files.buckets(generation) or 64
    merged = _merged(_stored(spark, files, generation), _versions(spark, files, generation), version, created, tie)
    place, name = f"{files.folder(generation + 1)}/buckets={number}", f"compacted_{uuid.uuid4().hex}"
    for other in files.numbers(files.path, "generation", complete=False):
        if other > generation:  # left by a compaction that broke off
            files.drop(files.folder(other))
    ready = merged.repartition(number, KEY)
    ready.write.bucketBy(number, KEY).sortBy(KEY).option("compression", CODEC).option("path", place).mode("overwrite").saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    for other in files.numbers(files.path, "generation", complete=False):
        if other < generation:
            files.drop(files.folder(other))
