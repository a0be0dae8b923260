"""Parquet tables of versions: each version is a list of data files, and a change is a new list.

A table is a folder with ``data`` (files that are never changed) and ``versions/<n>``, small Parquet
tables that list a version's files with sizes, row counts and key ranges. A version becomes visible
by renaming its finished list into place, which fails if another writer took the number; readers of
an earlier version go on reading files that still stand. So compaction and merges rewrite only the
files they have to and share the others. Lists are read and joined by Spark; the driver holds the
paths of the files it asks Spark to read, as any scan does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TARGET_BYTES = 100 * 1024 * 1024
MIN_FILES = 5

_LIST = "path string, folder string, bytes long, n long, low string, high string"


class VersionedTable:
    """``key`` orders the rows inside files and says which files a merge has to look into."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: Sequence[str]):
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, list(key)

    def _folder(self, path: str):
        place = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return place, place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The latest version, 0 for a table without any."""
        place, fs = self._folder(f"{self.root}/versions")
        if not fs.exists(place):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def files(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], _LIST)
        return self.spark.read.schema(_LIST).parquet(f"{self.root}/versions/{version}")

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows([r.path for r in self.files(version).select("path").collect()])

    def _rows(self, paths: Sequence[str]) -> DataFrame:
        reader = self.spark.read.schema(self.schema)
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def _commit(self, files: DataFrame, after: int) -> int:
        staged = f"{self.root}/versions/_{uuid.uuid4().hex}"
        files.select(*[f.split()[0] for f in _LIST.split(", ")]).write.parquet(staged)
        place, fs = self._folder(staged)
        final, _ = self._folder(f"{self.root}/versions/{after + 1}")
        if fs.exists(final) or not fs.rename(place, final):
            raise RuntimeError(f"version {after + 1} of {self.root} was written by another job")
        return after + 1

    def add_files(self, folder: str) -> DataFrame:
        """List data files that stand below a folder. Only the key columns are read for it."""
        rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(folder)
        first = F.col(self.key[0])
        return rows.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("n"), F.min(first).cast("string").alias("low"), F.max(first).cast("string").alias("high")
        ).withColumn("folder", F.regexp_extract("path", "((?:[^/=]+=[^/]*/)*)[^/]*$", 1))

    def _written(self, rows: DataFrame) -> DataFrame:
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return self.add_files(folder)

    def _sorted(self, rows: DataFrame) -> DataFrame:
        """Each file holds a range of the key, in order."""
        return rows.repartitionByRange(*self.key).sortWithinPartitions(*self.key)

    def replace(self, rows: DataFrame) -> int:
        at = self.version()
        return self._commit(self._written(self._sorted(rows.select(*self.schema.names))), at)

    def append(self, rows: DataFrame) -> int:
        at = self.version()
        new = self._written(rows.select(*self.schema.names).sortWithinPartitions(*self.key))
        return self._commit(self.files(at).unionByName(new), at)

    def adopt(self, folder: str) -> int:
        """Make the Parquet files of a folder part of the table, where they are."""
        at = self.version()
        return self._commit(self.files(at).unionByName(self.add_files(folder)), at)

    def merge(self, source: DataFrame, watermark: str) -> int:
        """Take over the newest source row of every key, above what the table holds of that key.

        Files that hold none of the keys are shared with the last version. Of the others the rows with
        new keys are left out and the rest is written again, together with the new rows. A source row
        replaces the row of its key if its ``watermark`` is higher; null keys are one key.
        """
        at = self.version()
        others = [c for c in self.schema.names if c not in self.key]
        order = F.struct(F.col(watermark), *[F.col(c) for c in others if c != watermark])
        latest = source.groupBy(*self.key).agg(F.max_by(F.struct(*others), order).alias("row")).select(*self.key, "row.*")
        new = _stored(latest.select(*self.schema.names), f"{self.root}/data/_new_{uuid.uuid4().hex}")
        first = F.col(self.key[0])
        low, high, missing = new.agg(
            F.min(first).cast("string"), F.max(first).cast("string"), F.count_if(first.isNull())
        ).first()
        if low is None and not missing:
            return at
        files = self.files(at)
        kind = self.schema[self.key[0]].dataType
        # Files beyond the range of the new keys are not opened; of the others only the keys. Missing keys
        # are in no range.
        near = (F.col("low").cast(kind) <= F.lit(high).cast(kind)) & (F.col("high").cast(kind) >= F.lit(low).cast(kind))
        candidates = [r.path for r in (files if missing else files.where(near)).select("path").collect()]
        if not candidates:
            return self._commit(files.unionByName(self._written(self._sorted(new))), at)
        keyed = self._rows(candidates).select(
            *self.key, F.col(watermark).alias("_was"), F.col("_metadata.file_path").alias("_path")
        )
        incoming = new.select(*[F.col(k).alias(f"_{k}") for k in self.key], F.col(watermark).alias("_is"))
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key]
        met = keyed.join(incoming, same).select(*self.key, "_path", (F.col("_is") > F.col("_was")).alias("_newer"))
        met = _stored(met, f"{self.root}/data/_met_{uuid.uuid4().hex}")
        # A key the table has in a row as new as the source's keeps its row.
        stale = met.groupBy(*self.key).agg(F.bool_and(F.coalesce("_newer", F.lit(True))).alias("_newer")).where(~F.col("_newer"))
        stale = stale.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        taken = new.join(stale, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key], "left_anti")
        gone = taken.select(*[F.col(k).alias(f"_{k}") for k in self.key])
        touched = met.join(stale, same, "left_anti").select(F.col("_path").alias("path")).distinct()
        touched = _stored(touched, f"{self.root}/data/_touched_{uuid.uuid4().hex}")
        left = self._rows([r.path for r in touched.collect()]).join(gone, same, "left_anti")
        written = self._written(self._sorted(left.unionByName(taken)))
        kept = files.join(touched, "path", "left_anti")
        return self._commit(kept.unionByName(written), at)

    def compact(self, target_bytes: int = TARGET_BYTES, min_files: int = MIN_FILES) -> int:
        """Put small files together, partition folder by folder, into files near ``target_bytes``.

        Files of three quarters of the target and more stay as they are. Small ones are filled into
        bins in order of their keys, and a bin is one file again, sorted by the key. Nothing is done
        with fewer than ``min_files`` small files. Returns the version. Only the list of files is put in
        order in one task, never rows.
        """
        at = self.version()
        files = self.files(at)
        small = files.where(F.col("bytes") < target_bytes * 3 // 4)
        low = F.col("low").cast(self.schema[self.key[0]].dataType)
        running = Window.partitionBy("folder").orderBy(low, "path").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        filled = small.withColumn("_bin", F.floor((F.sum("bytes").over(running) - F.col("bytes")) / target_bytes))
        binned = filled.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("folder", "_bin"))).where("_size > 1")
        binned = _stored(
            binned.select("path", F.xxhash64("folder", "_bin").alias("_bin")), f"{self.root}/data/_bins_{uuid.uuid4().hex}"
        )
        found = binned.agg(F.count(F.lit(1)), F.countDistinct("_bin")).first()
        if found[0] < min_files:
            return at
        rows = self._rows([r.path for r in binned.select("path").collect()])
        tagged = rows.withColumn("path", F.col("_metadata.file_path")).join(binned, "path").drop("path")
        merged = tagged.repartitionByRange(found[1], "_bin").sortWithinPartitions("_bin", *self.key).drop("_bin")
        kept = files.join(binned, "path", "left_anti")
        return self._commit(kept.unionByName(self._written(merged)), at)


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """Rows that several steps of one change read, written beside the data; names with _ are no data."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)

