"""Compacted current state of a log: its latest row per key, stored once, in buckets of the key.

A snapshot covers the runs up to a number; the state after any later run is the snapshot with the rows of the runs in
between laid over it. Joins by the key read a snapshot in place, bucket by bucket, so what a run costs does not grow with
the runs before the snapshot. Merging rows into the next snapshot moves only these rows.

A snapshot is complete when its folder has its name; it is never changed. Its name says which runs it covers and how many
buckets it has, so a session that did not write it can read it as a bucketed table.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a bucket, about; buckets double when this is exceeded.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8


@dataclass(frozen=True)
class Snapshot:
    through: int
    buckets: int
    path: str

    @property
    def table(self) -> str:
        return f"snapshot_{hashlib.md5(self.path.encode()).hexdigest()}"


def buckets_for(rows: int, at_least: int = LEAST_BUCKETS) -> int:
    """A power of two; it does not shrink from one snapshot to the next."""
    return max(at_least, LEAST_BUCKETS, 1 << max(0, -(-rows // BUCKET_ROWS) - 1).bit_length())


class Snapshots:
    """The snapshots of one log below ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str):
        self.spark, self.root, self.schema, self.key = spark, root, schema, key

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path, path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def all(self) -> list[Snapshot]:
        path, files = self._files()
        if not files.exists(path(self.root)):
            return []
        names = [status.getPath().getName() for status in files.listStatus(path(self.root))]
        found = (re.fullmatch(r"through_(-?\d+)_buckets_(\d+)", name) for name in names)
        return sorted((Snapshot(int(m[1]), int(m[2]), f"{self.root}/{m[0]}") for m in found if m), key=lambda s: s.through)

    def latest(self, before: int | None = None) -> Snapshot | None:
        """The snapshot that covers most of the runs before ``before`` and no others."""
        return max((s for s in self.all() if before is None or s.through < before), key=lambda s: s.through, default=None)

    def read(self, snapshot: Snapshot) -> DataFrame:
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {snapshot.table} ({self.schema}) USING parquet CLUSTERED BY ({self.key})"
                       f" SORTED BY ({self.key}) INTO {snapshot.buckets} BUCKETS LOCATION '{snapshot.path}'")
        return self.spark.table(snapshot.table)

    def merge(self, base: Snapshot | None, newer: DataFrame, through: int) -> Snapshot:
        """Write the snapshot of ``base`` with the rows of ``newer`` (one per key) laid over it.

        Rows of the base stay in their bucket: only newer ones are shuffled, unless the number of buckets grows.
        """
        old = None if base is None else self.read(base)
        rows = newer.count() + (0 if old is None else old.count())
        buckets = buckets_for(rows, 0 if base is None else base.buckets)
        if old is None:
            merged = newer.repartition(buckets, self.key)
        else:
            mark, columns = F.lit(True).alias("_newer"), newer.columns
            over = newer.select(*[F.col(c).alias(f"_{c}") for c in columns], mark).repartition(base.buckets, f"_{self.key}")
            joined = old.join(over, old[self.key] == F.col(f"_{self.key}"), "full_outer")
            merged = joined.select(*[F.when(F.col("_newer"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in columns])
            if buckets != base.buckets:
                merged = merged.repartition(buckets, self.key)
        target = Snapshot(through, buckets, f"{self.root}/through_{through}_buckets_{buckets}")
        aside, name = f"{self.root}/_writing-{uuid.uuid4().hex}", f"snapshot_{uuid.uuid4().hex}"
        merged.select(*[F.col(c) for c in newer.columns]).write.bucketBy(buckets, self.key).sortBy(self.key).option("path", aside).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay
        path, files = self._files()
        if not files.rename(path(aside), path(target.path)) and not files.exists(path(target.path)):
            raise OSError(f"{aside} could not be renamed to {target.path}")
        return target

    def forget(self, run_seq: int) -> None:
        """Remove the snapshots that cover a run (which is about to be replaced)."""
        path, files = self._files()
        for snapshot in self.all():
            if snapshot.through >= run_seq:
                self.spark.sql(f"DROP TABLE IF EXISTS {snapshot.table}")
                files.delete(path(snapshot.path), True)

    def keep(self, last: int = 2) -> None:
        """Remove all but the last snapshots; a run that reads an older one must not be going on."""
        path, files = self._files()
        for snapshot in self.all()[:-last]:
            self.spark.sql(f"DROP TABLE IF EXISTS {snapshot.table}")
            files.delete(path(snapshot.path), True)
