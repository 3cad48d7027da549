"""The Parquet tables of a zone: append-only logs, one folder per run.

A run writes its rows below ``table/run_seq=n`` and replaces that folder when it
is retried, so a run that was killed half-way leaves nothing twice. A number
belongs to the run that claimed it first: another one is refused it, so no run
can replace what another has written. Current state is a view: the last snapshot
(:mod:`landfall.sources.snapshots`) and the rows of the runs since. Readers of a
run look at earlier runs only.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import identity
from landfall.operators.curate import range_slice
from landfall.operators.landing import current_slice
from landfall.operators.sequence import latest_by
from landfall.sources import schemas
from landfall.sources.snapshots import Snapshots
from landfall.sources.staging import small_side, stage

LANDING_TABLES = {
    "records": schemas.LANDING_LOG,
    "objects": schemas.LANDING_OBJECTS,
    "outcomes": schemas.OUTCOMES,
    "failures": schemas.FAILURES,
    "found": schemas.FOUND,
}
CURATED_TABLES = {
    "curated": schemas.CURATED_LOG,
    "curation_failures": "identifier STRING, reason STRING, run_seq BIGINT",
}
# Which run has which number.
RUNS = "run_seq BIGINT, owner STRING"
# Tables that are also split by label, so that a date slice reads only its labels.
_SPLIT_BY = {"objects": "partition_date"}


#: Runs since the last snapshot after which :meth:`Zone.maintain` takes the next one.
COMPACT_EVERY = 16


class Zone:
    """Tables below one root folder.

    ``log`` is the table whose latest row per identifier, in the order of the columns ``order``, is the current state;
    ``heads`` is the schema of these rows.
    """

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str], log: str, order: list[str], heads: str):
        self.spark, self.root, self.tables, self.log, self.order = spark, root.rstrip("/"), tables, log, order
        self.columns = schemas.field_names(heads)
        self.snapshots = Snapshots(spark, f"{self.root}/current", heads, "identifier")

    def _changes(self, before: int | None, after: int | None) -> DataFrame:
        """Rows of the log that set the state of an identifier, of the runs after ``after`` and before ``before``."""
        rows = self.read(self.log, before)
        return (rows if after is None else rows.filter(F.col("run_seq") > after)).select(*self.columns)

    def _state(self, before: int | None) -> tuple[DataFrame | None, DataFrame]:
        """(snapshot, changes since then) before a run. Rows without identifier count as changes: no join finds them."""
        snapshot = self.snapshots.latest(before)
        changes = self._changes(before, None if snapshot is None else snapshot.through)
        if snapshot is None:
            return None, changes
        base = self.snapshots.read(snapshot)
        return base.filter("identifier is not null"), changes.unionByName(base.filter("identifier is null"))

    def current(self, before: int | None = None) -> DataFrame:
        """The current row of each identifier. The snapshot is read in place; changes since then are laid over it."""
        base, changes = self._state(before)
        newer = latest_by(changes, "identifier", *self.order)
        if base is None:
            return newer
        return base.join(changes.select("identifier"), "identifier", "left_anti").unionByName(newer)

    def identifiers(self, before: int | None = None) -> DataFrame:
        """Identifiers that have a current row, some several times."""
        base, changes = self._state(before)
        keys = changes.select("identifier")
        return keys if base is None else base.select("identifier").unionByName(keys)

    def hashes(self, before: int | None = None, asked: DataFrame | None = None) -> DataFrame:
        """``identifier, file_hash`` of the current rows, of all or of the ones in ``asked`` (a staged table).

        Snapshot and changes are reduced to the asked identifiers before anything is aggregated.
        """
        columns = ["identifier", "file_hash", *self.order]
        parts = [part.select(*columns) for part in self._state(before) if part is not None]
        if asked is not None:
            keys = asked.select("identifier").distinct()
            parts = [part.join(keys, "identifier", "left_semi") for part in parts]
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        return rows.groupBy("identifier").agg(F.max_by("file_hash", F.struct(*self.order)).alias("file_hash"))

    def compact(self) -> None:
        """Take a snapshot of the current state; runs that follow read the rows of later runs only."""
        last, base = max(self._written_runs(), default=None), self.snapshots.latest()
        if last is None or base is not None and base.through >= last:
            return
        newer = stage(latest_by(self._changes(last + 1, None if base is None else base.through), "identifier", *self.order), "changes")
        self.snapshots.merge(base, newer, last)
        self.snapshots.keep()

    def maintain(self, every: int = COMPACT_EVERY) -> None:
        """Compact if ``every`` or more runs have written since the last snapshot."""
        base = self.snapshots.latest()
        if sum(base is None or run > base.through for run in self._written_runs()) >= every:
            self.compact()

    def _written_runs(self) -> list[int]:
        """Numbers of the runs in the log, from its folder names."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        place = hadoop(f"{self.root}/{self.log}")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []
        return [int(name.removeprefix("run_seq=")) for name in names if name.startswith("run_seq=")]

    def read(self, table: str, before: int | None = None) -> DataFrame:
        """A table's rows of all runs, or of the runs before ``before``."""
        rows = self._stored(table, self.tables[table])
        return rows if before is None else rows.filter(F.col("run_seq") < before)

    def _stored(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], schema)

    def claim(self, owner: str, run_seq: int | None = None) -> int:
        """The number of a run: ``run_seq`` if it is free or the owner's already, else an error.

        Without ``run_seq``, the owner's number if it has one, else the next one after all runs. Runs that start at
        the same moment need numbers of their own choice.
        """
        runs = self._stored("runs", RUNS)
        mine = runs.filter((F.col("owner") == owner) if run_seq is None else (F.col("run_seq") == run_seq)).select(
            "run_seq", "owner").first()
        if mine is not None:
            if mine["owner"] != owner:
                raise ValueError(f"run {run_seq} belongs to {mine['owner']}, not to {owner}")
            return mine["run_seq"]
        if run_seq is None:
            last = runs.agg(F.max("run_seq")).first()[0]
            if last is None:  # a zone whose runs claimed nothing
                last = max(self._written_runs(), default=None)
            run_seq = 0 if last is None else last + 1
        row = self.spark.createDataFrame([(owner,)], "owner STRING")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/runs/run_seq={run_seq}")
        return run_seq

    def owners(self) -> DataFrame:
        """``run_seq, owner`` of all runs that claimed a number."""
        return self._stored("runs", RUNS)

    def read_run(self, table: str, run_seq: int) -> DataFrame:
        """A table's rows of one run."""
        return self.read(table).filter(F.col("run_seq") == run_seq)

    def write_run(self, table: str, rows: DataFrame, run_seq: int) -> None:
        """Write (or replace) the rows of one run.

        Rows are written to a folder that readers pass over and take their place when they are complete: a write that
        is killed leaves the earlier rows of the run as they were.

        Rows of a table that is split meet by label before they are written: there are about as many files as labels, not
        as many as labels in each task that has read some. Labels that hold much are dealt to several tasks.
        """
        aside = f"{self.root}/{table}/_writing-{uuid.uuid4().hex}"
        if table in _SPLIT_BY:
            writer = rows.drop("run_seq").hint("rebalance", _SPLIT_BY[table]).write.partitionBy(_SPLIT_BY[table])
        else:
            writer = rows.drop("run_seq").write
        writer.parquet(aside)
        if table == self.log:
            self.snapshots.forget(run_seq)  # they hold what is replaced
        self._publish(aside, f"{self.root}/{table}/run_seq={run_seq}")

    def _publish(self, source: str, target: str) -> None:
        """Rename a complete folder; rows that it replaces are set aside first and removed last."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        place, former = hadoop(target), hadoop(f"{source}-former")
        files = place.getFileSystem(self.spark._jsc.hadoopConfiguration())
        replaced = files.exists(place) and files.rename(place, former)
        done = False
        try:
            done = files.rename(hadoop(source), place)
        finally:
            if replaced and not done:
                files.rename(former, place)
        if not done:
            raise OSError(f"{source} could not be renamed to {target}")
        if replaced:
            files.delete(former, True)


class LandingZone(Zone):
    """``files`` is a URI below which every landed object is also a file, if it is given."""

    def __init__(self, spark: SparkSession, root: str, files: str | None = None):
        self.files = files
        super().__init__(spark, root, LANDING_TABLES, "records", ["run_seq", "fetch_seq"], schemas.LANDING_LOG)

    def objects_for(self, keys: DataFrame, before: int | None = None, objects: DataFrame | None = None) -> DataFrame:
        """Objects that may have one of the (staged) keys: folders of other labels are pruned when the join runs.

        ``objects`` is the table if it has been opened: its folders are then not listed again.
        """
        label = identity.label_of_key(F.col("storage_path")).alias("_label")
        # The filter tells the planner that the labels are worth pruning by.
        labels = keys.filter(F.col("storage_path").isNotNull()).select(label).distinct()
        rows = self.read("objects", before) if objects is None else objects
        return rows.join(labels, F.col("partition_date") == F.col("_label"), "left_semi")

    def current_between(self, start: date, end: date) -> DataFrame:
        """The current records published in ``[start, end)``."""
        base, changes = self._state(None)
        if base is None:
            return current_slice(changes, F.lit(start), F.lit(end)).select(*self.columns)
        # Records of the snapshot are current unless their identifier changed since; the range reaches both scans.
        kept = range_slice(base, F.lit(start), F.lit(end)).join(changes.select("identifier"), "identifier", "left_anti")
        return kept.select(*self.columns).unionByName(current_slice(changes, F.lit(start), F.lit(end)))


class CuratedZone(Zone):
    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, CURATED_TABLES, "curated", ["run_seq"], schemas.CURATED_HEADS)

    def _changes(self, before: int | None, after: int | None) -> DataFrame:
        rows = self.written(before)
        return (rows if after is None else rows.filter(F.col("run_seq") > after)).select(*self.columns)

    def written(self, before: int | None = None) -> DataFrame:
        """Rows that changed the zone: no-ops are in the log for accounting only."""
        return self.read("curated", before).filter(F.col("outcome") != "unchanged")

    def objects(self) -> DataFrame:
        """``storage_path, data, content_type``: the last bytes written to each key."""
        rows = self.written().select("storage_path", "run_seq", "content_type", "data")
        newest = rows.groupBy("storage_path").agg(F.max("run_seq").alias("run_seq"))
        return rows.join(small_side(stage(newest, "newest")), ["storage_path", "run_seq"]).drop("run_seq")
