"""The landing merge as a stream: every micro-batch is a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landfall.operators import reconcile
from landfall.operators.landing import measure
from landfall.operators.sequence import compute_once
from landfall.plans.ingest import land
from landfall.sources.staging import stage
from landfall.sources.zones import LandingZone


def decide(documents: DataFrame) -> DataFrame:
    """Hash documents that arrive with their metadata and bytes."""
    read = compute_once(documents, measured=measure(F.col("document_type")))
    return read.drop("data", "error", "status").select("*", "measured.*", F.col("fetch_seq").alias("payload_seq")).drop(
        "measured")


def land_documents(documents: DataFrame, zone: LandingZone, *, run_id: str, run_seq: int,
                   recheck: bool = True) -> DataFrame:
    """Land a batch of documents that need no listing (one run)."""
    run_seq = zone.claim(run_id, run_seq)
    named = land(stage(decide(documents), "decided"), documents, zone, run_id, run_seq, recheck)
    write_outcomes(named, zone, run_seq)
    return named


def write_outcomes(named: DataFrame, zone: LandingZone, run_seq: int) -> None:
    """Outcomes of a run and the reasons of those that failed."""
    zone.write_run("outcomes", named.select("fetch_seq", "identifier", "body_key", "partition_date", "outcome"), run_seq)
    zone.write_run("failures", reconcile.document_failures(named), run_seq)


def merge_stream(documents: DataFrame, zone: LandingZone, checkpoint: str, *, run_id: str = "stream",
                 recheck: bool = True) -> StreamingQuery:
    """Land a stream of documents; stops once the input that exists is processed.

    Every batch is a run with the zone's next number, which the zone keeps under the checkpoint and the batch. A
    batch repeated after a failure finds its number again and replaces its own folders, so each document takes
    effect once, and runs of others are never touched. Every so many batches the zone is compacted, so a batch reads the
    rows of a few others besides the snapshot.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        run_seq = zone.claim(f"{run_id} {checkpoint} {batch_id}")
        named = land(stage(decide(batch), "decided"), batch, zone, run_id, run_seq, recheck)
        write_outcomes(named, zone, run_seq)
        zone.maintain()

    return (
        documents.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
