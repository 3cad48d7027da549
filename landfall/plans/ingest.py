"""A landing run: captured listings and documents into the landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landfall.functions import content
from landfall.operators import frontier, landing, listing, reconcile
from landfall.sources.object_files import export_objects
from landfall.sources.staging import small_side, stage
from landfall.sources.zones import LandingZone


def land(decided: DataFrame, fetches: DataFrame, zone: LandingZone, run_id: str, run_seq: int,
         recheck: bool, known: DataFrame | None = None) -> DataFrame:
    """Classify documents, append objects and records; returns the classified rows.

    ``known`` are the hashes landed before, if it is not the zone's log that has them.

    Objects are written before records, so a record never points to bytes that
    are not there. Classification sees earlier runs only and a retry replaces
    what the run wrote before, so retrying is harmless.

    Where the zone also keeps objects as files, files come first. A file that cannot be written does not end the run: the
    documents it would have been written for, whether as their first object or as a version, fail with a ``persist: ...``
    reason and leave no trace; the others are classified again without them.
    """
    before = stage(zone.hashes(before=run_seq, asked=decided), "known") if known is None else known
    earlier = zone.read("objects", before=run_seq)
    unwritten: DataFrame | None = None
    tried: DataFrame | None = None
    while True:
        judged = decided if unwritten is None else _without_unwritten(decided, unwritten)
        named = stage(landing.name_objects(landing.classify(judged, before, recheck)), "classified")
        stored_before = zone.objects_for(landing.stored(named), objects=earlier).select("storage_path")
        objects = landing.new_objects(named, stored_before)
        if zone.files is None:
            break
        objects = stage(objects, "to-persist")
        # A file that is there is kept, so the bytes of a path that was tried before are not asked for again.
        asked = objects if tried is None else stage(objects.join(tried, "storage_path", "left_anti"), "to-persist")
        persisted = stage(export_objects(landing.attach_bytes(asked, fetches), zone.files), "persisted")
        lost = persisted.filter("reason is not null").select("storage_path", F.col("reason").alias("persist_reason"))
        if lost.isEmpty():
            break
        # Every turn adds paths that no turn before has tried, so there is a last one.
        unwritten = stage(lost if unwritten is None else lost.unionByName(unwritten), "unwritten")
        paths = persisted.select("storage_path")
        tried = paths if tried is None else tried.unionByName(paths)
    write_landed(named, objects, fetches, zone, run_id, run_seq)
    return named


def _without_unwritten(decided: DataFrame, unwritten: DataFrame) -> DataFrame:
    """Documents with those as failed whose object could not be written under either path it may get."""
    paths = small_side(unwritten.groupBy("storage_path").agg(F.min("persist_reason").alias("persist_reason")))
    judged = decided
    for number, version in enumerate((F.lit(None).cast("string"), content.short_hash(F.col("file_hash")))):
        path, reason = f"_path_{number}", f"_reason_{number}"
        judged = judged.withColumn(path, landing.object_path(version)).join(
            paths.select(F.col("storage_path").alias(path), F.col("persist_reason").alias(reason)), path, "left")
    reason = F.coalesce("_reason_0", "_reason_1")
    return stage(judged.withColumns({
        "file_hash": F.when(reason.isNull(), F.col("file_hash")), "reason": F.coalesce("reason", reason)}).select(*decided.columns), "judged")


def write_landed(named: DataFrame, appended: DataFrame, fetches: DataFrame, zone: LandingZone, run_id: str, run_seq: int) -> None:
    """Write the objects of the ``appended`` rows, then the records of all that are stored."""
    objects = stage(appended.select("storage_path", "partition_date", "document_type", "payload_seq", "fetch_seq"), "new-objects")
    zone.write_run("objects", landing.attach_bytes(objects, fetches), run_seq)
    # Dates close together share row groups, which a date slice can then skip.
    records = landing.build_records(named, run_id, run_seq).sortWithinPartitions("published_date")
    zone.write_run("records", records, run_seq)


def ingest(listings: DataFrame, fetches: DataFrame, zone: LandingZone, *, run_id: str, run_seq: int,
           recheck: bool = False, limit: int | None = None) -> DataFrame:
    """One run over captured listing pages and documents; returns its reconciliation.

    A run has a number, higher than those of earlier runs; repeating a run under
    its number replaces it. A number belongs to the ``run_id`` that used it first.
    ``limit`` is the number of documents requested at most (none or 0: all). Without
    ``recheck``, documents with a known identifier are skipped before anything of
    them but the URL is read.
    """
    run_seq = zone.claim(run_id, run_seq)
    rows = stage(listing.listing_rows(listings), "listing-rows")
    requests = stage(frontier.capped_batch(landing.url_once(listing.candidates(rows)), limit), "requests")
    wanted, skipped = split_known(requests, zone, run_seq, recheck)
    direct = stage(landing.captures_of(fetches, wanted.select(F.col("document_url").alias("url"))), "captures")
    stubs = direct.filter(F.col("follow_url").isNotNull()).select(F.col("follow_url").alias("url"))
    followed = stage(landing.captures_of(fetches, stubs), "followed")
    decided = stage(landing.attach_captures(wanted, direct.unionByName(followed), seen=requests), "decided")
    failures = listing.listing_failures(listings).unionByName(listing.row_failures(rows))
    return land_requests(decided, skipped, fetches, listing.found_counts(listings, rows), failures, zone, run_id, run_seq, recheck)


def split_known(requests: DataFrame, zone: LandingZone, run_seq: int, recheck: bool) -> tuple[DataFrame, DataFrame]:
    """(requests to process, requests to skip); with ``recheck`` none is skipped."""
    if recheck:
        return requests, requests.filter(F.lit(False))
    wanted, skipped = landing.skip_known(requests, zone.identifiers(before=run_seq))
    return stage(wanted, "split"), stage(skipped, "split")


def land_requests(decided: DataFrame, skipped: DataFrame, fetches: DataFrame, found: DataFrame, listing_failures: DataFrame,
                  zone: LandingZone, run_id: str, run_seq: int, recheck: bool) -> DataFrame:
    """Land decided requests and write what the run found, did and failed at; returns its reconciliation."""
    # Whatever is known has been skipped, so nothing that landed before can matter.
    nothing = None if recheck else decided.select("identifier", "file_hash").filter(F.lit(False))
    named = land(decided, fetches, zone, run_id, run_seq, recheck, nothing)
    columns = ["fetch_seq", "identifier", *reconcile.UNIT, "outcome"]
    outcomes = named.select(*columns).unionByName(
        skipped.withColumn("outcome", F.lit("skipped")).select(*columns))
    zone.write_run("found", found, run_seq)
    zone.write_run("outcomes", outcomes, run_seq)
    zone.write_run("failures", listing_failures.unionByName(reconcile.document_failures(named)), run_seq)
    return report(zone, run_seq)


def report(zone: LandingZone, run_seq: int) -> DataFrame:
    """Reconciliation of a finished run, from its tables."""
    return reconcile.reconcile(zone.read_run("found", run_seq), zone.read_run("outcomes", run_seq),
                               zone.read_run("failures", run_seq))
