"""The landing merge: digest, classify, name and append documents.

Document bytes are read twice and never sorted or windowed. ``digest`` turns
every fetch into a short row where it is read; all decisions are made on those
rows; only documents that are to be written have their bytes attached again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landfall.functions import content, identity, stubs, urls
from landfall.functions.binding import let
from landfall.operators.curate import range_slice
from landfall.operators.listing import failure_reason, http_status, page_base
from landfall.operators.sequence import compute_once, first_by, latest_by, previous_value
from landfall.sources.schemas import RECORD_COLUMNS
from landfall.sources.staging import small_side, stage

EMPTY_BODY = "empty document body"
NOT_CAPTURED = "document not captured"


def digest(fetches: DataFrame, *carry: str) -> DataFrame:
    """One short row per fetch: type, canonical hash and length, failure, link to follow, and the ``carry`` columns.

    A failed or empty fetch has a ``reason`` and no hash. Emptiness is judged
    after canonicalisation. Work is done per row, in place.
    """
    typed = fetches.withColumn("document_type", identity.document_type(F.col("url")))

    def follow(html: Column) -> Column:
        return let(stubs.download_link(html), lambda link: F.when(
            link.isNotNull(), urls.resolve(page_base(F.col("url"), html), link)))

    is_page = (F.col("document_type") == "html") & failure_reason(F.col("status"), F.col("error")).isNull()
    link = F.when(is_page, follow(content.html_text(F.col("data"))))
    read = compute_once(typed, follow_url=link, measured=measure(F.col("document_type")))
    return read.select("fetch_seq", "url", "document_type", "measured.*", "follow_url", *carry)


def captures_of(fetches: DataFrame, wanted: DataFrame) -> DataFrame:
    """Digest of the first capture of each ``url`` in ``wanted``; documents of other captures are not read.

    Which captures these are is decided on the numbers and URLs alone. Their numbers are the small side of the join
    with the bytes (see :func:`landfall.sources.staging.small_side`), so bytes are never sorted.
    """
    key = urls.same_request_key(F.col("url")).alias("_key")
    firsts = fetches.select(key, "fetch_seq").groupBy("_key").agg(F.min("fetch_seq").alias("fetch_seq"))
    chosen = stage(firsts.join(wanted.select(key).distinct(), "_key", "left_semi").select("fetch_seq"), "chosen")
    return digest(fetches.join(small_side(chosen), "fetch_seq", "left_semi"))


def measure(doc_type: Column) -> Column:
    """Struct of canonical length and hash, failure reason and HTTP status of a fetch."""
    failure = failure_reason(F.col("status"), F.col("error"))
    body = F.when(failure.isNull(), content.canonical_bytes(doc_type, F.coalesce(F.col("data"), F.lit(bytearray()))))
    return let(body, lambda b: F.struct(
        content.byte_length(b).alias("content_length"),
        F.when(F.octet_length(b) > 0, content.sha256_hex(b)).alias("file_hash"),
        F.coalesce(failure, F.when(F.octet_length(b) == 0, EMPTY_BODY)).alias("reason"),
        http_status(F.col("status")).alias("status")))


def url_once(requests: DataFrame, url: str = "document_url", order: str = "fetch_seq") -> DataFrame:
    """The first request of each URL; repeats are dropped (and reconcile as missing)."""
    return first_by(requests, urls.same_request_key(F.col(url)), order)


def skip_known(batch: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split a batch into (to process, skipped) by identifiers landed before the run.

    Known identifiers are first reduced to those of the batch, which is a filter
    in place when the batch is small enough to be broadcast.
    """
    asked = batch.select("identifier").distinct()
    keys = known.select("identifier").join(asked, "identifier", "left_semi").distinct()
    return batch.join(keys, "identifier", "left_anti"), batch.join(keys, "identifier", "left_semi")


def attach_captures(requests: DataFrame, captures: DataFrame, seen: DataFrame | None = None) -> DataFrame:
    """Give each requested document the digest of its capture, following stubs one hop.

    ``requests`` are distinct by URL (``url_once``); of several captures of a URL
    the first counts. Stubs pointing to one file, or to a file that is requested
    anyway, fetch it once: the remaining stubs are dropped. Both joins are
    therefore one-to-one, whatever the share of a single link. ``seen`` holds all
    requests of the run, skipped ones included, if these are not all of them.
    """
    key = urls.same_request_key
    by_url = first_by(captures, key(F.col("url")), "fetch_seq").select(
        key(F.col("url")).alias("_key"), F.col("fetch_seq").alias("payload_seq"), "content_length", "file_hash",
        "reason", "status", "follow_url")
    asked = requests.withColumn("_key", key(F.col("document_url")))
    direct = asked.join(by_url, "_key", "left")
    is_stub = (F.col("document_type") == "html") & F.col("follow_url").isNotNull()

    results = ["payload_seq", "content_length", "file_hash", "reason", "status"]
    kept = direct.filter(~F.coalesce(is_stub, F.lit(False))).drop("_key", "follow_url")
    hop = direct.filter(is_stub).drop(*results, "_key").withColumns({
        "source_url": F.col("document_url"), "document_url": F.col("follow_url"),
        "document_type": identity.document_type(F.col("follow_url"))}).drop("follow_url")
    hop = url_once(hop).withColumn("_key", key(F.col("document_url")))
    requested = requests if seen is None else seen
    hop = hop.join(requested.select(key(F.col("document_url")).alias("_key")), "_key", "left_anti")
    followed = hop.join(by_url.drop("follow_url"), "_key", "left").drop("_key")

    missing = F.col("payload_seq").isNull()
    return kept.unionByName(followed).withColumn(
        "reason", F.when(missing, NOT_CAPTURED).otherwise(F.col("reason")))


def classify(decided: DataFrame, known: DataFrame, recheck: bool, block: Column | None = None) -> DataFrame:
    """Add ``outcome`` and ``previous_hash`` to documents in ``fetch_seq`` order.

    ``known`` holds ``identifier, file_hash`` of records landed before the run.
    A failed row leaves no trace. With ``recheck`` the hash is compared with the
    previous one of the identifier (from this run or before). Without it, an
    identifier that is known, or has landed earlier in this run, is ``skipped``.
    """
    looked = previous_value(decided, "identifier", "fetch_seq", "file_hash", "previous_hash", seed=known, block=block)
    previous, current = F.col("previous_hash"), F.col("file_hash")
    if recheck:
        outcome = (
            F.when(current.isNull(), "failed").when(previous == current, "unchanged")
            .when(previous.isNotNull(), "changed").otherwise("new"))
    else:
        outcome = F.when(previous.isNotNull(), "skipped").when(current.isNull(), "failed").otherwise("new")
    return looked.withColumn("outcome", outcome)


def name_objects(classified: DataFrame) -> DataFrame:
    """Add the landing key; documents that changed carry a hash version in it."""
    version = F.when(F.col("outcome") == "changed", content.short_hash(F.col("file_hash")))
    return classified.withColumn("storage_path", object_path(version))


def object_path(version: Column) -> Column:
    """The landing key of a document, with a version if it is not null."""
    ext = identity.document_extension(F.col("document_url"), F.col("document_type"))
    return identity.landing_key(F.col("body_key"), F.col("partition_date"), F.col("identifier"), ext, version)


def stored(named: DataFrame) -> DataFrame:
    """Documents that are written: new and changed ones."""
    return named.filter(F.col("outcome").isin("new", "changed"))


def new_objects(named: DataFrame, existing_keys: DataFrame) -> DataFrame:
    """Keys to append: the first document per key, unless the key exists already."""
    # Columns are cut before the aggregate, which moves whole rows.
    writes = stored(named).select("storage_path", "partition_date", "document_type", "payload_seq", "fetch_seq")
    return first_by(writes, "storage_path", "fetch_seq").join(
        existing_keys.select("storage_path"), "storage_path", "left_anti")


def attach_bytes(objects: DataFrame, fetches: DataFrame) -> DataFrame:
    """Join the canonical bytes to the (staged) objects that are written.

    Each object has its own fetch, so the join is one-to-one. Few objects are
    broadcast and the bytes stay where they are read. Otherwise the join is by the
    unique fetch number: fetches stored in buckets (``captures.save_fetches``) stay
    in place again, others are shuffled once, unsorted.
    """
    payload = fetches.select(F.col("fetch_seq").alias("payload_seq"), "data")
    joined = payload.join(small_side(objects.drop("fetch_seq")), "payload_seq")
    return joined.select(
        "storage_path", content.canonical_bytes(F.col("document_type"), F.col("data")).alias("data"),
        identity.content_type(F.col("document_type")).alias("content_type"), "partition_date")


def build_records(named: DataFrame, run_id: str, run_seq: int) -> DataFrame:
    """Metadata rows to append to the landing log."""
    stamped = stored(named).withColumns({"scraped_at": F.current_timestamp(), "last_run_id": F.lit(run_id)})
    return stamped.select(*RECORD_COLUMNS, "fetch_seq", F.lit(run_seq).cast("bigint").alias("run_seq"))


def current_records(log: DataFrame) -> DataFrame:
    """The latest record of each identifier in a log (whole-record replacement)."""
    return latest_by(log, "identifier", "run_seq", "fetch_seq")


def current_slice(log: DataFrame, start: Column, end: Column) -> DataFrame:
    """Current records published in ``[start, end)``.

    Which record of an identifier is the current one is decided on four narrow
    columns; whole records are read from row groups of the range only.
    """
    order = ["identifier", "run_seq", "fetch_seq"]
    heads = range_slice(latest_by(log.select(*order, "published_date"), "identifier", "run_seq", "fetch_seq"), start, end)
    return range_slice(log, start, end).join(heads.select(*order), order, "left_semi")


def current_hashes(log: DataFrame) -> DataFrame:
    """``identifier, file_hash`` of the current records, reading only those columns."""
    return log.groupBy("identifier").agg(
        F.max_by("file_hash", F.struct("run_seq", "fetch_seq")).alias("file_hash"))


def hash_mismatches(records: DataFrame, objects: DataFrame) -> DataFrame:
    """Records whose object does not have the recorded hash.

    Possible where an object existed without a record: its bytes are kept.
    """
    actual = objects.select("storage_path", content.sha256_hex(F.col("data")).alias("object_hash"))
    return records.join(actual, "storage_path").filter(F.col("object_hash") != F.col("file_hash")).select(
        "identifier", "storage_path", "file_hash", "object_hash")
