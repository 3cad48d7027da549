"""Landing runs as a stream: listing pages and documents arrive in any order, each crawl lands when it is over.

Both streams name the crawl of a capture by its start. Requests and captures of one URL meet in a watermarked aggregate
that keeps the first of each, so a URL that many entries link to, or that was captured often, is one row of state and is
combined before it is shuffled. A crawl is over when both streams have moved on by more than the wait; its rows come out
in one batch and are a run, equal to :func:`landfall.plans.ingest.ingest` of what arrived in time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from landfall.functions import identity, urls
from landfall.operators import landing, listing
from landfall.operators.sequence import compute_once
from landfall.plans.ingest import land_requests, split_known
from landfall.sources.staging import small_side, stage
from landfall.sources.zones import LandingZone

#: Entries of a page that its share of the numbers has room for. Entries are numbered by page, then position.
PAGE_SPAN = 1 << 20

_CRAWL = "crawled_at"
_KEY = [_CRAWL, "of_page", "key"]
_PAGE = "struct<body_key: string, partition_date: string, url: string, first: boolean, announced: bigint, reason: string, status: int>"
_CAPTURE = ["fetch_seq", "url", "content_length", "file_hash", "reason", "status", "follow_url", "file"]


def _entries(pages: DataFrame) -> DataFrame:
    """Two rows per entry: one counts for its page, one is the request for its URL (null without a link)."""
    room = F.when(F.col("row_pos") < PAGE_SPAN, F.col("row_pos")).otherwise(
        F.raise_error(F.lit(f"a listing page has more than {PAGE_SPAN} entries")).cast("int"))
    numbered = listing.cut_entries(pages, _CRAWL).withColumn("fetch_seq", F.col("page_seq") * PAGE_SPAN + room)
    # Each step out of a generator: long expressions on URLs are not copied into one another.
    read = listing.read_entries(numbered, _CRAWL).withColumnRenamed("document_url", "_url")
    resolved = compute_once(read, document_url=F.col("_url")).drop("_url")
    rows = compute_once(resolved, identifier=identity.identifier_from_url(F.col("document_url")),
                        key=urls.same_request_key(F.col("document_url")))
    linked = F.col("link").isNotNull()
    unlinked = F.when(linked, 0).otherwise(1).cast("bigint")
    request = F.when(linked, F.struct(*listing.request_fields()))
    sides = F.array(
        F.struct(F.lit(True).alias("of_page"), F.col("page_seq").cast("string").alias("key"), F.lit(1).cast("bigint").alias("entries"),
                 unlinked.alias("unlinked"), F.lit(None).cast(_request_type(rows)).alias("request")),
        F.struct(F.lit(False).alias("of_page"), F.col("key"),
                 F.lit(0).cast("bigint").alias("entries"), F.lit(0).cast("bigint").alias("unlinked"), request.alias("request")))
    return rows.select(_CRAWL, F.inline(sides)).filter("of_page or request is not null")


def _request_type(rows: DataFrame):
    return rows.select(*listing.request_fields()).schema


def _pages(pages: DataFrame) -> DataFrame:
    """One row per page: what it announces, or why it failed."""
    reason = listing.failure_reason(F.col("status"), F.col("error"))
    announced = F.when(reason.isNull(), listing.result_count(F.col("html")))
    page = F.struct(
        "body_key", F.col("partition_label").alias("partition_date"), "url", (F.col("page") == 1).alias("first"),
        announced.alias("announced"), reason.alias("reason"), listing.http_status(F.col("status")).alias("status"))
    return pages.select(_CRAWL, F.lit(True).alias("of_page"), F.col("page_seq").cast("string").alias("key"), page.cast(_PAGE).alias("page"))


def _captures(fetches: DataFrame) -> DataFrame:
    """One row per captured document: its digest and the file its bytes are in."""
    read = landing.digest(fetches.withColumn("file", F.col("_metadata.file_path")), _CRAWL, "file")
    return read.select(_CRAWL, F.lit(False).alias("of_page"), urls.same_request_key(F.col("url")).alias("key"),
                       F.struct(*_CAPTURE).alias("capture"))


def _met(listings: DataFrame, fetches: DataFrame, wait: str) -> DataFrame:
    """Per crawl and URL the first request and the first capture; per crawl and page what it says and holds."""
    # Rows of no crawl belong to no run.
    pages, documents = (side.filter(F.col(_CRAWL).isNotNull()) for side in (listings, fetches))
    both = _entries(pages).withWatermark(_CRAWL, wait).unionByName(
        _pages(pages).withWatermark(_CRAWL, wait), allowMissingColumns=True).unionByName(
        _captures(documents).withWatermark(_CRAWL, wait), allowMissingColumns=True)
    # A struct compares by its first field, a unique number; null structs do not count.
    return both.groupBy(*_KEY).agg(
        F.min("request").alias("request"), F.min("capture").alias("capture"), F.min("page").alias("page"),
        F.sum("entries").alias("entries"), F.sum("unlinked").alias("unlinked"))


def _land_crawl(rows: DataFrame, reread: Callable[[list[str]], DataFrame], zone: LandingZone, run_id: str, run_seq: int,
                recheck: bool) -> None:
    requests = stage(rows.filter("request is not null").select("request.*"), "requests")
    captures = rows.filter("capture is not null").select("capture.*")
    wanted, skipped = split_known(requests, zone, run_seq, recheck)
    decided = stage(landing.attach_captures(wanted, captures.drop("file"), seen=requests), "decided")
    used = stage(decided.filter("file_hash is not null").select(F.col("payload_seq").alias("fetch_seq")), "used")
    # As many names as the crawl's documents have files.
    files = [r["file"] for r in captures.join(small_side(used), "fetch_seq", "left_semi").select("file").distinct().collect()]
    fetches = reread(files) if files else captures.select("fetch_seq", F.lit(None).cast("binary").alias("data")).filter(F.lit(False))
    pages = rows.filter("of_page and page is not null").select("page.*", "entries", "unlinked")
    zero = F.lit(0).cast("bigint")
    found = pages.filter("first and reason is null").select(
        "body_key", "partition_date", F.coalesce("announced", "entries", zero).alias("found"))
    failed = pages.filter("reason is not null").select(
        "body_key", "partition_date", "url", F.concat(F.lit("listing: "), "reason").alias("reason"), "status")
    unlinked = pages.filter("unlinked > 0").select(
        "body_key", "partition_date", "url", F.lit(listing.NO_LINK).alias("reason"), F.lit(None).cast("int").alias("status"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("unlinked"))).alias("_n")).drop("_n")
    land_requests(decided, skipped, fetches, found, failed.unionByName(unlinked), zone, run_id, run_seq, recheck)
    zone.maintain()


def crawl_stream(listings: DataFrame, fetches: DataFrame, reread: Callable[[list[str]], DataFrame], zone: LandingZone, checkpoint: str,
                 *, wait: str = "1 hour", run_id: str = "crawl", recheck: bool = False) -> StreamingQuery:
    """Land crawls from a stream of listing pages and a stream of documents; stops once the input that exists is processed.

    Both have a timestamp ``crawled_at``, the start of the crawl, besides the columns of listing pages and captures; rows
    without it are of no crawl and are left out. ``fetches`` is a stream over a file source and ``reread`` gives the same
    columns of the files named, as a table: only digests of documents are kept as state, bytes of those that are written
    are read from their files. ``page_seq`` and ``fetch_seq`` are unique; a row that arrives twice counts as one capture of its URL,
    but a page's entries would be counted twice.

    A crawl lands when, in both streams, a crawl has begun that is more than ``wait`` later. Documents that arrive after that are
    dropped and their requests have failed with ``document not captured``; crawls that are not over wait in the checkpoint.
    Several crawls that end in one batch land one after another, in their order. A crawl has the zone's next number and finds
    it again if its batch is repeated.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        rows = stage(batch, "crawls")  # the state is asked once
        begun = F.unix_micros(_CRAWL)
        for crawl in sorted(r[0] for r in rows.select(begun).distinct().collect()):
            run_seq = zone.claim(f"{run_id} {checkpoint} {crawl}")
            _land_crawl(rows.filter(begun == crawl), reread, zone, run_id, run_seq, recheck)

    return (
        _met(listings, fetches, wait).writeStream.outputMode("append").foreachBatch(land)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
