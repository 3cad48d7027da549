"""Registered queries: ``name -> function(spark, folder) -> DataFrame``."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.functions import charsets, cleaning, content, identity, markup, periods, stubs, urls
from landfall.operators import curate as curation
from landfall.operators import frontier, landing, listing, reconcile
from landfall.operators.sequence import latest_by
from landfall.plans.chain import ingest_and_curate
from landfall.plans.ingest import ingest, report
from landfall.sources.schemas import RECORD_COLUMNS
from landfall.sources.staging import scratch_root, stage
from landfall.sources.zones import CuratedZone, LandingZone
from landfall.streaming.crawls import crawl_stream
from landfall.streaming.keyed import keyed_stream
from landfall.streaming.merge import decide, land_documents, merge_stream
from workload import scenario
from workload.scenario import table



# --- charsets and escaping ----------------------------------------------------


def declared_charsets(spark: SparkSession, folder: str) -> DataFrame:
    """Whole pages written in five charsets, declared, marked or neither, and read back."""
    html, way = F.coalesce(F.col("html"), F.lit("")), F.col("page_id") % 5
    upper = F.lit("".join(map(chr, range(0x80, 0x100))))

    def single(codec: str, head: str):
        has = charsets.upper_half(codec).replace("\ufffd", "")
        kept = F.concat(F.lit(head), F.regexp_replace(html, f"[^\\x00-\\x7f{has}]", "?"))
        return F.encode(F.call_function("translate", kept, F.lit(charsets.upper_half(codec)), upper), "ISO-8859-1")

    marked = F.concat(F.lit(bytearray(b"\xff\xfe")), F.encode(html, "UTF-16LE"))
    written = F.when(way == 0, single("cp1251", '<meta charset="windows-1251">')).when(
        way == 1, single("iso8859-2", '<?xml version="1.0" encoding="ISO-8859-2"?>')).when(way == 2, marked).when(
        way == 3, F.concat(F.lit(bytearray(b"\xef\xbb\xbf")), F.encode(html, "UTF-8"))).otherwise(single("cp1252", ""))
    pages = table(spark, folder, "pages").select("page_id", written.alias("data"))
    return pages.select("page_id", charsets.html_text(F.col("data")).alias("text")).select(
        "page_id", F.sha2("text", 256).alias("text_sha256"), F.length("text").cast("bigint").alias("chars"))


def escaped_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Whole markup as the title of a page: every ``&``, ``<`` and ``>`` in it is escaped, once."""
    pages = table(spark, folder, "pages").select("page_id", cleaning.wrap(F.concat(F.lit("A & B <"), "url", F.lit("> "), "html"), F.lit("x")).alias("page"))
    return pages.select("page_id", F.sha2("page", 256).alias("page_sha256"))


# --- calendar and work frontier ----------------------------------------------


def partition_calendar(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of the ordering period of each nation and priority, in all three sizes."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderpriority")
    customers = table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    spans = orders.join(customers, "o_custkey").groupBy("c_nationkey", "o_orderpriority").agg(
        F.min("o_orderdate").cast("date").alias("first_day"), F.max("o_orderdate").cast("date").alias("last_day"))
    priority = F.col("o_orderpriority")
    sized = spans.withColumn("size", F.when(priority.startswith("1"), "monthly").when(
        priority.startswith("2"), "weekly").otherwise("yearly"))
    tiled = frontier.tile_windows(sized, F.col("first_day"), F.date_add("last_day", 1), F.col("size"))
    return tiled.select("c_nationkey", "o_orderpriority", "label", "window_start", "window_end")


def assign_partition(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("day")
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    labelled = frontier.assign_partition(days, day, "weekly").withColumnRenamed("partition_date", "week")
    return labelled.groupBy(
        periods.label(day, "monthly").alias("month"), "week", periods.label(day, "yearly").alias("year"),
        periods.align(day, "weekly").alias("monday")).agg(F.count("*").alias("orders"))


def source_lookup(spark: SparkSession, folder: str) -> DataFrame:
    requests = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("pos"), F.concat(F.lit("nation-"), F.col("c_nationkey")).alias("key"))
    dimension = table(spark, folder, "nation").select(
        F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("key"), F.col("n_nationkey").alias("site_id"),
        F.col("n_name").alias("display_name"))
    return frontier.lookup_sources(requests, dimension).select("pos", "key", "site_id", "display_name")


def work_frontier(spark: SparkSession, folder: str) -> DataFrame:
    days = table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    first, after = days.agg(F.min("day")).scalar(), days.agg(F.date_add(F.max("day"), 1)).scalar()
    sources = table(spark, folder, "supplier").select("s_suppkey", "s_name")
    return frontier.work_frontier(sources, first, after).select("s_suppkey", "s_name", "label", "window_start", "window_end")


def _order_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per customer segment and week: totals as a listing would announce them."""
    orders = table(spark, folder, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("body_key"))
    weekly = frontier.assign_partition(orders.join(customers, "o_custkey"), F.col("day"), "weekly")
    return weekly.groupBy("body_key", "partition_date").agg(F.count("*").alias("found"))


def page_fanout(spark: SparkSession, folder: str) -> DataFrame:
    return frontier.expected_pages(_order_totals(spark, folder), F.col("found"))


def listing_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Expected pages of a segment's week that no line shipped in that week has the number of."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("body_key"))
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_shipdate").cast("date").alias("shipped"))
    captured = frontier.assign_partition(
        lines.join(orders.drop("day"), "o_orderkey").join(customers, "o_custkey"), F.col("shipped"), "weekly").select("body_key", "partition_date", F.col("l_linenumber").alias("page"))
    return frontier.listing_gaps(page_fanout(spark, folder), captured).select("body_key", "partition_date", "page")


def capped_batch(spark: SparkSession, folder: str) -> DataFrame:
    batch = frontier.capped_batch(scenario.second_run(spark, folder), 50)  # before the documents are read
    return scenario.decided(batch).select("fetch_seq", "identifier", "file_hash")


# --- listing extraction --------------------------------------------------------


def result_count(spark: SparkSession, folder: str) -> DataFrame:
    pages = listing.captured(scenario.listing_pages(spark, folder))
    announced = listing.result_count(F.col("html"))
    rows = F.size(listing.row_markup(F.col("html"))).cast("bigint")
    return pages.select("page_seq", announced.alias("announced"), F.coalesce(announced, rows).alias("found"))


def listing_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = listing.listing_rows(scenario.listing_pages(spark, folder))
    return rows.select("fetch_seq", "row_pos", "link", "reference", "description_text", "published_date", "listing_url")


def listing_records(spark: SparkSession, folder: str) -> DataFrame:
    rows = listing.candidates(listing.listing_rows(scenario.listing_pages(spark, folder)))
    return rows.select("fetch_seq", "identifier", "title", "description", "published_date", "body_key", "partition_date",
                       "document_url", "document_type")


def site_date(spark: SparkSession, folder: str) -> DataFrame:
    day, priority = F.col("o_orderdate"), F.col("o_orderpriority")
    text = (
        F.when(priority.startswith("1"), F.date_format(day, "dd-MM-yyyy"))
        .when(priority.startswith("2"), F.concat(F.lit("  "), F.date_format(day, "d/M/yyyy"), F.lit("\n")))
        .when(priority.startswith("3"), F.concat(F.lit("31/"), F.date_format(day, "MM/yyyy")))
        .when(priority.startswith("4"), F.date_format(day, "dd/MM/yy"))
        .otherwise(F.date_format(day, "dd/MM/yyyy")))
    rows = table(spark, folder, "orders").select("o_orderkey", text.alias("date_text"))
    return rows.withColumn("published_date", periods.site_date(F.col("date_text")))


def url_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Every navigation link of every page, absolute, relative and one level up."""
    html = F.col("html")
    links = table(spark, folder, "pages").select(
        "page_id", "url", F.posexplode(markup.opening_tags(html, "a")).alias("pos", "tag")).select(
        "page_id", "url", "pos", markup.attribute(F.col("tag"), "href").alias("href"))
    word = F.expr("substring(href, 2)")
    url = F.col("url")
    return links.select(
        "page_id", "pos", urls.resolve(url, F.col("href")).alias("from_root"), urls.resolve(url, word).alias("relative"),
        urls.resolve(url, F.concat(F.lit("../x/.././"), word)).alias("parent"),
        urls.resolve(url, F.concat(F.lit("?q="), word)).alias("query_only"),
        urls.resolve(url, F.concat(F.lit("//other.example"), F.col("href"))).alias("other_host"), urls.host(url).alias("host"))


# --- identity ------------------------------------------------------------------


def url_identifier(spark: SparkSession, folder: str) -> DataFrame:
    odd = F.regexp_replace("url", r"/([0-9]+)(\.html|/)?", " /ir  -  sc - _$1_.tar.PDF;v=$1")
    return table(spark, folder, "pages").select(
        "page_id", identity.identifier_from_url(F.col("url")).alias("identifier"),
        identity.identifier_from_url(odd).alias("odd_identifier"),
        identity.normalize_identifier(F.regexp_extract("html", "<title>([^<]*)", 1)).alias("title_identifier"))


def doc_type(spark: SparkSession, folder: str) -> DataFrame:
    kind, url = F.col("document_type"), F.col("document_url")
    return scenario.documents(spark, folder).select(
        "fetch_seq", kind, identity.document_extension(url, kind).alias("ext"),
        identity.document_extension(F.col("page_url"), kind).alias("fallback_ext"),
        identity.content_type(kind).alias("content_type"))


# --- content ---------------------------------------------------------------------


def canonical_hash(spark: SparkSession, folder: str) -> DataFrame:
    body = content.canonical_bytes(F.col("document_type"), F.col("html").cast("binary"))
    return scenario.documents(spark, folder).withColumn("body", body).select(
        "fetch_seq", content.sha256_hex(F.col("body")).alias("file_hash"),
        content.short_hash(content.sha256_hex(F.col("body"))).alias("version"),
        content.byte_length(F.col("body")).alias("content_length"))


def _hashed(pages: DataFrame, text) -> DataFrame:
    return pages.select("page_id", text.alias("out")).select(
        "page_id", F.sha2("out", 256).alias("text_hash"), F.length("out").cast("bigint").alias("chars"))


def strip_boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    return _hashed(table(spark, folder, "pages"), cleaning.strip_boilerplate(F.col("html")))


def subtree_extract(spark: SparkSession, folder: str) -> DataFrame:
    return _hashed(scenario.with_container(spark, folder), markup.first_subtree(F.col("html"), "div", "content"))


def clean_fallback(spark: SparkSession, folder: str) -> DataFrame:
    return _hashed(scenario.with_furniture(spark, folder), cleaning.content_body(F.col("html")))


def stub_links(spark: SparkSession, folder: str) -> DataFrame:
    html = F.col("html")
    return scenario.with_download(spark, folder).select(
        "page_id", stubs.content_chars(html).cast("bigint").alias("chars"), stubs.download_link(html).alias("link"))


def stub_resolve(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        F.col("page_id").alias("fetch_seq"), F.col("url").alias("source_url"), F.col("url").alias("document_url"),
        identity.document_type(F.col("url")).alias("document_type"))
    captures = stage(landing.digest(scenario.stub_captures(spark, folder)), "captures")
    resolved = landing.attach_captures(landing.url_once(pages), captures)
    return resolved.select("fetch_seq", "source_url", "document_url", "document_type", "payload_seq", "file_hash", "reason",
                           "status")


# --- landing merge ---------------------------------------------------------------


def _second_run_named(spark: SparkSession, folder: str, recheck: bool = True) -> DataFrame:
    known = landing.current_hashes(
        scenario.as_landed(scenario.first_run(spark, folder), 1).filter(F.col("file_hash").isNotNull()))
    batch = stage(scenario.decided(scenario.second_run(spark, folder)), "decided")
    return landing.name_objects(landing.classify(batch, known, recheck))


def _first_run_named(spark: SparkSession, folder: str, run=scenario.first_run) -> DataFrame:
    batch = stage(scenario.decided(run(spark, folder)), "decided")
    nothing = batch.select("identifier", "file_hash").filter(F.lit(False))
    return landing.name_objects(landing.classify(batch, nothing, recheck=True))


def sequence_outcome(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("fetch_seq"), F.col("user_id").cast("string").alias("identifier"),
        F.sha2("event_type", 256).alias("file_hash"))
    nothing = events.select("identifier", "file_hash").filter(F.lit(False))
    return landing.classify(events, nothing, recheck=True).select("fetch_seq", "identifier", "previous_hash", "outcome")


def _zone_after_first_run(spark: SparkSession, folder: str) -> LandingZone:
    """A landing zone with the records of the first run, compacted."""
    zone, _ = _run_zones(spark)
    zone.write_run("records", landing.build_records(_first_run_named(spark, folder), "r1", 1), 1)
    zone.compact()
    return zone


def _second_run_into(spark: SparkSession, folder: str, zone: LandingZone) -> DataFrame:
    batch = stage(scenario.decided(scenario.second_run(spark, folder)), "decided")
    return landing.name_objects(landing.classify(batch, zone.hashes(before=2, asked=batch), recheck=True))


def merge_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """The second run against the zone's snapshot of the first."""
    named = _second_run_into(spark, folder, _zone_after_first_run(spark, folder))
    return named.select("fetch_seq", "identifier", "file_hash", "content_length", "outcome")


def skip_known(spark: SparkSession, folder: str) -> DataFrame:
    """The second run against what the first one landed: known identifiers are split off, the rest is classified."""
    known = scenario.as_landed(scenario.first_run(spark, folder), 1).filter(F.col("file_hash").isNotNull()).select("identifier")
    batch = stage(scenario.decided(scenario.second_run(spark, folder)), "decided")
    wanted, skipped = landing.skip_known(batch, known)
    nothing = batch.select("identifier", "file_hash").filter(F.lit(False))
    columns = ["fetch_seq", "identifier", "outcome"]
    return landing.classify(stage(wanted, "wanted"), nothing, recheck=False).select(*columns).unionByName(
        skipped.withColumn("outcome", F.lit("skipped")).select(*columns))


def landing_key(spark: SparkSession, folder: str) -> DataFrame:
    return landing.stored(_second_run_named(spark, folder)).select("fetch_seq", "outcome", "storage_path")


def append_objects(spark: SparkSession, folder: str) -> DataFrame:
    """Objects the second run appends, with the hash and length of the bytes written."""
    before = landing.new_objects(_first_run_named(spark, folder), _no_keys(spark))
    named = stage(_second_run_named(spark, folder), "classified")
    objects = stage(landing.new_objects(named, before), "new-objects")
    written = landing.attach_bytes(objects, scenario.second_run(spark, folder))
    return written.select("storage_path", "content_type", "partition_date", content.sha256_hex(F.col("data")).alias("object_hash"),
                          content.byte_length(F.col("data")).alias("bytes"))


def _no_keys(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "storage_path string")


def merge_current(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot of the first run with the second laid over it."""
    zone = _zone_after_first_run(spark, folder)
    zone.write_run("records", landing.build_records(_second_run_into(spark, folder, zone), "r2", 2), 2)
    return zone.current().drop("scraped_at")


def snapshot_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Events as one run per week; every second run is merged into the snapshot. The current records afterwards."""
    zone, _ = _run_zones(spark)
    events = stage(decide(scenario.events_as_documents(table(spark, folder, "events"))).withColumn(
        "week", F.floor((F.dayofmonth("published_date") - 1) / 8)), "weeks")
    for week in range(4):
        batch = events.filter(F.col("week") == week)
        named = landing.name_objects(landing.classify(batch, zone.hashes(before=week, asked=batch), recheck=True))
        zone.write_run("records", landing.build_records(named, f"w{week}", week), week)
        zone.maintain(every=2)
    return zone.current().select("identifier", "description", "published_date", "storage_path", "file_hash", "content_length", "fetch_seq")


def hash_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    """Records of a run of all pages whose object existed before with the bytes of the second run."""
    named = stage(_first_run_named(spark, folder, scenario.whole_run), "named")
    objects = scenario.second_run(spark, folder).filter(F.col("data").isNotNull()).join(
        landing.stored(named).select("fetch_seq", "storage_path"), "fetch_seq").select(
        "storage_path", content.canonical_bytes(F.col("document_type"), F.col("data")).alias("data"))
    records = landing.build_records(named, "r1", 1)
    return landing.hash_mismatches(records, objects).select("identifier", "storage_path", "file_hash", "object_hash")


def url_once(spark: SparkSession, folder: str) -> DataFrame:
    """Navigation links of all pages: each target is requested once."""
    rows = listing.candidates(listing.listing_rows(scenario.listing_pages(spark, folder)))
    return landing.url_once(rows.select("fetch_seq", "document_url"))


def stream_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a file stream into a new zone; the current records afterwards."""
    run = f"{scratch_root(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, folder, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(folder)
    zone = LandingZone(spark, f"{run}/zone")
    merge_stream(scenario.events_as_documents(events), zone, f"{run}/checkpoint").awaitTermination()
    return zone.current().select("identifier", "description", "published_date", "storage_path", "file_hash", "content_length",
                                 "fetch_seq")


def _event_parts(events: DataFrame, parts: int) -> list[DataFrame]:
    """The events in parts of consecutive numbers."""
    first, last = events.agg(F.min("event_id"), F.max("event_id")).first()
    step = (last - first) // parts + 1 if last is not None else 1
    lows = ((first or 0) + part * step for part in range(parts))
    return [events.filter((F.col("event_id") >= low) & (F.col("event_id") < low + step)) for low in lows]


def stream_keyed(spark: SparkSession, folder: str) -> DataFrame:
    """Events in four micro-batches, against the state of their users; the current records afterwards."""
    events = table(spark, folder, "events")
    run, source = f"{scratch_root(spark)}/keyed-{uuid.uuid4().hex}", f"{scratch_root(spark)}/events-{uuid.uuid4().hex}"
    zone = LandingZone(spark, f"{run}/zone")
    # A part is written by all tasks, in any number of files, and is one batch: the query goes on when it is there.
    for part in _event_parts(events, 4):
        part.hint("rebalance").write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        keyed_stream(scenario.events_as_documents(stream), lambda files: scenario.events_as_documents(
            spark.read.schema(events.schema).parquet(*files)), zone, f"{run}/checkpoint").awaitTermination()
    return zone.current().select("identifier", "description", "published_date", "storage_path", "file_hash", "content_length",
                                 "fetch_seq")


def _run_zones(spark: SparkSession) -> tuple[LandingZone, CuratedZone]:
    """New, empty zones in the scratch folder."""
    run = f"{scratch_root(spark)}/zones-{uuid.uuid4().hex}"
    return LandingZone(spark, f"{run}/landing"), CuratedZone(spark, f"{run}/curated")


def ingest_run(spark: SparkSession, folder: str) -> DataFrame:
    """A whole landing run over the listings and the documents they link to."""
    pages, (zone, _) = scenario.listing_pages(spark, folder), _run_zones(spark)
    captures = stage(scenario.link_captures(pages), "captured")
    return ingest(pages, captures, zone, run_id="r1", run_seq=1)


def ingest_and_curate_run(spark: SparkSession, folder: str) -> DataFrame:
    """The same run followed by curation of a date range; the curated records."""
    pages, (zone, curated) = scenario.listing_pages(spark, folder), _run_zones(spark)
    captures = stage(scenario.link_captures(pages), "captured")
    ingest_and_curate(pages, captures, zone, curated, date(2024, 3, 1), date(2025, 6, 1), run_id="r1", run_seq=1)
    return curated.current().select("identifier", "title", "published_date", "storage_path", "file_hash", "content_length",
                                    "original_storage_path", "original_file_hash")


def stream_crawls(spark: SparkSession, folder: str) -> DataFrame:
    """The landing run as a stream of listing pages and a stream of documents; a second crawl begins before the last documents.

    Documents with ``en`` in their URL arrive when the first crawl is over: its requests for them have failed.
    """
    run, (zone, _) = f"{scratch_root(spark)}/crawls-{uuid.uuid4().hex}", _run_zones(spark)
    pages = scenario.listing_pages(spark, folder)
    documents = stage(scenario.link_captures(pages), "captured")
    late = F.substring_index("url", "/", -1).contains("en")
    begun, later = (F.lit(day).cast("timestamp") for day in ("2024-01-01 00:00:00", "2024-02-01 00:00:00"))
    arrivals = [
        {"pages": (pages, begun), "documents": (documents.filter(~late), begun)},
        {"pages": (pages.filter(F.col("url").contains("?")), later), "documents": (documents.filter("status = 200"), later)},
        {"documents": (documents.filter("status <> 200"), later)}, {"documents": (documents.filter(late), begun)}]
    # What arrives together is written by all tasks, in any number of files, and is one batch: the query goes on when it is there.
    for arrival in arrivals:
        for kind, (rows, crawl) in arrival.items():
            rows.withColumn("crawled_at", crawl).hint("rebalance").write.mode("append").parquet(f"{run}/{kind}")
        schemas = {kind: spark.read.parquet(f"{run}/{kind}").schema for kind in ("pages", "documents")}
        sides = [spark.readStream.schema(schema).parquet(f"{run}/{kind}") for kind, schema in schemas.items()]
        crawl_stream(*sides, lambda files: spark.read.schema(schemas["documents"]).parquet(*files), zone, f"{run}/checkpoint").awaitTermination()
    return report(zone, 0)


# --- reconciliation ----------------------------------------------------------------


def _found(spark: SparkSession, folder: str) -> DataFrame:
    """What listings announced: the number of pages per unit, twice that in French."""
    pages = scenario.documents(spark, folder)
    weight = F.when(F.col("body_key") == "fr", 2).otherwise(1)
    return pages.groupBy("body_key", "partition_date").agg(F.sum(weight).alias("found"))


def _per_unit(spark: SparkSession, folder: str) -> DataFrame:
    named = stage(_second_run_named(spark, folder), "classified")
    failures = reconcile.document_failures(named).unionByName(_listing_failures(spark, folder))
    return reconcile.reconcile(_found(spark, folder), named, failures)


def _listing_failures(spark: SparkSession, folder: str) -> DataFrame:
    pages = scenario.listing_pages(spark, folder)
    return listing.listing_failures(pages).unionByName(listing.row_failures(listing.listing_rows(pages)))


def reconcile_units(spark: SparkSession, folder: str) -> DataFrame:
    return _per_unit(spark, folder)


def reconcile_totals(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.totals(_per_unit(spark, folder))


def failure_log(spark: SparkSession, folder: str) -> DataFrame:
    documents = reconcile.document_failures(_second_run_named(spark, folder))
    return documents.unionByName(_listing_failures(spark, folder))


def persist_failures(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs into a zone that also keeps files, where nothing can be written below the folder of French pages.

    Failures and outcomes of the second run; reasons without what the file system says.
    """
    run = f"{scratch_root(spark)}/files-{uuid.uuid4().hex}"
    blocked = spark._jvm.org.apache.hadoop.fs.Path(f"{run}/files/fr")
    blocked.getFileSystem(spark._jsc.hadoopConfiguration()).create(blocked).close()  # a file in the folder's place
    files = run if "://" in run else f"file://{run.removeprefix('file:')}"
    zone = LandingZone(spark, f"{run}/zone", files=f"{files}/files")
    for number, batch in enumerate((scenario.first_run, scenario.second_run), 1):
        land_documents(batch(spark, folder), zone, run_id=f"r{number}", run_seq=number)
    reason = F.when(F.startswith("reason", F.lit("persist: ")), F.lit("persist")).otherwise(F.col("reason"))
    failures = zone.read_run("failures", 2).groupBy("body_key", "partition_date", "url", reason.alias("reason"), "status").agg(F.count("*").alias("rows"))
    outcomes = zone.read_run("outcomes", 2).groupBy("body_key", "partition_date", "outcome").agg(F.count("*").alias("rows"))
    none = F.lit(None)
    return failures.select("body_key", "partition_date", F.lit("failure").alias("kind"), "url", "reason", "status", "rows").unionByName(
        outcomes.select("body_key", "partition_date", F.col("outcome").alias("kind"), none.cast("string").alias("url"),
                        none.cast("string").alias("reason"), none.cast("int").alias("status"), "rows"))


# --- curation ------------------------------------------------------------------------


def range_slice(spark: SparkSession, folder: str) -> DataFrame:
    start, end = (F.lit(f"{day} 00:00:00").cast("timestamp_ntz") for day in ("1996-01-15", "1997-03-01"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return curation.range_slice(orders, start, end, "o_orderdate").select("o_orderkey", "o_totalprice")


def _curation(spark: SparkSession, folder: str, curated: CuratedZone | None = None) -> tuple[DataFrame, DataFrame]:
    """Curate the current records of a run of all pages that are published in a range.

    Objects of French pages were lost; pages of blogs were curated before (in the zone, if there is one).
    """
    batch = scenario.whole_run(spark, folder)
    named = _first_run_named(spark, folder, scenario.whole_run)
    records = stage(latest_by(landing.build_records(named, "r1", 1), "identifier", "fetch_seq"), "records")
    canonical = content.canonical_bytes(F.col("document_type"), F.col("data"))
    objects = records.filter(F.col("body_key") != "fr").select("storage_path", "partition_date", "fetch_seq").join(
        batch.select("fetch_seq", canonical.alias("data")), "fetch_seq").drop("fetch_seq")
    chosen = curation.range_slice(records, F.lit("2022-01-10").cast("date"), F.lit("2024-06-01").cast("date"))
    landed = records.filter(F.col("description").contains("//blog.")).select("identifier", "fetch_seq", "document_type")
    earlier = landed.join(batch.select("fetch_seq", canonical.alias("data")), "fetch_seq").select(
        "identifier", content.sha256_hex(curation.curated_bytes(
            F.col("document_type"), F.col("data"), F.col("identifier"))).alias("file_hash"))
    if curated is not None:
        rows = records.drop("file_hash", "run_seq", "fetch_seq").join(earlier, "identifier").withColumns({
            "original_storage_path": F.col("storage_path"), "original_file_hash": F.lit(None).cast("string"),
            "content_type": identity.content_type(F.col("document_type")), "outcome": F.lit("copied_asis"),
            "data": F.lit(None).cast("binary")})
        curated.write_run("curated", rows, 1)
        curated.compact()
        earlier = curated.hashes(before=2, asked=stage(chosen.select("identifier"), "chosen"))
    return curation.transform(chosen, objects, earlier)


def curate(spark: SparkSession, folder: str) -> DataFrame:
    rows, _ = _curation(spark, folder)
    return rows.filter(F.col("outcome") != "unchanged").select(
        *[c for c in RECORD_COLUMNS if c != "scraped_at"], "original_storage_path", "original_file_hash", "content_type",
        content.sha256_hex(F.col("data")).alias("object_hash"))


def curate_outcome(spark: SparkSession, folder: str) -> DataFrame:
    """The second curation run of a zone, against its snapshot."""
    rows, _ = _curation(spark, folder, _run_zones(spark)[1])
    return rows.select("identifier", "document_type", "outcome")


def curate_failures(spark: SparkSession, folder: str) -> DataFrame:
    return _curation(spark, folder)[1]


def curate_summary(spark: SparkSession, folder: str) -> DataFrame:
    rows, failures = _curation(spark, folder)
    return curation.summary(rows, failures)


QUERIES = {
    "declared_charsets": declared_charsets,
    "escaped_titles": escaped_titles,
    "partition_calendar": partition_calendar,
    "assign_partition": assign_partition,
    "source_lookup": source_lookup,
    "work_frontier": work_frontier,
    "page_fanout": page_fanout,
    "listing_gaps": listing_gaps,
    "capped_batch": capped_batch,
    "result_count": result_count,
    "listing_rows": listing_rows,
    "listing_records": listing_records,
    "site_date": site_date,
    "url_parts": url_parts,
    "url_identifier": url_identifier,
    "doc_type": doc_type,
    "canonical_hash": canonical_hash,
    "strip_boilerplate": strip_boilerplate,
    "subtree_extract": subtree_extract,
    "clean_fallback": clean_fallback,
    "stub_links": stub_links,
    "stub_resolve": stub_resolve,
    "sequence_outcome": sequence_outcome,
    "merge_outcome": merge_outcome,
    "skip_known": skip_known,
    "landing_key": landing_key,
    "append_objects": append_objects,
    "merge_current": merge_current,
    "snapshot_merge": snapshot_merge,
    "hash_mismatch": hash_mismatch,
    "url_once": url_once,
    "stream_merge": stream_merge,
    "stream_keyed": stream_keyed,
    "ingest_run": ingest_run,
    "stream_crawls": stream_crawls,
    "ingest_and_curate": ingest_and_curate_run,
    "reconcile": reconcile_units,
    "reconcile_totals": reconcile_totals,
    "failure_log": failure_log,
    "persist_failures": persist_failures,
    "range_slice": range_slice,
    "curate": curate,
    "curate_outcome": curate_outcome,
    "curate_failures": curate_failures,
    "curate_summary": curate_summary,
}
