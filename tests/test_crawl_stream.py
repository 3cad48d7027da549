"""The stream of crawls against one batch run per crawl."""

import datetime as dt

from pyspark.sql import functions as F

from landfall.functions import content
from landfall.plans.ingest import ingest
from landfall.sources import schemas
from landfall.sources.zones import LandingZone
from landfall.streaming.crawls import crawl_stream

SITE = "https://y.example"
PAGES, FETCHES = f"{schemas.LISTING_PAGES}, crawled_at TIMESTAMP", f"{schemas.FETCHES}, crawled_at TIMESTAMP"
STUB = "<html><body><h2>See file</h2><div class='content'></div><a class='download' href='/files/{}.pdf'>file</a></body></html>"
FIRST, SECOND, THIRD = (dt.datetime(2024, month, 1) for month in (1, 2, 3))


def item(url, title="t"):
    link = f'<a href="{url}">{title}</a>' if url else "no link"
    return f'<li class="each-item"><h2 class="title">{link}</h2><span class="date">05/01/2024</span></li>'


def listed(spark, crawl, *rows):
    return spark.createDataFrame([
        (seq, "court", 3, "Court", "2024-01", page, f"{SITE}/search?page={page}", status, error,
         None if items is None else f"<ul>{''.join(items)}</ul>{tail}", crawl)
        for seq, page, status, error, items, tail in rows], PAGES)


def fetched(spark, crawl, *rows):
    return spark.createDataFrame([
        (seq, SITE + url, status, error, None if data is None else bytearray(data.encode()), crawl) for seq, url, status, error, data in rows], FETCHES)


def crawls(spark):
    """(start, listing pages, documents in time, documents that are late) of each crawl."""
    many = [item("/a.html", f"again {n}") for n in range(40)]
    total = "<p>Shows 1 to 10 of 1,000 results</p>"
    yield (FIRST,
           listed(spark, FIRST, (0, 1, 200, None, [item("/a.html", "A"), item("/b.pdf"), item(None), item("/stub-1.html")], ""),
                  (1, 2, 200, None, [*many, item("/stub-2.html"), item("/files/x.pdf"), item("/late.html"), item("/never.html"), item(None), item(None)], total),
                  (2, 3, 503, None, None, ""), (3, 1, None, "timed out", None, ""), (4, 1, 200, None, [], "")),
           fetched(spark, FIRST, (10, "/a.html", 200, None, "a 1"), (11, "/a.html", 200, None, "a 2"), (12, "/b.pdf", 404, None, None),
                   (13, "/stub-1.html", 200, None, STUB.format("one")), (14, "/stub-2.html", 200, None, STUB.format("x")),
                   (15, "/files/one.pdf", 200, None, "%PDF one"), (16, "/files/x.pdf", 200, None, "%PDF x"), (17, "/unasked.html", 200, None, "u")),
           fetched(spark, FIRST, (18, "/late.html", 200, None, "late")))
    yield (SECOND,
           listed(spark, SECOND, (5, 1, 200, None, [item("/late.html"), item("/b.pdf"), item("/a.html#top", "A")], total)),
           fetched(spark, SECOND, (20, "/late.html", 200, None, "now"), (21, "/b.pdf", 200, None, "%PDF b"), (22, "/a.html", 200, None, "a 3")),
           fetched(spark, SECOND))
    yield (THIRD, listed(spark, THIRD, (6, 1, 200, None, [item("/c.html")], "")), fetched(spark, THIRD, (30, "/c.html", 200, None, "c")),
           fetched(spark, THIRD))


def contents(zone, runs):
    """What the runs wrote; numbers of requests differ, their order does not."""
    names = {"outcomes": "identifier outcome body_key partition_date", "failures": "body_key partition_date url reason status", "found": "body_key partition_date found",
             "records": "identifier title published_date source_url document_url document_type storage_path file_hash content_length"}
    parts = [zone.read(table).filter(F.col("run_seq") < runs).select("run_seq", *columns.split()) for table, columns in names.items()]
    parts.append(zone.read("objects").filter(F.col("run_seq") < runs).select("run_seq", "storage_path", content.sha256_hex(F.col("data")).alias("hash")))
    return [sorted((tuple(r) for r in part.collect()), key=repr) for part in parts]


def compare(spark, folder, recheck):
    zone, batch = LandingZone(spark, f"{folder}/zone"), LandingZone(spark, f"{folder}/batch")

    def run():
        def read(kind, schema):
            return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{kind}")
        crawl_stream(read("pages", PAGES), read("documents", FETCHES), lambda files: spark.read.schema(FETCHES).parquet(*files), zone,
                     f"{folder}/checkpoint", recheck=recheck).awaitTermination()

    def put(kind, rows):
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/{kind}")

    for number, (_, pages, in_time, late) in enumerate(crawls(spark)):
        put("pages", pages)
        put("documents", in_time)
        if number == 0:  # the query is restarted while the crawl goes on
            run()
            lost = late
        if number < 2:
            ingest(pages.drop("crawled_at"), in_time.drop("crawled_at"), batch, run_id=f"r{number}", run_seq=number, recheck=recheck)
    put("documents", lost)  # behind those of the third crawl
    run()
    assert zone.read("outcomes").select("run_seq").distinct().count() == 2  # the last crawl is not over
    got = contents(zone, 2)
    assert got == contents(batch, 2)
    return got


def test_crawls_equal_batch_runs(spark, tmp_path):
    outcomes, failures, *_ = compare(spark, tmp_path, False)
    assert (0, "LATE", "failed", "court", "2024-01") in outcomes and (1, "LATE", "new", "court", "2024-01") in outcomes
    assert (1, "A", "skipped", "court", "2024-01") in outcomes
    assert sum(reason == "document not captured" for *_, reason, _ in failures) == 2


def test_no_input(spark, tmp_path):
    for kind in ("pages", "documents"):
        (tmp_path / kind).mkdir()
    zone = LandingZone(spark, str(tmp_path / "zone"))
    crawl_stream(spark.readStream.schema(PAGES).parquet(str(tmp_path / "pages")), spark.readStream.schema(FETCHES).parquet(str(tmp_path / "documents")),
                 lambda files: spark.read.schema(FETCHES).parquet(*files), zone, str(tmp_path / "checkpoint")).awaitTermination()
    assert zone.read("outcomes").count() == 0
